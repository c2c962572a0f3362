"""Command line of the job; it reads everything from the Spark settings."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tableferry.config import SINK_PREFIX, config_report, from_spark_conf
from tableferry.functions.masking import mask_text
from tableferry.plans.report import RunReport, TransferFailed
from tableferry.plans.run import run

log = logging.getLogger("tableferry")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tableferry", description=__doc__)
    parser.add_argument(
        "--sink-prefix",
        default=SINK_PREFIX,
        help="prefix of the sink settings (default: %(default)s)",
    )
    arguments = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)

    own_session = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName("tableferry").getOrCreate()
    try:
        config = from_spark_conf(spark, arguments.sink_prefix)
        for row in config_report(spark, config).collect():
            log.info("%s: %s = %s", row.section, row.key, row.value)
        report = run(spark, config, fail_on_error=False)
        _log_summary(spark, report)
        if report.failed:
            raise TransferFailed(report)
    except Exception as error:
        log.error("%s", mask_text(str(error)))
        return 1
    finally:
        if own_session:
            spark.stop()
    return 0


def _log_summary(spark: SparkSession, report: RunReport) -> None:
    totals = report.totals(spark).first()
    log.info(
        "%d tables: %d succeeded, %d failed (%s%%)",
        totals.total,
        totals.succeeded,
        totals.failed,
        totals.success_pct,
    )
    for o in report.outcomes:
        log.log(
            logging.INFO if o.succeeded else logging.ERROR,
            "[%d] %s: %s, %s rows%s",
            o.run_order,
            o.table,
            o.status,
            o.source_rows,
            f", {o.error}" if o.error else "",
        )


if __name__ == "__main__":
    sys.exit(main())
