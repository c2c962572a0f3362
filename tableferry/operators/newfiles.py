"""The rows that one append added to a sink of files.

An append can put a mark of its own into the names of the files that it writes. Its rows are then
those of the files with the mark, whatever the sink held before and whatever other jobs append
meanwhile: Spark prunes all others by name while it plans the scan and does not open them. The files
of an append that went wrong can be removed without touching any other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tableferry.operators.storage import delete_file

#: Providers whose tables are files
FILES = ("parquet", "orc", "json", "avro")

#: Fixed value: the setting of the name that files of a write begin with
FILE_NAME = "mapreduce.output.basename"


def begin_of_names(mark: str) -> str:
    return f"part-{mark}"


def rows_of(spark: SparkSession, sink: str, mark: str) -> DataFrame:
    """The rows of the append with this mark."""
    table = spark.table(sink)
    name = table.metadataColumn("_metadata")["file_name"]
    return table.where(name.startswith(begin_of_names(mark) + "-"))


def can_be_told(spark: SparkSession, sink: str, described: dict[str, str]) -> bool:
    """Whether rows can be told by their file: not of other catalogs, and Spark hides the files of
    tables with CHAR columns."""
    if described.get("Provider", "").lower() not in FILES:
        return False
    if described.get("Catalog", "spark_catalog") != "spark_catalog":
        return False
    try:
        rows_of(spark, sink, "")
    except AnalysisException:
        return False
    return True


def remove(spark: SparkSession, sink: str, mark: str) -> int:
    """Delete the files of the append with this mark; returns how many there were."""
    spark.catalog.refreshTable(sink)
    begin = begin_of_names(mark) + "-"
    own = [path for path in spark.table(sink).inputFiles() if path.rsplit("/", 1)[-1].startswith(begin)]
    for path in own:
        delete_file(spark, path)
    if own:
        spark.catalog.refreshTable(sink)
    return len(own)
