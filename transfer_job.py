"""Entry point for spark-submit."""

import sys

from tableferry.__main__ import main

sys.exit(main())
