"""Launcher for spark-submit: ``spark-submit [--py-files flightlake.zip] lake.py nightly --lake ROOT``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flightlake.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
