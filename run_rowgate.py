"""Launcher for spark-submit (which runs a script, not ``-m``):

    spark-submit --py-files rowgate.zip run_rowgate.py INPUT OUTPUT CONTRACT [START [END]]
"""

import sys

from rowgate.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
