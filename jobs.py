"""Launcher for spark-submit (which takes a file, not a module):

    zip -r periodlens.zip periodlens
    spark-submit --py-files periodlens.zip jobs.py --base-dir /data/analysis population

Locally, ``python -m periodlens.cli ...`` does the same.
"""

import sys

from periodlens.cli import main

if __name__ == "__main__":
    sys.exit(main())
