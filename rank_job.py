"""Start script for ``spark-submit``; see ``surfrank.job``."""

import sys

from surfrank.job import main

if __name__ == "__main__":
    sys.exit(main())
