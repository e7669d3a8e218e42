"""spark-submit launcher: ``spark-submit --py-files tiers.zip tiers_job.py <step> [options]``."""

import sys

from tiers.cli import main

if __name__ == "__main__":
    sys.exit(main())
