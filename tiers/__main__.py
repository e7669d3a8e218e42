import sys

from tiers.cli import main

sys.exit(main())
