import sys

from tally.cli import main

sys.exit(main())
