"""``python -m marketprep <job> ...`` - same as ``python -m marketprep.jobs``."""

import sys

from .jobs import main

sys.exit(main())
