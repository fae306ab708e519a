import sys

from .api import main

sys.exit(main())
