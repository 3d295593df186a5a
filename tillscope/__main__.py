import sys

from tillscope.cli import main

sys.exit(main())
