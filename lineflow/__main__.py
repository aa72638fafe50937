import sys

from lineflow.cli import main

sys.exit(main())
