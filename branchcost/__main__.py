import sys

from branchcost.plans.cli import main

sys.exit(main())
