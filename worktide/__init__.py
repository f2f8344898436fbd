"""Set-based lifecycle analytics for background work, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Code that runs inside tasks travels with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
