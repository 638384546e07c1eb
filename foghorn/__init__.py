"""foghorn: company-signal analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python tasks carry their functions along: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
