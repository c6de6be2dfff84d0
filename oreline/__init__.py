"""oreline: data-mining operators written as Spark DataFrame jobs.

Every operator takes DataFrames and returns DataFrames.  What reaches the
driver is bounded by parameters (centres, coefficients), never by the data.
"""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors with the code they use, so a cluster needs no
# copy of this package on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
