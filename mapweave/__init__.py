"""Vector features and raster tiles as Spark DataFrames.

Sub-packages: ``functions`` (column functions), ``operators`` (whole-DataFrame
operators), ``sources`` (readers and writers), ``streaming`` (Structured
Streaming jobs) and ``plans`` (the registered queries on the driver tables).
"""

import sys

from pyspark import cloudpickle

# Kernels travel to the executors inside the job, so the package only has to
# be installed on the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
