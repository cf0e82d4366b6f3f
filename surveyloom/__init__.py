"""Cohort analytics on Spark: features, profiling, clustering, models, kernels.

Every operator takes and returns DataFrames; fitted parameters (means,
centroids, coefficients, kernel weights) are the only values that reach the
driver, and their size depends on the number of columns, clusters or classes,
never on the number of rows.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel by value, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
