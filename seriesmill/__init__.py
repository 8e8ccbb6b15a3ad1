"""Monthly demand forecasting over very many series, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The solver kernels run in Python workers. Shipping this package by value means
# executors need nothing installed beyond numpy and pandas.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
