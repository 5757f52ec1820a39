"""Daily-demand analytics and forecasting on PySpark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# functions sent to workers travel with their code: the package need not be installed there
register_pickle_by_value(sys.modules[__name__])
