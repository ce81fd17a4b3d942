"""Retail operations analytics as Spark jobs: warehouse, KPIs, alerts and live totals."""

import sys

from pyspark import cloudpickle

# functions run on workers travel whole, so that executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
