"""Corpus analytics on Spark: typed blocks and pairs, profiling, quality rules, joins, graphs, rewriting and packing."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value: the package needn't be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
