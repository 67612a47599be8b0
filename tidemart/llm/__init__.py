"""Training-data operators: search, formatting, packing, scoring, near-duplicates,
mixing, quality, language and secrets.  Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no copy of the repository on its nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
