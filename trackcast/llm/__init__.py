"""Operators of a training-data pipeline (sharding, language ID, near-duplicates, ...).

Nothing else in the library imports this subpackage; ``queries`` registers one
``opN_<name>`` query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a cluster
# needs numpy and pyarrow there, but no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
