"""Operators for preparing language-model training data at scale.

Nothing outside this subpackage imports it. Each operator lives in its own module with a
general interface over a DataFrame; ``queries`` applies them to the driver's tables.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a job needs no copy of
# the library installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
