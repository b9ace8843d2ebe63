"""Reusable operators: one DataFrame (or Column) function per survey operator."""

import sys

from pyspark import cloudpickle

# Python run by the executors travels by value: no copy of the library is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
