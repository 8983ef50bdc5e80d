"""Operators for preparing large training corpora; nothing else in the library depends on them.

Functions of this package that run inside tasks are sent to the executors by value, so the
executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
