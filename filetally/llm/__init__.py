"""Operators for preparing training text: joins, models, rules, scans and mixing.

Nothing else in the library imports this subpackage. Functions that run inside tasks are
shipped by value, so executors need numpy and pyarrow but not the library itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
