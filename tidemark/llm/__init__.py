"""Operators for training-data pipelines; nothing else in the library imports them.

What their tasks run is sent to the executors with the tasks, so that executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
