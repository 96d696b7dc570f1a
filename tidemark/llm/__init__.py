"""Operators of a training-data pipeline over document tables. Nothing outside this package imports it.

What runs inside tasks is sent along with the tasks, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
