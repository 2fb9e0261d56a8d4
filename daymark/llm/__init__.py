"""Operators of a training-data pipeline; nothing else in the library imports this package.

Functions that run inside tasks are sent with their code, so that executors need the installed
libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
