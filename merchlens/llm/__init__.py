"""Operators for large-scale training-data pipelines.

Functions that run inside Spark's Python workers are sent with the job, so
executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
