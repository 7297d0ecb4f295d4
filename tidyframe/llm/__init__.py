"""Operators of a training-data pipeline (one module per operator).

Nothing else in the library imports this package.  Functions that run inside
tasks are shipped with the job, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
