"""Operators of a training-data pipeline."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, so that executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
