"""Operators of a training-data pipeline over documents, pages, vectors and conversations."""

import sys

from pyspark import cloudpickle

# task code travels with the job, so workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
