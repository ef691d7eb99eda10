"""Operators of a training-data pipeline: quality, secrets, personal data, deduplication, decontamination, mixing, web archives."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
