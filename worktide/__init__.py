"""Spark-native operators for job postings, skills, matching and labour-market series."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
