"""Corpus preparation and evaluation as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: functions that run in tasks travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
