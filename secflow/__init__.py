"""secflow: security-log analytics as DataFrame -> DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
