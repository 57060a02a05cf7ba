"""Operators for preparing training data of language models.

Nothing else in the library imports this package.  Functions that run in Python tasks travel with the job by value, so
executors need the third-party libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
