"""Operators for preparing training data: scoring, filtering, deduplicating, mixing, encoding.

Nothing else in the library imports this package. Functions that run in tasks travel with the job,
so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
