"""Operators that prepare text for the training of language models."""

import sys

from pyspark import cloudpickle

# Task code travels with the job: workers need numpy and the text libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
