"""Operators for training corpora."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: what runs there is shipped with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
