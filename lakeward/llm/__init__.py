"""Training-data operators: tokens, extraction, archives, filters, duplicates.

Nothing outside this folder imports it. The functions that run inside tasks are
sent to the workers by value, so the workers need not have this package on
their path, only the installed libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
