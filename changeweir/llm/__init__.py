"""Operators that prepare text for training: dedup, filters, extraction, personal data, packing.

Nothing else in the library imports this subpackage; it uses the library's session helpers only.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
