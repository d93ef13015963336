"""Operators for building training corpora: extraction, deduplication, scoring, search, tokens, packing, privacy.

Nothing else in the library imports this package. Code that runs in tasks goes
along with them, so workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
