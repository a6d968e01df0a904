"""Operators that prepare training corpora for language models.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so executors need
# no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
