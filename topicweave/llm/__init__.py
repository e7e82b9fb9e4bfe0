"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Functions that run on
executors are shipped with the job (pickled by value), so executors need no
copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
