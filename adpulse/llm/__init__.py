"""Operators for large text corpora (training-data preparation).

Nothing else in the library imports this subpackage. Its Python functions run
inside Spark tasks; they are pickled by value so that executors need no copy
of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
