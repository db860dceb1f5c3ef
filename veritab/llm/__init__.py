"""Operators for large text collections: one module per operator, its query and its SQL beside it.

Nothing else of the library imports this subpackage; ``__spark_entry__.py`` adds its queries when
it is present. Functions that run inside tasks are pickled by value, so executors need numpy and
pyarrow but not this package on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
