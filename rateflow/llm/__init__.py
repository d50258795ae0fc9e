"""Operations of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  The operators live in one
module each; `queries` registers them over the given tables.
"""

import sys

from pyspark import cloudpickle

# Tasks carry this subpackage's functions with them: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
