"""Operators for training-data pipelines: one module per operator.

Nothing else in the library imports this subpackage; ``queries`` in it holds
the registered queries and their SQL.  Functions that run inside tasks travel
with the plan, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
