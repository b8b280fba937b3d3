"""Operators for preparing training data, each with its query.

Nothing outside this subpackage imports it. Python code that runs on
executors is shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
