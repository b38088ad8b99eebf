"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface, the thin
``opN_<name>`` query that applies it to the given tables and, where SQL can
express the result, that query's DuckDB SQL.  Nothing else in the library
imports this subpackage.

Functions of this subpackage travel to the executors by value, so these need
no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
