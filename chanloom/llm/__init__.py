"""Operators of a training-data pipeline over a ``documents`` table.

Nothing outside this subpackage imports it.  Functions shipped to executors
are pickled by value, so executors need no installed copy of the package.
"""

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["llm"]))
