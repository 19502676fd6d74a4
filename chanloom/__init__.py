"""chanloom: a Spark-native channel-catalogue engine.

Playlists, rule tables and captured probe samples go in as DataFrames; every
operator is a ``DataFrame -> DataFrame`` function over Spark SQL built-ins.
"""

import sys as _sys

# The two pandas UDFs of the package are pickled by value, so Python workers
# need not have the package installed (no --py-files required).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
