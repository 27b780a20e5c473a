"""riskline: a Spark-native tabular profiling and risk-model engine."""

import sys as _sys

__version__ = "0.1.0"

# Python-side task code (pandas UDFs, the k-NN kernel) travels with the task
# by value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001  (older cloudpickle: ship the package with addPyFile instead)
    pass
