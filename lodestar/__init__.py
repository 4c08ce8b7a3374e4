"""lodestar — full-text and vector search as Spark DataFrame jobs.

Functions of this package that run inside tasks (Arrow batch kernels) are
pickled by value, so executors need only PySpark, NumPy and pandas.
"""

import sys as _sys

try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
