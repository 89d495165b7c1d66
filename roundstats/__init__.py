"""roundstats: DataFrame operators for number statistics, word counting and
weighted clustering, run as Spark jobs."""

import sys

__version__ = "0.1.0"

# The Arrow kernels are shipped to Python workers with the task: pickle this
# package's functions by value, so executors need not have it installed.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001  (older cloudpickle: package must be installed)
    pass
