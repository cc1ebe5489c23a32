"""gridsmith — gridded (raster) analytics as plain Spark DataFrames.

Layers are DataFrames at *cell grain* ``(gx, gy, [instant], <bands>)`` or
*tile grain* ``(col, row, [instant], cells ARRAY<..>)``.  Every operator is a
``DataFrame -> DataFrame`` or ``Column -> Column`` function built from
Spark's own joins, aggregates, windows and expressions, so Catalyst plans
them, pushes filters into the Parquet scan and keeps them in codegen.
"""

import sys as _sys

from gridsmith.session import build_session, shared_dir  # noqa: F401

# The few Python tasks (numpy over Arrow batches) must run on executors that
# may not have this package installed: pickle our functions *by value* so
# each task carries its own code.  (On a cluster, shipping the package with
# --py-files / addPyFile works too; this makes it unnecessary.)
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 — older cloudpickle: fall back to shipping the package
    pass

__version__ = "0.1.0"
