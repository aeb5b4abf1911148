"""quayside: streaming event ingestion and document indexing operators on Spark DataFrames."""

from __future__ import annotations

import sys

# Functions from this package run inside Python workers (Arrow UDFs, mapInPandas).
# Pickle them by value so executors do not need the package installed; on a real
# cluster shipping the package with --py-files works as well.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

__all__ = ["session"]
