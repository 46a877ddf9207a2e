"""Customer-retention analytics as lazy Spark DataFrame operators."""

from __future__ import annotations

from types import ModuleType

from pyspark import cloudpickle


def travels(package: ModuleType) -> None:
    """Send the package's worker functions along with the plan, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(package)
