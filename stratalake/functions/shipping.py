"""Sending this package's task functions to executors that do not have it installed."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle


def by_value(function: Callable) -> Callable:
    """Make a function travel with its code, so a job needs no installation on the workers."""
    package = __name__.split(".")[0]
    for name, module in list(sys.modules.items()):
        if module is not None and (name == package or name.startswith(package + ".")):
            cloudpickle.register_pickle_by_value(module)
    return function
