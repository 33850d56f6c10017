"""Operators for preparing training text. Nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Executors need not have the package on their path for the functions that tasks call.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
