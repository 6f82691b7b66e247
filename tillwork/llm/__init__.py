"""Operators for preparing language-model training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tillwork.llm.queries import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
