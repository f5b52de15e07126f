"""Operators for training-text pipelines and the queries that apply them.

Functions of this package travel to the executors with the tasks, so the package
itself need not be installed there.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
