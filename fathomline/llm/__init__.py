"""Operators for training-data pipelines over ``documents``, ``pages``, ``labels`` and ``benchmark``.

Nothing outside this folder imports it. Functions that run in Python workers travel
with the task, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
