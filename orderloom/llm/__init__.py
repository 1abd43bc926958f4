"""Operators for preparing training text.  Nothing else in the library imports them.

Functions that run inside tasks are sent to the executors by value, so the executors
need the third-party packages but not this one.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
