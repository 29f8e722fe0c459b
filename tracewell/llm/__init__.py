"""Operators for preparing training text: deduplication, filters, scans and packing.

Nothing else in the library imports this subpackage. Functions that run inside Spark tasks are
shipped with the job, so executors do not need the package installed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
