"""Operators of a training-data pipeline (near copies, mixing, sharding, filtering, scoring).

Nothing outside this folder imports it; its queries are in ``entries.py``.  Functions that run in Python
workers travel with the job, so the package need not be installed on executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
