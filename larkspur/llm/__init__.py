"""Training-data operators: extraction, scans, tokenizing, joins, quality, mixing, search.

Nothing outside this subpackage imports it; its queries are in ``queries.py``.  Functions that
run in Python workers travel by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
