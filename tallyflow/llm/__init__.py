"""Training-data operators: one module per operator, plus the registered
queries (``queries.py``) and their DuckDB SQL (``oracle.py``).

Nothing outside this package imports it except ``__spark_entry__`` (which
adds its queries when it is present) and ``corpus_pipeline.py``.
"""

import sys

from pyspark import cloudpickle

# Functions that run in executors' Python workers are shipped by value, with
# the globals they read, so that no worker needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
