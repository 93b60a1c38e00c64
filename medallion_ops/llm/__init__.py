"""Operators for building training corpora at cluster scale.

One module per operator; each has its own general interface (any table, any
column names) and returns its real outputs (texts, spans, files).
``queries.py`` holds the thin ``opN_<name>`` queries with production
parameters and their DuckDB SQL. Nothing outside this package (and the
top-level ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
