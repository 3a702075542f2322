"""Operators for training-data pipelines: quality, near-duplicates, language,
personal data, token counts, page extraction, mixing, packing, exact search,
tokenizer alignment and periodic runs.

Nothing else in the library imports this package; its queries are in
``annolake.llm.queries`` and its DuckDB SQL in ``annolake.llm.oracles``.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
