"""annolake: build benchmark corpora from many annotated source corpora on Spark.

Every operator is a DataFrame-in, DataFrame-out function composed from Spark
DataFrame / SQL / window primitives. Sub-packages:

* ``sources``   readers and writers (index tables, segments, sidecars, profiles)
* ``functions`` column expressions (names, spans, paths, durations, nulls, keys)
* ``operators`` interval, curation, profiling, splitting, merging, checks, stats
* ``plans``     end-to-end flows (create dataset, split, profile) and the query registry
* ``streaming`` incremental corpus merge over Structured Streaming
"""

from annolake.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]

import sys  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
