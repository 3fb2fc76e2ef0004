"""liftlens: Spark-native web-session analytics and causal lift.

Layers (each one plain DataFrame functions):

* ``sources``   – GA4-shaped raw events, daily shards, incremental loads, sinks
* ``functions`` – column-level helpers (param lookup, channel grouping, hashing)
* ``operators`` – flattening, session rollup, reports, quality, metrics, causal
* ``plans``     – the daily pipeline and the registered query catalog
* ``streaming`` – shard arrival as a file stream
"""

from liftlens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
