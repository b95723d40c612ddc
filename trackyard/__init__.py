"""Medallion warehouse for railway mobile-radio supervision exports, built on Spark.

Layers:
  bronze  typed append of raw exports with lineage and content-hash idempotence
  silver  latest record per business key, parsed durations / ratios / guarded casts
  gold    subscriber dimension with a dense key and six left-joined fact tables

Everything is expressed with DataFrame operations and native Column expressions.
"""

from trackyard.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
