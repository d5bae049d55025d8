"""Incremental form of the category counts over a stream of action files.

The original job is batch only. This module adds no operator: it runs the same category-count
aggregate (A7) on a Structured Streaming source, so new action files update the counts without
rescanning old ones. State is one row per category; the checkpoint goes to the shared
``spark.checkpoint.dir``.
"""

from visitlens.streaming.categories import start_category_counts, stream_category_counts

__all__ = ["start_category_counts", "stream_category_counts"]
