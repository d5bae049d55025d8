"""visitlens: user-visit session analytics expressed as Spark DataFrame plans.

Layout:
  functions/  column expressions and the fixed bucket table
  sources/    table reads, test-data adapter views, task, text and inline sources
  operators/  session aggregate, filters, statistics, sampling, categories, top sessions, word count
  plans/      the end-to-end job, the query registry and the DuckDB oracle SQL
  sinks/      result writers (any Spark format, JDBC included)
  streaming/  the category-count operator run incrementally over a file stream
"""

from visitlens.params import TaskParams
from visitlens.session import build_session, checkpoint_dir

__all__ = ["TaskParams", "build_session", "checkpoint_dir"]
