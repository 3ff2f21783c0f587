"""Spark-native toolkit for splitting, scoring and judging tables of labelled text.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Rows are identified by an explicit key column and every random
decision is a pure function of ``(seed, stage, key)``, so results do not depend
on partitioning, task retries or cluster size.
"""

__version__ = "0.1.0"
