"""Batch scoring of date-partitioned tables on Spark, guarded before every write.

One feature table, one feature view, drift and volume guards, a logistic model
trained on time-ordered data, idempotent partition scoring, a run ledger and
alert rules in batch and streaming form.
"""

from tidegate.config import JobConfig

__all__ = ["JobConfig"]
