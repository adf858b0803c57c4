"""State tables kept as a base and the change rows written after it.

A day (or other period) writes only the rows that it changes, as one partition
of the change table: no join with the state, no rewrite of it, and a rerun
replaces its partition. A read folds the latest base at or before the as-of
with the changes between the two; ``compact`` writes such a read as a new base,
so that later reads start from there. Changes are kept when a base is made, so
that a day can be run again at any time: bases that had taken it in are
dropped, and reads fall back to the base before.

Readers take the newest base at or before their as-of and never need the
tables to be quiet: a base is one partition, written whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import state_path
from .snapshots import SnapshotTable

# folds a base (None before the first) with the changes after it, as of a period
Merge = Callable[[DataFrame | None, DataFrame, object], DataFrame]


class ChangeTable:
    """``base`` and ``changes`` below ``path``, both partitioned by ``as_of_col``."""

    def __init__(self, spark: SparkSession, path: str, as_of_col: str, keys: Sequence[str], merge: Merge) -> None:
        root = path.rstrip("/")
        self.path = root
        self.as_of_col = as_of_col
        self.merge = merge
        self.changes = SnapshotTable.at(spark, f"{root}/changes", as_of_col, sort_cols=keys)
        self.base = SnapshotTable.at(spark, f"{root}/base", as_of_col, sort_cols=keys)

    @classmethod
    def scratch(cls, spark: SparkSession, name: str, as_of_col: str, keys: Sequence[str], merge: Merge) -> ChangeTable:
        """A fresh table under the shared checkpoint folder."""
        return cls(spark, state_path(spark, name), as_of_col, keys, merge)

    def write(self, changed: DataFrame, as_of) -> None:
        """Replace the change rows of one period; bases that had taken the period in are dropped."""
        for stale in [p for p in self.base.written if p >= as_of]:
            self.base.drop_period(stale)
        self.changes.write_period(changed, as_of)

    def write_range(self, changed: DataFrame, first, last) -> None:
        """Replace the change rows of all periods from ``first`` to ``last`` in one job.

        Periods do not depend on each other, so a range is one pass over its
        source rows; each period is still a partition of its own, and one that
        has no rows any more is dropped.
        """
        for stale in [p for p in self.base.written if p >= first]:
            self.base.drop_period(stale)
        before = {p: self.changes.files_of(p) for p in self.changes.written if first <= p <= last}
        self.changes.write(changed)
        for p in [p for p, files in before.items() if self.changes.files_of(p) == files]:
            self.changes.drop_period(p)
        self.changes.written = self.changes.periods()

    def base_before(self, as_of):
        """As-of of the base that a read of ``as_of`` starts from, or None."""
        return max((p for p in self.base.written if p <= as_of), default=None)

    def changes_between(self, after, upto) -> DataFrame:
        """Change rows with ``after`` < as-of <= ``upto``: a partition-pruned scan."""
        c = F.col(self.as_of_col)
        rows = self.changes.read().where(c <= F.lit(upto))
        return rows if after is None else rows.where(c > F.lit(after))

    def read(self, as_of) -> DataFrame:
        """The state as of a period: the base before it with the changes since."""
        if self.changes.schema is None:
            raise ValueError("table has not been written yet")
        start = self.base_before(as_of)
        base = None if start is None else self.base.read(as_of=start)
        return self.merge(base, self.changes_between(start, as_of), as_of)

    def compact(self, as_of) -> None:
        """Write the state as of a period as a base (one partition; rerun-safe)."""
        if self.base_before(as_of) != as_of:
            self.base.write_period(self.read(as_of), as_of)

    def forget(self, before) -> None:
        """Drop the bases before the newest one at or before ``before``, and the changes that it holds.

        Periods up to that base can then no longer be run again.
        """
        start = self.base_before(before)
        for p in [] if start is None else [p for p in self.base.written if p < start]:
            self.base.drop_period(p)
        for p in [] if start is None else [p for p in self.changes.written if p <= start]:
            self.changes.drop_period(p)
