"""Period-by-period folds: run a step operator once per period, writing each
result as a partition of a snapshot table.

The driver loop is over periods only (a handful of seasons or days), never
over rows. Each step reads the previous partition (pruned scan) and the
period's source rows (pushed-down filter), so every step's lineage is two
scans deep no matter how many periods have been folded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import SnapshotTable


class MissingPeriodError(LookupError):
    """The partition that a step starts from is absent although earlier ones exist."""


def previous_snapshot(table: SnapshotTable, period, previous) -> DataFrame | None:
    """Partition ``previous``; None before the first period; an error if only earlier ones exist."""
    if table.has(previous):
        return table.read(as_of=previous)
    if earlier := [w for w in table.written if w is not None and w < period]:
        raise MissingPeriodError(
            f"{table.path}: {previous} was never written, the last period before {period} is {max(earlier)}; "
            "run the periods between first"
        )
    return None


def fold(
    table: SnapshotTable,
    periods: Iterable,
    step: Callable[[DataFrame | None, object], DataFrame],
    previous_of: Callable[[object], object],
    carry_latest: bool = False,
    resume: bool = False,
) -> SnapshotTable:
    """Apply ``step(prev_snapshot_or_None, period)`` for each period in order.

    A period whose predecessor is missing although earlier ones are stored is
    an error: starting anew would lose every history. With ``carry_latest`` the
    latest partition before it stands in instead (relabelled to
    ``previous_of(p)``), as a keyed table updated in place would behave. With
    ``resume`` periods that are already written are skipped (after a restart,
    re-open the table with ``SnapshotTable.open``); without it every given
    period is recomputed and its partition replaced.
    """
    for p in periods:
        if resume and table.has(p):
            continue
        prev_p = previous_of(p)
        earlier = [w for w in table.written if w is not None and w < p]
        if carry_latest and earlier and not table.has(prev_p):
            prev = table.read(as_of=max(earlier)).withColumn(table.as_of_col, F.lit(prev_p))
        else:
            prev = previous_snapshot(table, p, prev_p)
        table.write_period(step(prev, p), p)
    return table
