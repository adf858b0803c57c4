"""Column-expression helpers shared by the operators.

All of them build plain Catalyst expressions (no Python UDFs), so they stay
inside whole-stage code generation where Spark supports it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's scoring thresholds (strictly greater than
# 20 -> star, 15 -> good, 10 -> avg, otherwise bad; the class domain is
# ``strata.schemas.SCORING_CLASS``).
REFERENCE_TIERS = (("star", 20), ("good", 15), ("avg", 10))
REFERENCE_DEFAULT_TIER = "bad"

# Thresholds used with the ``entity_periods`` testdata view (pts in cents).
ENTITY_PERIOD_TIERS = (("star", 35_000_000), ("good", 25_000_000), ("avg", 15_000_000))


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_of(v) -> Column:
    """A literal, or the Column itself (e.g. a scalar subquery bound)."""
    return v if isinstance(v, Column) else F.lit(v)


def tier(value: str | Column, tiers: Sequence[tuple[str, float]], default: str = REFERENCE_DEFAULT_TIER) -> Column:
    """First label whose threshold the value strictly exceeds; NULL falls to ``default``."""
    v = col_of(value)
    expr = None
    for label, threshold in tiers:
        cond = v > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as DOUBLE with a zero denominator replaced by 1 (NULL stays NULL)."""
    n = col_of(num).cast("double")
    d = col_of(den).cast("double")
    return n / F.when(d == 0, F.lit(1.0)).otherwise(d)


def contains_token(text: str | Column, token: str) -> Column:
    """TRUE when ``token`` occurs in the text; NULL text counts as FALSE."""
    return F.coalesce(F.instr(col_of(text), token), F.lit(0)) > 0


def clock_minutes(text: str | Column) -> Column:
    """'mm:ss' text to fractional minutes; malformed or NULL text gives NULL."""
    t = col_of(text)
    mm = F.split_part(t, F.lit(":"), F.lit(1)).try_cast("double")
    ss = F.split_part(t, F.lit(":"), F.lit(2)).try_cast("double")
    return mm + ss / F.lit(60.0)


def json_object(fields: dict[str, str | Column]) -> Column:
    """JSON text of the named fields, keeping NULL fields as JSON null."""
    return F.to_json(F.struct(*[col_of(v).alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def json_field(text: str | Column, key: str, dtype: str | None = None) -> Column:
    v = F.get_json_object(col_of(text), f"$.{key}")
    return v.cast(dtype) if dtype else v


def json_struct(text: str | Column, schema_ddl: str) -> Column:
    """Parse a JSON property bag once into a struct (cheaper than one
    ``get_json_object`` per field, which re-parses the text each time)."""
    return F.from_json(col_of(text), schema_ddl)


def typed_object(fields: dict[str, str | Column]) -> Column:
    """VARIANT of the named fields: values keep their types and are read back without parsing text."""
    return F.to_variant_object(F.struct(*[col_of(v).alias(k) for k, v in fields.items()]))


def typed_field(bag: str | Column, key: str, dtype: str = "string") -> Column:
    """A VARIANT's field as ``dtype``; absent, null or not convertible gives NULL."""
    return F.try_variant_get(col_of(bag), f"$.{key}", dtype)


def all_null_safe_equal(left: Iterable[Column], right: Iterable[Column]) -> Column:
    conds = [a.eqNullSafe(b) for a, b in zip(left, right, strict=True)]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def any_of(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def date_lit(d: _dt.date | str) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def render_list(arr: str | Column, field: str | None = None, sep: str = ",") -> Column:
    """Array (optionally of structs) to delimited text, for scalar-only reports."""
    a = col_of(arr)
    if field is not None:
        a = F.transform(a, lambda x: x[field])
    return F.array_join(F.transform(a, lambda x: x.cast("string")), sep)


def iso_date(c: str | Column) -> Column:
    """DATE rendered as 'YYYY-MM-DD' text (engine-neutral in reports)."""
    return col_of(c).cast("string")
