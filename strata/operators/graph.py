"""Property graph: vertex and edge tables with JSON property bags.

Vertices are (identifier, type, properties); edges are (subject identifier
and type, object identifier and type, edge type, properties). Identifiers
are text; properties are JSON text written with ``to_json`` (NULL fields
kept) and read back with ``get_json_object``. With ``typed`` the builders
give a VARIANT instead, for jobs that read the properties again: nothing is
rendered as text or parsed, and ``with_text`` renders it where rows leave
Spark. The reports take either form. No traversal exists in the reference, so
everything is relational: group-bys and equi-joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions.columns import json_field, json_object, json_struct, safe_ratio, typed_field, typed_object
from ..schemas import EDGE_TYPE as EDGE_TYPES
from ..schemas import VERTEX_TYPE as VERTEX_TYPES
from .quality import dedup_first
from .skew import DEFAULT_CHUNK_ROWS, salted_self_join


def _bag(props: dict[str, str | Column], typed: bool) -> Column:
    return (typed_object(props) if typed else json_object(props)).alias("properties")


def _is_typed(df: DataFrame) -> bool:
    return isinstance(df.schema["properties"].dataType, VariantType)


def _field(df: DataFrame, key: str, dtype: str) -> Column:
    """One property of ``df``'s bags."""
    return typed_field("properties", key, dtype) if _is_typed(df) else json_field("properties", key, dtype)


def _fields(df: DataFrame, fields: dict[str, str]) -> Column:
    """Several properties of ``df``'s bags, as a struct; text is parsed once."""
    if _is_typed(df):
        return F.struct(*[typed_field("properties", k, dtype).alias(k) for k, dtype in fields.items()])
    return json_struct("properties", ", ".join(f"`{k}` {dtype}" for k, dtype in fields.items()))


def with_text(df: DataFrame) -> DataFrame:
    """Vertices or edges with their properties as JSON text (as they are, if they are text already)."""
    return df.withColumn("properties", F.to_json("properties")) if _is_typed(df) else df


def build_vertices(
    src: DataFrame,
    id_col: str,
    vertex_type: str,
    props: dict[str, str | Column],
    order: Sequence[str] | None = None,
    typed: bool = False,
) -> DataFrame:
    """One vertex per id (first row under ``order`` when ids repeat)."""
    if vertex_type not in VERTEX_TYPES:
        raise ValueError(f"unknown vertex type {vertex_type!r}")
    df = dedup_first(src, [id_col], order) if order else src
    return df.select(
        F.col(id_col).cast("string").alias("identifier"),
        F.lit(vertex_type).alias("type"),
        _bag(props, typed),
    )


def aggregate_vertices(
    src: DataFrame,
    id_col: str,
    vertex_type: str,
    aggs: dict[str, Column],
    static: Sequence[str] = (),
    typed: bool = False,
) -> DataFrame:
    """O09 for entities known only from a fact table: properties are aggregates.

    The id alone is the key: ``static`` columns (e.g. a name) take their
    largest value, so an id with two names is still one vertex.
    """
    if vertex_type not in VERTEX_TYPES:
        raise ValueError(f"unknown vertex type {vertex_type!r}")
    g = src.groupBy(id_col).agg(*[F.max(c).alias(c) for c in static], *[v.alias(k) for k, v in aggs.items()])
    props = {c: F.col(c) for c in static}
    props.update({k: F.col(k) for k in aggs})
    return g.select(
        F.col(id_col).cast("string").alias("identifier"),
        F.lit(vertex_type).alias("type"),
        _bag(props, typed),
    )


def vertex_type_counts(vertices: DataFrame, count_col: str = "num_vertices") -> DataFrame:
    """Rows per vertex type."""
    return vertices.groupBy("type").agg(F.count(F.lit(1)).alias(count_col))


def bipartite_edges(
    fact: DataFrame,
    subject: str,
    subject_type: str,
    obj: str,
    object_type: str,
    edge_type: str,
    props: dict[str, str | Column],
    order: Sequence[str] | None = None,
    typed: bool = False,
) -> DataFrame:
    """One edge per distinct (subject, object) pair of a fact table."""
    if edge_type not in EDGE_TYPES:
        raise ValueError(f"unknown edge type {edge_type!r}")
    df = dedup_first(fact, [subject, obj], order) if order else fact
    return df.select(
        F.col(subject).cast("string").alias("subject_identifier"),
        F.lit(subject_type).alias("subject_type"),
        F.col(obj).cast("string").alias("object_identifier"),
        F.lit(object_type).alias("object_type"),
        F.lit(edge_type).alias("edge_type"),
        _bag(props, typed),
    )


def cooccurrence_edges(
    fact: DataFrame,
    member: str,
    group: str,
    side: str,
    measure: str,
    order: Sequence[str] | None,
    member_type: str = "player",
    same_side: str = "shares_team",
    other_side: str = "plays_against",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    typed: bool = False,
    largest: int | None = None,
) -> DataFrame:
    """Edges between members that appear in the same group.

    Members are deduplicated per (member, group) first (skipped when
    ``order`` is None: the input is already at that grain), then paired inside
    each group with ``a.member > b.member`` (each unordered pair once). The
    edge type is ``same_side`` when both rows carry the same side value and
    ``other_side`` otherwise (also when a side is NULL). Per (a, b, type):
    number of shared groups and the sum of each member's measure.

    The pairs inside a group are the output itself (an edge list): a group of
    n members gives n(n-1)/2 of them, by contract. Large groups are split over
    several tasks by ``salted_self_join``, unless ``largest``, the counted size of
    the largest, is within ``chunk_rows``; the pair aggregate runs partially
    on the map side before its shuffle.
    """
    cols = [member, group, side, measure]
    if order:
        deduped = dedup_first(fact.select(*cols, *order), [member, group], order).select(*cols)
    else:  # caller guarantees one row per (member, group)
        deduped = fact.select(*cols)
    pairs = salted_self_join(
        deduped,
        [group],
        salt_source=member,
        condition=F.col(f"a.{member}") > F.col(f"b.{member}"),
        chunk_rows=chunk_rows,
        largest=largest,
    )
    same = F.coalesce(F.col(f"a.{side}") == F.col(f"b.{side}"), F.lit(False))  # the type's text follows the shuffle
    agg = pairs.groupBy(F.col(f"a.{member}").alias("_s"), F.col(f"b.{member}").alias("_o"), same.alias("_same")).agg(
        F.count(F.lit(1)).alias("num_games"),
        F.sum(F.col(f"a.{measure}")).alias("subject_points"),
        F.sum(F.col(f"b.{measure}")).alias("object_points"),
    )
    return agg.select(
        F.col("_s").cast("string").alias("subject_identifier"),
        F.lit(member_type).alias("subject_type"),
        F.col("_o").cast("string").alias("object_identifier"),
        F.lit(member_type).alias("object_type"),
        F.when(F.col("_same"), F.lit(same_side)).otherwise(F.lit(other_side)).alias("edge_type"),
        _bag({"num_games": "num_games", "subject_points": "subject_points", "object_points": "object_points"}, typed),
    )


def vertex_edge_max(
    vertices: DataFrame,
    edges: DataFrame,
    prop: str,
    label_prop: str,
    dtype: str = "bigint",
    edge_type: str | None = None,
    out_label: str | None = None,
    out_value: str | None = None,
) -> DataFrame:
    """Per vertex, the largest numeric edge property over its outgoing edges.

    Values are compared as numbers (text comparison would rank '9' above
    '10'). Edges are reduced to one row per subject before the join, so a
    vertex with very many edges costs one partial maximum per task.
    """
    out_label = out_label or label_prop
    out_value = out_value or f"max_{prop}"
    e = edges if edge_type is None else edges.where(F.col("edge_type") == F.lit(edge_type))
    best = e.groupBy("subject_identifier", "subject_type").agg(
        F.max(_field(e, prop, dtype)).alias(out_value)
    )
    v = vertices.select(
        F.col("identifier").alias("subject_identifier"),
        F.col("type").alias("subject_type"),
        _field(vertices, label_prop, "string").alias(out_label),
    )
    return v.join(best, ["subject_identifier", "subject_type"]).select(
        F.col("subject_identifier").alias("identifier"), out_label, out_value
    )


def vertex_edge_report(
    vertices: DataFrame,
    edges: DataFrame,
    object_type: str = "player",
    label_prop: str = "player_name",
    num_prop: str = "number_of_games",
    den_prop: str = "total_points",
    ratio_col: str = "games_per_point",
) -> DataFrame:
    """Each edge to an ``object_type`` vertex with its subject's ratio and edge properties."""
    vp = _fields(vertices, {label_prop: "string", num_prop: "double", den_prop: "double"})
    v = vertices.select(
        F.col("identifier").alias("subject_identifier"), F.col("type").alias("subject_type"), vp.alias("vp")
    ).select(
        "subject_identifier",
        "subject_type",
        F.col(f"vp.{label_prop}").alias(label_prop),
        safe_ratio(F.col(f"vp.{num_prop}"), F.col(f"vp.{den_prop}")).alias(ratio_col),
    )
    e = edges.where(F.col("object_type") == F.lit(object_type)).select(
        "subject_identifier",
        "subject_type",
        "object_identifier",
        "edge_type",
        _fields(edges, {"subject_points": "bigint", "num_games": "bigint"}).alias("ep"),
    )
    return v.join(e, ["subject_identifier", "subject_type"]).select(
        label_prop, "subject_identifier", "object_identifier", "edge_type", ratio_col, "ep.subject_points", "ep.num_games"
    )
