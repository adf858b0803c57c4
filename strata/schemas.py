"""Declared schemas of the modelled tables, and checks against them.

The data model fixes every table's schema up front (composite and enum types
first, then tables). Spark has no CREATE TYPE, so composite types are
``StructType`` constants and enums are string columns with a checked domain.
``conform`` writes "INSERT ... SELECT" by name, never by position.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Enum domains of the data model.
SCORING_CLASS = ("star", "good", "avg", "bad")
VERTEX_TYPE = ("player", "team", "game")
EDGE_TYPE = ("plays_against", "shares_team", "plays_in", "plays_on")


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# composite types
SEASON_STATS = _s(("season", IntegerType()), ("gp", IntegerType()), ("pts", DoubleType()), ("reb", DoubleType()), ("ast", DoubleType()))
SCD_TYPE = _s(("scoring_class", StringType()), ("is_active", BooleanType()), ("start_season", IntegerType()), ("end_season", IntegerType()))

# tables
PLAYERS = _s(
    ("player_name", StringType()),
    ("height", StringType()),
    ("college", StringType()),
    ("country", StringType()),
    ("draft_year", StringType()),
    ("draft_round", StringType()),
    ("draft_number", StringType()),
    ("season_stats", ArrayType(SEASON_STATS)),
    ("scoring_class", StringType()),
    ("years_since_last_season", IntegerType()),
    ("is_active", BooleanType()),
    ("current_season", IntegerType()),
)
PLAYERS_SCD = _s(
    ("player_name", StringType()),
    ("scoring_class", StringType()),
    ("is_active", BooleanType()),
    ("start_season", IntegerType()),
    ("end_season", IntegerType()),
    ("current_season", IntegerType()),
)
VERTICES = _s(("identifier", StringType()), ("type", StringType()), ("properties", StringType()))
EDGES = _s(
    ("subject_identifier", StringType()),
    ("subject_type", StringType()),
    ("object_identifier", StringType()),
    ("object_type", StringType()),
    ("edge_type", StringType()),
    ("properties", StringType()),
)
FCT_GAME_DETAILS = _s(
    ("dim_game_date", DateType()),
    ("dim_season", IntegerType()),
    ("dim_team_id", IntegerType()),
    ("dim_player_id", LongType()),
    ("dim_player_name", StringType()),
    ("dim_start_position", StringType()),
    ("dim_is_playing_at_home", BooleanType()),
    ("dim_did_not_play", BooleanType()),
    ("dim_did_not_dress", BooleanType()),
    ("dim_not_with_team", BooleanType()),
    ("m_minutes", DoubleType()),
    *[(f"m_{m}", IntegerType()) for m in
      ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "turnovers", "pf", "pts",
       "plus_minus")],
)
USERS_CUMULATED = _s(("user_id", LongType()), ("dates_active", ArrayType(DateType())), ("date", DateType()))
ARRAY_METRICS = _s(
    ("user_id", LongType()), ("month_start", DateType()), ("metric_name", StringType()), ("metric_array", ArrayType(LongType())),
    ("as_of", DateType()),
)

PRIMARY_KEYS = {
    "players": ("player_name", "current_season"),
    "players_scd": ("player_name", "start_season", "current_season"),
    "vertices": ("identifier", "type"),
    "edges": ("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"),
    "fct_game_details": ("dim_game_date", "dim_team_id", "dim_player_id"),
    "users_cumulated": ("user_id", "date"),
    "array_metrics": ("user_id", "month_start", "metric_name", "as_of"),
}

TABLES = {
    "players": PLAYERS,
    "players_scd": PLAYERS_SCD,
    "vertices": VERTICES,
    "edges": EDGES,
    "fct_game_details": FCT_GAME_DETAILS,
    "users_cumulated": USERS_CUMULATED,
    "array_metrics": ARRAY_METRICS,
}

# enum columns of the tables
DOMAINS = {
    "players": {"scoring_class": SCORING_CLASS},
    "players_scd": {"scoring_class": SCORING_CLASS},
    "vertices": {"type": VERTEX_TYPE},
    "edges": {"subject_type": VERTEX_TYPE, "object_type": VERTEX_TYPE, "edge_type": EDGE_TYPE},
}


def conform(df: DataFrame, schema: StructType, rename: dict[str, str] | None = None) -> DataFrame:
    """Select ``schema``'s columns by name, cast to the declared types.

    ``rename`` maps a column of ``df`` to its declared name.

    Declared columns missing from ``df`` become typed NULLs; extra columns are dropped.
    """
    rename = rename or {}
    src = {rename.get(c, c): c for c in df.columns}
    cols = []
    for f in schema.fields:
        if f.name in src:
            cols.append(F.col(src[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def domain_violations(df: DataFrame, column: str, domain: Iterable[str]) -> DataFrame:
    """Rows whose ``column`` is non-NULL and outside ``domain`` (empty = valid enum column)."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(domain)))


def enforce_domains(df: DataFrame, domains: dict[str, Iterable[str]]) -> DataFrame:
    """``df``, failing at run time on a value outside its enum: checked in the projection, no extra pass."""
    checked = {}
    for name, domain in domains.items():
        wrong = F.col(name).isNotNull() & ~F.col(name).isin(list(domain))
        message = F.concat(F.lit(f"{name} is outside its domain: "), F.col(name))
        checked[name] = F.when(wrong, F.raise_error(message).cast("string")).otherwise(F.col(name))
    return df.withColumns(checked)
