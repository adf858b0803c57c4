"""Fact-table construction and a conditional rate over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clock_minutes, col_of, contains_token
from .quality import dedup_first

# Comment tokens and the flags they set.
COMMENT_FLAGS = {"dim_did_not_play": "DNP", "dim_did_not_dress": "DND", "dim_not_with_team": "NWT"}

# Measures of the fact table, source column -> fact column (``m_`` prefix).
DEFAULT_MEASURES = {
    "fgm": "m_fgm",
    "fga": "m_fga",
    "fg3m": "m_fg3m",
    "fg3a": "m_fg3a",
    "ftm": "m_ftm",
    "fta": "m_fta",
    "oreb": "m_oreb",
    "dreb": "m_dreb",
    "reb": "m_reb",
    "ast": "m_ast",
    "stl": "m_stl",
    "blk": "m_blk",
    "TO": "m_turnovers",
    "pf": "m_pf",
    "pts": "m_pts",
    "plus_minus": "m_plus_minus",
}


def comment_flags(details: DataFrame) -> DataFrame:
    """``details`` with the three comment flags (NULL comment -> FALSE)."""
    return details.withColumns({name: contains_token("comment", token) for name, token in COMMENT_FLAGS.items()})


def build_fact(
    details: DataFrame,
    games: DataFrame,
    order: Sequence[str] | None,
    grain: Sequence[str] = ("game_id", "team_id", "player_id"),
    measures: dict[str, str] | None = None,
) -> DataFrame:
    """Game-detail fact at (game, team, player) grain with ``dim_``/``m_`` columns.

    The grain holds for repeated rows on either side: a game's header is its
    earliest one (by date, then season, then home team), a player's line the
    first under ``order``. Both sides are reduced before they are joined: the
    details on the whole (game, team, player) key with a partial group limit
    before the shuffle, so a game with very many rows is spread over many
    tasks, and the join moves only surviving rows. With ``order=None`` the
    details are at the grain already and are not reduced again.
    Derived columns: home flag (team = home team), three comment flags
    (NULL comment -> FALSE) and minutes from 'mm:ss' text (bad text -> NULL).
    A measure absent from ``details`` is an error.
    """
    measures = measures or DEFAULT_MEASURES
    if missing := [c for c in measures if c not in details.columns]:
        raise ValueError(f"details lack the measures {missing}")
    header = ["game_date_est", "season", "home_team_id"]
    g = dedup_first(games.select("game_id", *header), "game_id", header)
    deduped = dedup_first(details, list(grain), order) if order else details
    j = deduped.join(g, "game_id")
    return j.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        *[contains_token("comment", tok).alias(name) for name, tok in COMMENT_FLAGS.items()],
        clock_minutes("min").alias("m_minutes"),
        *[col_of(src).alias(dst) for src, dst in measures.items()],
    )


def conditional_rate(
    fact: DataFrame,
    key: str,
    flag: str,
    hits_col: str = "times_nwt",
    total_col: str = "total_games_played",
    rate_col: str = "bailed_pct",
) -> DataFrame:
    """Per key, rows where ``flag`` is TRUE, all rows, and their ratio (highest first)."""
    agg = fact.groupBy(key).agg(
        F.sum(F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(hits_col),
        F.count(F.lit(1)).alias(total_col),
    )
    return agg.select(
        key, hits_col, total_col, (F.col(hits_col).cast("double") / F.col(total_col)).alias(rate_col)
    ).orderBy(F.col(rate_col).desc_nulls_first())
