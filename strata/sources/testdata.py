"""Parquet sources and the adapter views that map testdata onto the reference's
source tables (player seasons, games, game details, teams, web hits).

Each view is written with the DataFrame API so the optimizer sees plain
scans: filters on the view push into the Parquet readers, and only the
columns a view needs are read. The SQL twins of these views live in
``strata.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import dedup_first, grain_counts

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c):
    return F.round(F.col(c) * 100).cast("bigint")


def entity_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, order year): stands for player seasons.

    Orders are aggregated to (customer, year) before the customer join, so a
    customer holding a large share of all orders is collapsed by the partial
    (map-side) aggregate and never lands whole in one join task.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderpriority", _cents("o_totalprice").alias("cents")
    )
    per_year = orders.groupBy(
        F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").cast("int").alias("period")
    ).agg(
        F.min("o_orderpriority").alias("top_priority"),
        F.count(F.lit(1)).alias("n"),
        F.sum("cents").alias("total_cents"),
        F.max("cents").alias("reb"),
        F.min("cents").alias("ast"),
    )
    customer = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return per_year.join(customer, "entity_id").select(
        "entity_id",
        "period",
        "name",
        "segment",
        "top_priority",
        F.col("n").cast("int").alias("gp"),
        F.floor(F.col("total_cents") / F.col("n")).cast("bigint").alias("pts"),
        "reb",
        "ast",
    )


def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(period): first and last order year of every customer, for the bounds of ``entity_periods``.

    Two values per customer leave the partial aggregate; of the customer table only the key is read.
    """
    orders = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    customer = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    ends = orders.join(customer, "o_custkey", "left_semi")
    return ends.select(F.explode(F.array("first", "last")).alias("day")).select(F.year("day").cast("int").alias("period"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: game date, season and the customer's nation as home team."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        F.col("c_nationkey").alias("home_team_id"),
    )


def _player_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier and nation, one row per player: (player_id, player_name, team_id, team_abbreviation).

    A repeated supplier or nation row would repeat every line that joins it; the first by name, team and
    abbreviation stands for the player, and ``player_dimension_counts`` tells which repeat.
    """
    return dedup_first(_player_rows(spark, sf_dir), "player_id", ["player_name", "team_id", "team_abbreviation"])


def player_dimension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, num_rows) of the dimension that lines are joined with."""
    return grain_counts(_player_rows(spark, sf_dir), "player_id")


def _player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        F.col("s_nationkey").alias("team_id"),
        F.col("n_name").alias("team_abbreviation"),
    )


def _detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as box-score lines, before the player's dimension is joined."""
    li = read_table(spark, sf_dir, "lineitem")
    qty, line, part = F.col("l_quantity").cast("int"), F.col("l_linenumber"), F.col("l_partkey")

    def number(value):
        return value.cast("int")

    # the source has no box score: every measure is a fixed function of the line
    made, three, free = number(part % 15), number(part % 5), number(F.col("l_suppkey") % 8)
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("l_linestatus").alias("start_position"),
        F.when(F.col("l_returnflag") == "A", F.lit("DNP - Coach Decision"))
        .when((F.col("l_returnflag") == "R") & (line % 2 == 0), F.lit("NWT - Not With Team"))
        .when(F.col("l_returnflag") == "R", F.lit("DND - Did Not Dress"))
        .alias("comment"),
        F.when(
            F.col("l_returnflag") != "A",
            F.concat(qty.cast("string"), F.lit(":"), F.lpad((line * 7).cast("string"), 2, "0")),
        ).alias("min"),
        made.alias("fgm"),
        (made + line).alias("fga"),
        three.alias("fg3m"),
        (three + 2).alias("fg3a"),
        free.alias("ftm"),
        (free + 1).alias("fta"),
        number(line % 3).alias("oreb"),
        (line - number(line % 3)).alias("dreb"),
        line.alias("reb"),
        F.round(F.col("l_discount") * 100).cast("int").alias("ast"),
        number(F.col("l_orderkey") % 4).alias("stl"),
        number(F.col("l_orderkey") % 3).alias("blk"),
        number(part % 7).alias("TO"),
        number(line % 6).alias("pf"),
        qty.alias("pts"),
        (qty - 25).alias("plus_minus"),
        line.alias("ord_line"),
        part.alias("ord_part"),
        F.col("l_extendedprice").alias("ord_price"),
        F.col("l_shipdate").alias("ord_ship"),
    )


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: player = supplier, team = supplier's nation.

    ``ord_*`` columns give the total order used to pick one row per key.
    """
    return _detail_lines(spark, sf_dir).join(_player_dimension(spark, sf_dir), "player_id")


def game_detail_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, team_id, player_id, num_rows): ``game_details`` counted per game and player.

    A player has one team, so the count runs below the player join: partial
    sums per (game, player) leave no player's lines whole in one task.
    """
    counts = grain_counts(_detail_lines(spark, sf_dir), ["game_id", "player_id"])
    team = _player_dimension(spark, sf_dir).select("player_id", "team_id")
    return counts.join(team, "player_id").select("game_id", "team_id", "player_id", "num_rows")


def player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``game_details`` reduced to its first row per (game, player).

    The reduction runs below the player join, with a partial limit before its
    shuffle on (game, player); the many-to-one join comes last, so nothing
    above it needs a player's rows together.
    """
    first = dedup_first(_detail_lines(spark, sf_dir), ["game_id", "player_id"], GAME_DETAIL_ORDER)
    return first.join(_player_dimension(spark, sf_dir), "player_id")


GAME_DETAIL_ORDER = ["ord_line", "ord_part", "ord_price", "ord_ship"]


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier, so team_id repeats; ``ord_supp`` orders the dedup."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_nationkey").alias("team_id"),
            F.col("n_name").alias("abbreviation"),
            F.col("s_name").alias("nickname"),
            F.col("r_name").alias("city"),
            F.concat(F.lit("Arena "), F.col("s_name")).alias("arena"),
            (F.lit(1900) + F.col("s_suppkey") % 100).cast("int").alias("yearfounded"),
            F.col("s_suppkey").alias("ord_supp"),
        )
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web hits; error events stand for anonymous hits (NULL user)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    return ev.select(
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
        F.col("ts").alias("event_time"),
        "event_type",
    )
