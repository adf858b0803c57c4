"""SQL twins of the registered queries, for an independent engine (DuckDB)
reading the same Parquet tables.

They state each operator's contract directly in SQL -- closed forms instead
of folds (e.g. a snapshot as of P is "all rows with period <= P"), and the
full SCD rebuild as the oracle of the incremental one -- so a match checks
the Spark operators against a separate derivation, not against a
transliteration of themselves.
"""

from __future__ import annotations

# ---------------------------------------------------------------- adapter views

ENTITY_PERIODS = """
select o.o_custkey as entity_id, cast(year(o.o_orderdate) as int) as period,
 max(c.c_name) as name, max(c.c_mktsegment) as segment, min(o.o_orderpriority) as top_priority,
 cast(count(*) as int) as gp,
 cast(floor(cast(sum(cast(round(o.o_totalprice*100) as bigint)) as bigint) / count(*)) as bigint) as pts,
 max(cast(round(o.o_totalprice*100) as bigint)) as reb,
 min(cast(round(o.o_totalprice*100) as bigint)) as ast
from orders o join customer c on o.o_custkey = c.c_custkey
group by o.o_custkey, cast(year(o.o_orderdate) as int)
"""

GAMES = """
select o.o_orderkey as game_id, cast(o.o_orderdate as date) as game_date_est,
 cast(year(o.o_orderdate) as int) as season, c.c_nationkey as home_team_id
from orders o join customer c on o.o_custkey = c.c_custkey
"""

GAME_DETAILS = """
select l.l_orderkey as game_id, s.s_nationkey as team_id, n.n_name as team_abbreviation,
 l.l_suppkey as player_id, s.s_name as player_name, l.l_linestatus as start_position,
 case when l.l_returnflag = 'A' then 'DNP - Coach Decision'
      when l.l_returnflag = 'R' and l.l_linenumber % 2 = 0 then 'NWT - Not With Team'
      when l.l_returnflag = 'R' then 'DND - Did Not Dress' end as comment,
 case when l.l_returnflag <> 'A' then concat(cast(cast(l.l_quantity as int) as string), ':',
      lpad(cast(l.l_linenumber * 7 as string), 2, '0')) end as min,
 cast(l.l_partkey % 15 as int) as fgm, cast(l.l_partkey % 15 + l.l_linenumber as int) as fga,
 cast(l.l_partkey % 5 as int) as fg3m, cast(l.l_partkey % 5 + 2 as int) as fg3a,
 cast(l.l_suppkey % 8 as int) as ftm, cast(l.l_suppkey % 8 + 1 as int) as fta,
 cast(l.l_linenumber % 3 as int) as oreb, cast(l.l_linenumber - l.l_linenumber % 3 as int) as dreb,
 l.l_linenumber as reb, cast(round(l.l_discount*100) as int) as ast,
 cast(l.l_orderkey % 4 as int) as stl, cast(l.l_orderkey % 3 as int) as blk,
 cast(l.l_partkey % 7 as int) as turnovers, cast(l.l_linenumber % 6 as int) as pf,
 cast(l.l_quantity as int) as pts, cast(l.l_quantity as int) - 25 as plus_minus,
 l.l_linenumber as ord_line, l.l_partkey as ord_part, l.l_extendedprice as ord_price, l.l_shipdate as ord_ship
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey join nation n on s.s_nationkey = n.n_nationkey
"""

TEAMS = """
select s.s_nationkey as team_id, n.n_name as abbreviation, s.s_name as nickname, r.r_name as city,
 concat('Arena ', s.s_name) as arena, cast(1900 + s.s_suppkey % 100 as int) as yearfounded, s.s_suppkey as ord_supp
from supplier s join nation n on s.s_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
"""

HITS = """
select case when event_type = 'error' then null else user_id end as user_id, ts as event_time, event_type
from events
"""

CLASS_OF_LAST = """
 case when last_pts > 35000000 then 'star' when last_pts > 25000000 then 'good'
      when last_pts > 15000000 then 'avg' else 'bad' end"""

# snapshots of every entity from its first period to the last period
SNAPSHOTS = f"""
ep as ({ENTITY_PERIODS}),
ent as (
 select entity_id, min(period) as first_period, max(name) as name, max(segment) as segment,
        max(top_priority) as top_priority
 from ep group by entity_id),
grid as (
 select entity_id, name, segment, top_priority,
        cast(unnest(generate_series(first_period, (select max(period) from ep))) as int) as current_season
 from ent),
snap0 as (
 select g.entity_id, g.current_season, g.name as max_name, g.segment as max_segment,
        g.top_priority as max_top_priority,
        arg_max(p.name, p.period) filter (where p.name is not null) as last_name,
        arg_max(p.segment, p.period) filter (where p.segment is not null) as last_segment,
        arg_max(p.top_priority, p.period) filter (where p.top_priority is not null) as last_top_priority,
        cast(count(*) as int) as n_seasons,
        string_agg(cast(p.period as varchar), ',' order by p.period) as seasons,
        string_agg(cast(p.gp as varchar), ',' order by p.period) as gp_history,
        string_agg(cast(p.pts as varchar), ',' order by p.period) as pts_history,
        string_agg(cast(p.reb as varchar), ',' order by p.period) as reb_history,
        string_agg(cast(p.ast as varchar), ',' order by p.period) as ast_history,
        arg_max(p.pts, p.period) as last_pts, arg_min(p.pts, p.period) as first_pts,
        max(p.period) as last_period
 from grid g join ep p on p.entity_id = g.entity_id and p.period <= g.current_season
 group by g.entity_id, g.current_season, g.name, g.segment, g.top_priority),
snap as (
 select *, {CLASS_OF_LAST} as scoring_class,
        cast(current_season - last_period as int) as years_since_last_season,
        (last_period = current_season) as is_active
 from snap0)
"""

SNAPSHOT_COLUMNS = """n_seasons, seasons, gp_history, pts_history, reb_history, ast_history,
       scoring_class, years_since_last_season, is_active"""

STREAKS = """
ind as (
 select entity_id, current_season, scoring_class, is_active,
        case when scoring_class <> lag(scoring_class) over w or is_active <> lag(is_active) over w
             then 1 else 0 end as change_indicator
 from snap where current_season <= {as_of}
 window w as (partition by entity_id order by current_season)),
st as (
 select *, sum(change_indicator) over (partition by entity_id order by current_season) as streak_identifier
 from ind)
"""

LAST_PERIOD = "(select max(period) from ep)"

DETAILS_DEDUP = f"""
gd as ({GAME_DETAILS}),
pd as (
 select *, row_number() over (partition by player_id, game_id
                              order by ord_line, ord_part, ord_price, ord_ship) as rn
 from gd),
f as (select player_id, game_id, player_name, team_id, team_abbreviation, start_position, pts from pd where rn = 1),
pv as (
 select player_id, max(player_name) as player_name, count(*) as number_of_games, sum(pts) as total_points
 from f group by player_id)
"""

# from the member list of each game: every member against the ones listed before it
PAIRS = """
members as (
 select game_id, list({'id': player_id, 'team': team_abbreviation, 'pts': pts} order by player_id) as m
 from f group by game_id),
later as (select game_id, m, unnest(range(2, len(m) + 1)) as i from members where len(m) > 1),
met as (select m[i] as s, unnest(m[1:i - 1]) as o from later),
pairs as (
 select cast(s.id as varchar) as subject_identifier, 'player' as subject_type,
        cast(o.id as varchar) as object_identifier, 'player' as object_type,
        if(s.team = o.team, 'shares_team', 'plays_against') as edge_type,
        count(*) as num_games, cast(sum(s.pts) as bigint) as subject_points,
        cast(sum(o.pts) as bigint) as object_points
 from met group by all)
"""

VERTEX_KV = f"""
{DETAILS_DEDUP},
tm as (
 select *, row_number() over (partition by team_id order by ord_supp) as rn from ({TEAMS})),
g as ({GAMES}),
kv as (
 select cast(team_id as varchar) as identifier, 'team' as type, 'abbreviation' as prop_key,
        cast(abbreviation as varchar) as prop_value from tm where rn = 1
 union all select cast(team_id as varchar), 'team', 'nickname', cast(nickname as varchar) from tm where rn = 1
 union all select cast(team_id as varchar), 'team', 'city', cast(city as varchar) from tm where rn = 1
 union all select cast(team_id as varchar), 'team', 'arena', cast(arena as varchar) from tm where rn = 1
 union all select cast(team_id as varchar), 'team', 'year_founded', cast(yearfounded as varchar) from tm where rn = 1
 union all select cast(player_id as varchar), 'player', 'player_name', cast(player_name as varchar) from pv
 union all select cast(player_id as varchar), 'player', 'number_of_games', cast(number_of_games as varchar) from pv
 union all select cast(player_id as varchar), 'player', 'total_points', cast(total_points as varchar) from pv
 union all select cast(game_id as varchar), 'game', 'game_date', cast(game_date_est as varchar) from g
 union all select cast(game_id as varchar), 'game', 'season', cast(season as varchar) from g
 union all select cast(game_id as varchar), 'game', 'home_team_id', cast(home_team_id as varchar) from g)
"""

MEASURES = (
    "fgm fga fg3m fg3a ftm fta oreb dreb reb ast stl blk turnovers pf pts plus_minus"
).split()

# the header is joined first, one row per grain is picked from the joined rows
FACT = f"""
picked as (
 select game_id, team_id, player_id,
        arg_min(j, row(game_date_est, season, home_team_id, ord_line, ord_part, ord_price, ord_ship)) as j
 from (select d.*, g.game_date_est, g.season, g.home_team_id
       from ({GAME_DETAILS}) d join ({GAMES}) g on d.game_id = g.game_id) j
 group by game_id, team_id, player_id),
fact as (
 select j.game_date_est as dim_game_date, j.season as dim_season, j.team_id as dim_team_id,
        j.player_id as dim_player_id, j.player_name as dim_player_name,
        j.start_position as dim_start_position, j.team_id = j.home_team_id as dim_is_playing_at_home,
        contains(coalesce(j.comment, ''), 'DNP') as dim_did_not_play,
        contains(coalesce(j.comment, ''), 'DND') as dim_did_not_dress,
        contains(coalesce(j.comment, ''), 'NWT') as dim_not_with_team,
        try_cast(split_part(j.min, ':', 1) as double) + try_cast(split_part(j.min, ':', 2) as double) / 60.0
          as m_minutes,
        {', '.join(f'j.{m} as m_{m}' for m in MEASURES)}
 from picked)
"""

USER_DAYS = f"""
h as ({HITS}),
ud as (select distinct user_id, cast(event_time as date) as d from h where user_id is not null)
"""

DAILY_HITS = f"""
h as ({HITS}),
daily as (
 select user_id, cast(event_time as date) as d, count(*) as n, count(distinct event_type) as kinds
 from h where user_id is not null group by user_id, cast(event_time as date)),
days as (
 select cast(unnest(generate_series((select min(d) from daily), (select max(d) from daily), interval 1 day))
             as date) as d),
months as (select cast(date_trunc('month', d) as date) as m, max(d) as last_d from days group by 1),
mu as (
 select distinct dl.user_id, mo.m, mo.last_d
 from daily dl join months mo on cast(date_trunc('month', dl.d) as date) = mo.m and dl.d <= mo.last_d)
"""

WEEK_MASK = ((1 << 7) - 1) << 25
TOP_BIT = 1 << 31

ORACLE_SQL: dict[str, str] = {
    "period_bounds": f"""
with ep as ({ENTITY_PERIODS})
select min(period) as min_period, max(period) as max_period from ep
""",
    "grain_check": f"""
with gd as ({GAME_DETAILS})
select game_id, team_id, player_id, count(*) as num_rows
from gd group by game_id, team_id, player_id having count(*) > 1
""",
    "grain_check_lineitem": """
select l_orderkey, l_linenumber, count(*) as num_rows
from lineitem group by l_orderkey, l_linenumber having count(*) > 1
""",
    "grain_check_player_game": f"""
with gd as ({GAME_DETAILS})
select player_id, game_id, count(*) as num_rows
from gd group by player_id, game_id having count(*) > 1
""",
    "grain_counts": f"""
with gd as ({GAME_DETAILS})
select player_id, game_id, count(*) as num_rows from gd group by player_id, game_id
""",
    "dedup_first": """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, cast(l_shipdate as varchar) as l_shipdate
from (
 select *, row_number() over (partition by l_orderkey, l_linenumber
   order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
            l_linestatus, l_shipdate) as rn
 from lineitem) x
where rn = 1
""",
    "cumulative_step": f"""
with {SNAPSHOTS}
select entity_id, current_season, last_name as name, last_segment as segment,
       last_top_priority as top_priority, {SNAPSHOT_COLUMNS}
from snap
""",
    "cumulative_backfill": f"""
with {SNAPSHOTS}
select entity_id, current_season, max_name as name, max_segment as segment,
       max_top_priority as top_priority, {SNAPSHOT_COLUMNS}
from snap
""",
    "history_explode": f"""
with ep as ({ENTITY_PERIODS})
select entity_id, period, gp, pts, reb, ast from ep
""",
    "first_vs_latest": f"""
with {SNAPSHOTS}
select entity_id, first_pts as first_season, last_pts as latest_season,
       cast(last_pts as double) / case when cast(first_pts as double) = 0 then 1.0
                                       else cast(first_pts as double) end as improvement
from snap
where current_season = {LAST_PERIOD} and scoring_class = 'star'
""",
    "snapshot_lookup": f"""
with {SNAPSHOTS}
select entity_id, scoring_class, is_active from snap where current_season = {LAST_PERIOD}
""",
    "detect_changes": f"""
with {SNAPSHOTS}
select entity_id, current_season, scoring_class, is_active,
       lag(scoring_class) over w as previous_scoring_class,
       lag(is_active) over w as previous_is_active,
       case when scoring_class <> lag(scoring_class) over w then 1 else 0 end
         as scoring_class_change_indicator,
       case when is_active <> lag(is_active) over w then 1 else 0 end as is_active_change_indicator
from snap
window w as (partition by entity_id order by current_season)
""",
    "streaks": f"""
with {SNAPSHOTS}, {STREAKS.format(as_of=LAST_PERIOD)}
select entity_id, cast(streak_identifier as bigint) as streak_identifier, is_active, scoring_class,
       min(current_season) as start_season, max(current_season) as end_season
from st group by entity_id, streak_identifier, is_active, scoring_class
""",
    "scd2_full": f"""
with {SNAPSHOTS}, {STREAKS.format(as_of=LAST_PERIOD)}
select entity_id, scoring_class, is_active, min(current_season) as start_season,
       max(current_season) as end_season, cast({LAST_PERIOD} as int) as current_season
from st group by entity_id, streak_identifier, is_active, scoring_class
""",
    "scd2_incremental": f"""
with {SNAPSHOTS}, {STREAKS.format(as_of=LAST_PERIOD)}
select entity_id, scoring_class, is_active, min(current_season) as start_season,
       max(current_season) as end_season, cast({LAST_PERIOD} as int) as current_season
from st group by entity_id, streak_identifier, is_active, scoring_class
""",
    "fact_game_details": f"""
with {FACT}
select cast(dim_game_date as varchar) as dim_game_date, dim_season, dim_team_id, dim_player_id,
       dim_player_name, dim_start_position, dim_is_playing_at_home, dim_did_not_play, dim_did_not_dress,
       dim_not_with_team, m_minutes, {', '.join(f'm_{m}' for m in MEASURES)}
from fact
""",
    "bailed_pct": f"""
with {FACT}
select dim_player_name,
       cast(sum(case when dim_not_with_team then 1 else 0 end) as bigint) as times_nwt,
       count(*) as total_games_played,
       cast(sum(case when dim_not_with_team then 1 else 0 end) as double) / count(*) as bailed_pct
from fact group by dim_player_name
""",
    "graph_vertices": f"""
with {VERTEX_KV}
select identifier, type, prop_key, prop_value from kv
""",
    "graph_vertex_counts": f"""
with {VERTEX_KV}
select type, count(*) as num_vertices
from (select distinct identifier, type from kv) v group by type
""",
    "graph_edges_plays_in": f"""
with {DETAILS_DEDUP}
select cast(player_id as varchar) as subject_identifier, 'player' as subject_type,
       cast(game_id as varchar) as object_identifier, 'game' as object_type, 'plays_in' as edge_type,
       start_position, pts, team_id, team_abbreviation
from f
""",
    "graph_edges_pairs": f"""
with {DETAILS_DEDUP}, {PAIRS}
select * from pairs
""",
    "graph_max_points": f"""
with {DETAILS_DEDUP}
select cast(player_id as varchar) as identifier, max(player_name) as player_name, max(pts) as max_pts
from f group by player_id
""",
    "graph_pair_report": f"""
with {DETAILS_DEDUP}, {PAIRS}
select pv.player_name, p.subject_identifier, p.object_identifier, p.edge_type,
       cast(pv.number_of_games as double) / case when cast(pv.total_points as double) = 0 then 1.0
                                                 else cast(pv.total_points as double) end as games_per_point,
       p.subject_points, p.num_games
from pairs p join pv on cast(pv.player_id as varchar) = p.subject_identifier
""",
    "activity_datelist": f"""
with {USER_DAYS},
uf as (select user_id, min(d) as first_day from ud group by user_id),
grid as (
 select user_id,
        cast(unnest(generate_series(first_day, (select max(d) from ud), interval 1 day)) as date)
          as snapshot_date
 from uf)
select g.user_id, cast(g.snapshot_date as varchar) as snapshot_date,
       string_agg(cast(u.d as varchar), ',' order by u.d desc) as dates_active,
       cast(count(*) as int) as n_dates
from grid g join ud u on u.user_id = g.user_id and u.d <= g.snapshot_date
group by g.user_id, g.snapshot_date
""",
    "activity_bitmap": f"""
with {USER_DAYS},
anchor as (select max(d) as a from ud),
b as (
 select user_id,
        cast(sum(case when (select a from anchor) - d between 0 and 31
                      then cast(1 as bigint) << (31 - ((select a from anchor) - d)) else 0 end) as bigint)
          as activity_bits
 from ud group by user_id)
select user_id, cast((select a from anchor) as varchar) as snapshot_date, activity_bits,
       lpad(bin(activity_bits), 32, '0') as activity_bit_string,
       cast(bit_count(activity_bits) as int) as dim_monthly_active_for_n_days,
       activity_bits <> 0 as dim_is_monthly_active,
       (activity_bits & {WEEK_MASK}) <> 0 as dim_is_weekly_active,
       (activity_bits & {TOP_BIT}) <> 0 as dim_is_daily_active
from b
""",
    "activity_bitmap_literal": f"""
with {USER_DAYS},
anchor as (select max(d) as a from ud),
series as (
 select cast(unnest(generate_series((select a from anchor) - interval 30 day, (select a from anchor),
                                    interval 1 day)) as date) as series_date),
hits_on_series as (
 select u.user_id, cast(1 as bigint) << (32 - ((select a from anchor) - s.series_date)) as v
 from ud u join series s on u.d = s.series_date),
b as (
 select uu.user_id, cast(coalesce(sum(h.v), 0) as bigint) & {(1 << 32) - 1} as activity_bits
 from (select distinct user_id from ud) uu left join hits_on_series h on h.user_id = uu.user_id
 group by uu.user_id)
select user_id, activity_bits,
       cast(bit_count(activity_bits) as int) as dim_monthly_active_for_n_days,
       activity_bits <> 0 as dim_is_monthly_active,
       (activity_bits & {WEEK_MASK}) <> 0 as dim_is_weekly_active,
       (activity_bits & {TOP_BIT}) <> 0 as dim_is_daily_active
from b
""",
    "array_metrics": f"""
with {DAILY_HITS},
grid as (
 select user_id, m, cast(unnest(generate_series(0, cast(last_d - m as bigint))) as int) as day_index from mu),
filled as (
 select g.user_id, cast(g.m as varchar) as month_start, g.day_index, coalesce(dl.n, 0) as site_hits,
        coalesce(dl.kinds, 0) as event_kinds
 from grid g left join daily dl on dl.user_id = g.user_id and dl.d = g.m + g.day_index)
select user_id, month_start, metric_name, day_index, value
from (unpivot filled on site_hits, event_kinds into name metric_name value value)
""",
    "array_metrics_daily": f"""
with {DAILY_HITS},
used as (select d from days where cast(date_trunc('month', d) as date) in (select m from mu)),
totals as (
 select cast(u.d as varchar) as metric_date, cast(coalesce(sum(dl.n), 0) as bigint) as site_hits,
        cast(coalesce(sum(dl.kinds), 0) as bigint) as event_kinds
 from used u left join daily dl on dl.d = u.d
 group by u.d)
select metric_name, metric_date, value
from (unpivot totals on site_hits, event_kinds into name metric_name value value)
""",
    "history_explode_one": f"""
with ep as ({ENTITY_PERIODS})
select entity_id, period, gp, pts, reb, ast from ep where entity_id = (select min(o_custkey) from orders)
""",
    "snapshot_lookup_star": f"""
with {SNAPSHOTS}
select entity_id, scoring_class, is_active from snap
where current_season = {LAST_PERIOD} and scoring_class = 'star' and is_active
""",
}

# the events-based plan of O18 has the same contract as the list-based one
ORACLE_SQL["activity_bitmap_events"] = ORACLE_SQL["activity_bitmap"]

# the forms that read one snapshot's history arrays, catch up or roll have the contracts of the plain ones
ORACLE_SQL["changes_from_history"] = ORACLE_SQL["detect_changes"]
ORACLE_SQL["streaks_from_history"] = ORACLE_SQL["streaks"]
ORACLE_SQL["scd2_from_history"] = ORACLE_SQL["scd2_full"]
ORACLE_SQL["scd2_catch_up"] = ORACLE_SQL["scd2_full"]
ORACLE_SQL["activity_bitmap_rolling"] = ORACLE_SQL["activity_bitmap"]
ORACLE_SQL["grain_check_player"] = """
select s.s_suppkey as player_id, count(*) as num_rows
from supplier s join nation n on s.s_nationkey = n.n_nationkey group by s.s_suppkey having count(*) > 1
"""
ORACLE_SQL["period_bounds_stored"] = ORACLE_SQL["period_bounds"]
ORACLE_SQL["graph_vertex_counts_stored"] = ORACLE_SQL["graph_vertex_counts"]
# the added column is NULL in the seasons that were written before it
ORACLE_SQL["snapshot_columns"] = f"""
with {SNAPSHOTS}
select entity_id, current_season, scoring_class, is_active,
       case when current_season > ((select min(period) from ep) + {LAST_PERIOD}) // 2
            then cast(list_sum(list_transform(string_split(gp_history, ','), lambda x: cast(x as bigint))) as bigint)
       end as games_so_far
from snap
"""
