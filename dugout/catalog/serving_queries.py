"""Read queries and run analytics over the stand-in models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import dims, runs, serving
from . import frames as fr
from . import model_queries as M
from .registry import query, table

_TEAM = f"tm as ({fr.TEAMS_SQL})"


def star(spark, sf):
    """The tables the read queries need, lazily."""
    teams = dims.dim_teams(fr.teams(spark, sf).withColumn("abbreviation", F.concat(F.lit("T"), F.col("id").cast("string"))))
    return {"dim_games": dims.dim_games(fr.games(spark, sf)), "dim_teams": teams}


@query("serve_seasons", "select distinct cast(year(o_orderdate) as int) as season from orders")
def q_seasons(spark, sf):
    return serving.seasons({"dim_season": M.season_rows(spark, sf)})


@query("serve_teams", f"with {_TEAM} select id as team_id, name as team_name, 'T' || id as abbreviation, max(season) as season from tm group by 1, 2, 3")
def q_teams(spark, sf):
    return serving.teams(star(spark, sf))


@query(
    "serve_games_by_season",
    f"""with {M.GAMES_CTE}, {_TEAM} select g.game_pk, g.game_date, g.season, g.home_team_id, g.away_team_id, 'T' || hk.id as home_team_abbr, 'T' || ak.id as away_team_abbr from gm g
      join tm hk on hk.id = g.home_team_id and hk.season = g.season join tm ak on ak.id = g.away_team_id and ak.season = g.season""",
)
def q_games(spark, sf):
    return serving.games_by_season(star(spark, sf))


@query(
    "serve_game_matchups",
    f"""with {M.GAMES_CTE}, {_TEAM} select g.game_pk, g.game_date, g.home_team_id, g.away_team_id, hk.name as home_team_name, ak.name as away_team_name from gm g
      left join tm hk on hk.id = g.home_team_id and hk.season = g.season left join tm ak on ak.id = g.away_team_id and ak.season = g.season""",
)
def q_matchups(spark, sf):
    return serving.game_matchup(star(spark, sf))


@query(
    "serve_game_players_stats",
    f"""with {M.LINES_CTE}, r as (select game_pk, player_id, team_name, is_home,
      (coalesce(pitching_outs_recorded, 0) > 0 or pitching_hits_allowed > 0 or pitching_runs_allowed > 0 or pitching_earned_runs > 0 or pitching_walks > 0 or pitching_strikeouts > 0 or pitching_home_runs_allowed > 0) as p,
      (coalesce(batting_at_bats, 0) > 0 or batting_runs > 0 or batting_hits > 0 or batting_doubles > 0 or batting_triples > 0 or batting_home_runs > 0 or batting_rbi > 0 or batting_walks > 0 or batting_strikeouts > 0 or batting_stolen_bases > 0 or batting_left_on_base > 0) as b,
      (fielding_putouts > 0 or fielding_assists > 0 or fielding_errors > 0 or fielding_chances > 0) as f, pitching_outs_recorded,
      case when pitching_outs_recorded is not null then (pitching_outs_recorded // 3) || '.' || (pitching_outs_recorded % 3) end as innings_pitched from ln)
    select game_pk, player_id, team_name, is_home, case when p and b then 'Both' when p then 'Pitcher' when f or b then 'Batter/Fielder' end as player_role, pitching_outs_recorded, innings_pitched from r where p or b or f""",
)
def q_game_players_stats(spark, sf):
    t = {"dim_player_stats": dims.dim_player_stats(M.player_lines(spark, sf))}
    return serving.game_players_stats(t).select("game_pk", "player_id", "team_name", "is_home", "player_role", "pitching_outs_recorded", "innings_pitched")


@query(
    "serve_game_players",
    "select distinct l_orderkey as game_pk, player_id, 'B' || player_id as full_name from (select l_orderkey, l_partkey as player_id from lineitem union all select l_orderkey, l_suppkey from lineitem) where player_id in (select p_partkey from part)",
)
def q_game_players(spark, sf):
    ab = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("game_pk"), F.col("l_partkey").alias("batter_id"), F.col("l_suppkey").alias("pitcher_id"))
    who = table(spark, sf, "part").select(F.col("p_partkey").alias("player_id"), F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("full_name"), F.lit(None).cast("string").alias("position__name"))
    return serving.game_players({"fact_at_bats": ab, "dim_player": who}).drop("position__name")


@query(
    "serve_team_venues",
    f"""with g0 as ({fr.GAMES_SQL}), {_TEAM}, v as (select distinct cast(venue__id as varchar) as venue_id, venue__name as venue_name from g0)
    select tm.id as team_id, tm.season, v.venue_name from tm join v on v.venue_id = cast(tm.venue__id as varchar)""",
)
def q_team_venues(spark, sf):
    t = {"dim_teams": star(spark, sf)["dim_teams"], "dim_venue": M.venues(M.game_codes(spark, sf))}
    return serving.team_venue(t).select("team_id", "season", "venue_name")


_ANCHOR = "(select max(o_orderkey) from orders where o_orderstatus <> 'P')"


@query(
    "serve_ytd_batting",
    f"""with {M.LINES_CTE}, cur as (select * from gm where game_pk = (select max(game_pk) from ln)), who as (select min(player_id) as player_id from ln where game_pk = (select max(game_pk) from ln))
    select count(distinct s.game_pk) as games_played, {M.isum('s.batting_at_bats', 'at_bats')}, {M.isum('s.batting_runs', 'runs')}, {M.isum('s.batting_hits', 'hits')}, {M.isum('s.batting_doubles', 'doubles')},
      {M.isum('s.batting_triples', 'triples')}, {M.isum('s.batting_home_runs', 'home_runs')} from ln s join gm g on g.game_pk = s.game_pk, cur, who
    where s.player_id = who.player_id and g.season = cur.season and g.game_type = cur.game_type and g.game_datetime <= cur.game_datetime""",
)
def q_ytd(spark, sf):
    lines = M.player_lines(spark, sf)
    # The anchor is the newest game in the data and its first player.
    top = lines.agg(F.max_by(F.struct("game_pk", "player_id"), F.struct("game_pk", (-F.col("player_id")).alias("p"))).alias("a")).first()["a"]
    t = {"int_player_game_stats": lines, "dim_games": dims.dim_games(fr.games(spark, sf))}
    return serving.player_ytd_batting(t, top["game_pk"], top["player_id"]).drop("avg")


WON = "result = 'W'"


@query("serve_game_team_records", f"with {M.RESULTS_CTE} select game_pk, team_id, is_home, result, {M._run(WON, 'team_id, season, venue_id', 'wins_to_date_venue')} from res")
def q_team_records(spark, sf):
    from ..plans import intermediate

    t = {"int_team_game_results_to_date": intermediate.int_team_game_results_to_date(M.results(spark, sf))}
    return serving.game_team_records(t).select("game_pk", "team_id", "is_home", "result", "wins_to_date_venue")


# ---- run analytics: events as a run log ---------------------------------------------------------

_RUNS = """r as (select event_id as id, cast(user_id % 7 as varchar) as run_id, 'model_' || user_id as model_name, case user_id % 4 when 0 then 'dimension' when 1 then 'fact' when 2 then 'mart' else 'other' end as model_layer,
  case event_type when 'error' then 'failure' else 'success' end as status, cast(json_extract_string(props, '$.k') as bigint) as start_record_count, event_id % 50 as records_added,
  cast(json_extract_string(props, '$.k') as bigint) + event_id % 50 + (case when event_id % 3 = 0 then 1 else 0 end) as end_record_count, value as elapsed_seconds, ts as start_time, ts as created_at from events)"""


def run_log(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    added = F.col("event_id") % 50
    u = F.col("user_id") % 4
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % 7).cast("string").alias("run_id"),
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model_name"),
        F.when(u == 0, "dimension").when(u == 1, "fact").when(u == 2, "mart").otherwise("other").alias("model_layer"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"),
        k.alias("start_record_count"),
        added.alias("records_added"),
        (k + added + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)).alias("end_record_count"),
        F.col("value").alias("elapsed_seconds"),
        F.col("ts").alias("start_time"),
        F.col("ts").alias("created_at"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _as_of(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _retired(spark, sf):
    """Models of users without a purchase."""
    log = table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    return log.where("n = 0").select(F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model_name"))


@query("runs_latest_per_model", f"with {_RUNS} select * from r where id in (select max(id) from r group by model_name)")
def q_latest_runs(spark, sf):
    return runs.latest_runs(run_log(spark, sf), _retired(spark, sf)).drop("error_message")


@query(
    "runs_failure_rates",
    f"""with {_RUNS} select model_name, count(*) as total_runs, cast(sum(case when status = 'failure' then 1 else 0 end) as bigint) as failures,
      cast(round(cast(sum(case when status = 'failure' then 1 else 0 end) as decimal(18,4)) * 100 / count(*), 2) as decimal(5,2)) as failure_rate_pct,
      max(case when status = 'failure' then start_time end) as last_failure, max(case when status <> 'failure' then start_time end) as last_ran
    from r where start_time >= timestamp '2024-02-01' - interval 14 day group by 1""",
)
def q_failure_rates(spark, sf):
    return runs.failure_rates(run_log(spark, sf), 14, as_of=_as_of("2024-02-01"))


@query(
    "runs_seeded_ranges",
    f"""with {_RUNS} select model_name, cast(trunc(avg(start_record_count) * 0.8) as bigint) as start_record_count_low, cast(trunc(avg(start_record_count) * 1.2) as bigint) as start_record_count_high,
      cast(trunc(avg(records_added) * 0.8) as bigint) as records_added_count_low, round(avg(elapsed_seconds) * 2.0 + 1e-9, 4) as elapsed_seconds_high
    from r where created_at >= timestamp '2024-02-01' - interval 30 day and status = 'success' and model_name not in (select model_name from r where model_layer = 'fact') group by 1""",
)
def q_seeded(spark, sf):
    log = run_log(spark, sf)
    existing = log.where("model_layer = 'fact'").select("model_name").distinct()
    out = runs.seeded_ranges(log, existing, as_of=_as_of("2024-02-01"))
    return out.select("model_name", "start_record_count_low", "start_record_count_high", "records_added_count_low", F.round(F.col("elapsed_seconds_high") + 1e-9, 4).alias("elapsed_seconds_high"))


_LIMITS = f"""{_RUNS}, l as (select * from r where id in (select max(id) from r group by model_name)), g as (select model_name, min(start_record_count) + 5 as lo, max(elapsed_seconds) * 0.9 as hi from r group by 1),
  s as (select l.*, (l.start_record_count < g.lo) as i1, (l.elapsed_seconds > g.hi) as i2 from l join g using (model_name)),
  c as (select *, case when status = 'failure' or i1 or i2 then 'danger' when (end_record_count = 0 or records_added = 0 or end_record_count <> start_record_count + records_added) then 'warning' else 'success' end as status_color from s)"""


def _summary(spark, sf):
    log = run_log(spark, sf)
    none = F.lit(None)
    limits = log.groupBy("model_name").agg((F.min("start_record_count") + 5).alias("start_record_count_low"), (F.max("elapsed_seconds") * 0.9).alias("elapsed_seconds_high"))
    limits = limits.withColumns(
        {**{f"{c}_{s}": none.cast("bigint") for c, s in (("start_record_count", "high"), ("end_record_count", "low"), ("end_record_count", "high"), ("records_added_count", "low"), ("records_added_count", "high"))}, "elapsed_seconds_low": none.cast("double")}
    )
    return runs.status_summary(log, limits)


@query("runs_status_summary", f"with {_LIMITS} select model_name, status, cast(i1 as int) + cast(i2 as int) as issue_count, status_color from c")
def q_status(spark, sf):
    return _summary(spark, sf).select("model_name", "status", F.size("issues").alias("issue_count"), "status_color")


@query(
    "runs_warning_texts",
    f"""with {_LIMITS}, w as (select *, end_record_count - start_record_count - records_added as beyond from c where status_color = 'warning')
    select model_name, case when end_record_count = 0 then 'end_record_count is 0 — destination table empty after load' when records_added = 0 then 'records_added is 0 — no new rows loaded this run' end as zero_warning,
      case when beyond <> 0 then format('reconciliation mismatch — start ({{:,}}) + added ({{:,}}) = {{:,}} expected, but end is {{:,}} ({{:,}} {{}} than expected)', start_record_count, records_added, start_record_count + records_added, end_record_count, abs(beyond), case when beyond > 0 then 'more' else 'fewer' end) end as recon_warning from w""",
)
def q_warning_texts(spark, sf):
    warned = _summary(spark, sf).where("status_color = 'warning'")
    return warned.select("model_name", F.get("zero_warnings", F.lit(0)).alias("zero_warning"), F.get("recon_warnings", F.lit(0)).alias("recon_warning"))


@query("runs_overall_health", f"with {_LIMITS} select case when count(*) = 0 then 'unknown' when sum(case when status_color = 'danger' then 1 else 0 end) > 0 then 'red' when sum(case when status_color = 'warning' then 1 else 0 end) > 0 then 'amber' else 'green' end as health from c")
def q_health(spark, sf):
    return runs.overall_health(_summary(spark, sf))


@query("runs_history", f"with {_RUNS} select id, model_name, start_time from r where start_time >= timestamp '2024-02-01' - interval 10 day")
def q_history(spark, sf):
    return runs.run_history(run_log(spark, sf), 10, as_of=_as_of("2024-02-01")).select("id", "model_name", "start_time")


@query(
    "runs_totals",
    f"""with {_RUNS} select run_id, count(*) as models, {M.isum('records_added', 'total_added')}, round(sum(elapsed_seconds) + 1e-9, 4) as total_elapsed, {M.isum("case when status = 'success' then 1 else 0 end", 'success')},
      {M.isum("case when status = 'failure' then 1 else 0 end", 'failure')}, 0::bigint as skipped from r group by 1""",
)
def q_totals(spark, sf):
    return runs.run_totals(run_log(spark, sf)).withColumn("total_elapsed", F.round(F.col("total_elapsed") + 1e-9, 4))


@query(
    "runs_lineage_summary",
    """select l_suppkey as model, case l_suppkey % 3 when 0 then 'Stage' when 1 then 'Fact' else 'Mart' end as layer, count(*) as total_columns,
      cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as renames, cast(sum(case when l_returnflag = 'N' then 1 else 0 end) as bigint) as casts, max(l_shipdate) as last_refreshed from lineitem group by 1, 2""",
)
def q_lineage(spark, sf):
    flag = F.col("l_returnflag")
    ml = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("model"),
        F.when(F.col("l_suppkey") % 3 == 0, "Stage").when(F.col("l_suppkey") % 3 == 1, "Fact").otherwise("Mart").alias("layer"),
        F.when(flag == "A", "Rename").when(flag == "N", "CAST").otherwise("Pass-through").alias("transformation_type"),
        F.col("l_shipdate").alias("refreshed_at"),
    )
    return runs.lineage_summary(ml).select("model", "layer", "total_columns", "renames", "casts", "last_refreshed")


@query(
    "runs_lineage_with_tests",
    """with t as (select 'pkg.' || upper(o_orderpriority) as model_name, 'C' || o_custkey as column_name, 'not_null' as test_name, case o_orderstatus when 'F' then 'fail' else 'pass' end as status, cast(o_orderkey % 2 as int) as failures, date_trunc('month', o_orderdate) as run_started_at from orders),
    x as (select * from t where run_started_at = (select max(run_started_at) from t t2 where t2.model_name = t.model_name and t2.test_name = t.test_name and t2.column_name = t.column_name)),
    ml as (select distinct lower(o_orderpriority) as model, 'c' || o_custkey as column_name from orders)
    select ml.model as model_name, ml.column_name, x.test_name, x.failures, case when x.test_name is null then 'no_test' when x.status in ('fail', 'error') or coalesce(x.failures, 0) > 0 then 'fail' else 'pass' end as test_status
    from ml left join x on lower(split_part(x.model_name, '.', 2)) = lower(ml.model) and lower(x.column_name) = ml.column_name""",
)
def q_lineage_tests(spark, sf):
    o = table(spark, sf, "orders")
    log = o.select(
        F.concat(F.lit("pkg."), F.upper("o_orderpriority")).alias("model_name"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("column_name"),
        F.lit("not_null").alias("test_name"),
        F.when(F.col("o_orderstatus") == "F", "fail").otherwise("pass").alias("status"),
        (F.col("o_orderkey") % 2).cast("int").alias("failures"),
        F.date_trunc("month", "o_orderdate").alias("run_started_at"),
    )
    # A lineage column for every model that a customer ordered with.
    ml = o.select(F.lower("o_orderpriority").alias("model"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("column_name")).distinct()
    ml = ml.withColumn("refreshed_at", F.lit(None).cast("timestamp"))
    return runs.lineage_with_tests(ml, log).select("model_name", "column_name", "test_name", "failures", "test_status")


@query(
    "runs_grouped_tests",
    """select l_suppkey as group_name, 'source_test_' || l_suppkey as model_name, case when sum(case when l_returnflag = 'R' then 1 else 0 end) > 0 then 'FAILURE' else 'SUCCESS' end as status, round(sum(l_quantity) + 1e-9, 4) as elapsed_seconds from lineitem group by 1""",
)
def q_grouped_tests(spark, sf):
    res = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("source_table"), F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass").alias("status"), F.col("l_quantity").alias("elapsed"),
        F.concat(F.lit("t"), F.col("l_linenumber").cast("string")).alias("test_name"), F.lit(None).cast("string").alias("message"),
    )
    out = runs.grouped_test_results(res).select("group_name", "model_name", "status", "elapsed_seconds")
    return out.withColumn("elapsed_seconds", F.round(F.col("elapsed_seconds") + 1e-9, 4))


@query(
    "runs_alert_items",
    f"""with {_LIMITS} select model_name as model, model_layer as layer, status, 'failures' as section from c where status_color = 'danger'
      union all select model_name, model_layer, status, 'zero_row_warnings' from c where status_color = 'warning' and (end_record_count = 0 or records_added = 0)
      union all select model_name, model_layer, status, 'reconciliation_warnings' from c where status_color = 'warning' and end_record_count <> start_record_count + records_added""",
)
def q_alert(spark, sf):
    return runs.alert_items(_summary(spark, sf)).select("model", "layer", "status", "section")
