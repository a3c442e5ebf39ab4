"""For each registered query the SQL text it is checked against, in DuckDB's dialect."""

from __future__ import annotations

DELIVERIES = """
deliveries as (
  select concat('M', m) as match_id, 2020 + m % 5 as season, concat('V', m % 12) as venue,
    cast(inn as varchar(4)) as innings, concat(l_partkey % 20, '.', 1 + l_linenumber % 6) as over,
    concat('T', case when inn = 1 then t1 else t2 end) as batting_team,
    concat('T', case when inn = 1 then t2 else t1 end) as bowling_team,
    concat('P', case when inn = 1 then t1 else t2 end * 11 + l_partkey % 11) as striker,
    concat('P', case when inn = 1 then t2 else t1 end * 11 + l_suppkey % 11) as bowler,
    cast(cast(l_quantity as int) % 7 as varchar(4)) as runs_of_bat,
    case when l_discount > 0.085 then '1' else '0' end as extras,
    case when l_discount > 0.085 and l_tax > 0.045 then '1' else '0' end as wides,
    case when w then case l_suppkey % 5 when 0 then 'caught' when 1 then 'bowled' when 2 then 'lbw'
         when 3 then 'run out' else 'stumped' end else '' end as wicket_type,
    case when w then concat('P', case when inn = 1 then t1 else t2 end * 11 + l_partkey % 11) else '' end
      as player_dismissed,
    case when w and l_suppkey % 5 = 0
         then concat('P', case when inn = 1 then t2 else t1 end * 11 + l_orderkey % 11) else '' end as fielder,
    l_linenumber, l_orderkey
  from (select *, l_orderkey % 200 as m, 1 + l_linenumber % 2 as inn, (l_orderkey % 200) % 10 as t1,
          ((l_orderkey % 200) + 1 + (l_orderkey % 200) % 9) % 10 as t2,
          (l_orderkey + l_partkey + l_suppkey) % 20 = 0 as w from lineitem) x
)"""

TYPED = DELIVERIES + """,
typed as (
  select match_id, season, venue, batting_team, bowling_team, striker, bowler, wicket_type, player_dismissed,
    fielder, try_cast(innings as int) as innings, try_cast(over as float) as over,
    try_cast(runs_of_bat as int) as runs_of_bat, try_cast(extras as int) as extras,
    try_cast(wides as int) as wides,
    try_cast(runs_of_bat as int) + try_cast(extras as int) as total_runs, 1 as balls
  from deliveries
)"""


def _with(tables: str, query: str) -> str:
    return f"with {tables.strip()}\n{query.strip()}"


def _typed(query: str) -> str:
    return _with(TYPED, query)


def _ratio(numerator: str, denominator: str, factor: int, digits: int = 2) -> str:
    """Half-up on whole numbers, null for a denominator of 0."""
    unit = 10**digits
    return (
        f"(({2 * factor * unit} * cast({numerator} as hugeint) + {denominator})"
        f" // nullif(2 * {denominator}, 0)) / {unit}.0::double"
    )


def _run_rate(keys: str, balls: str, rate: str, condition: str = "true") -> str:
    return _typed(f"""
select {keys}, cast(sum(total_runs) as bigint) as total_runs, cast(sum(balls) as bigint) as {balls},
  {_ratio("sum(total_runs)", "sum(balls)", 6)} as {rate}
from typed where {condition} group by {keys}""")


_WICKET = "wicket_type is not null and wicket_type <> ''"

_SCORES = TYPED + """,
scores as (
  select match_id, batting_team, innings, striker, cast(sum(runs_of_bat) as bigint) as total_runs
  from typed group by match_id, batting_team, innings, striker
)"""

_TOP_SCORERS = _with(_SCORES, """
select s.match_id, s.batting_team, s.innings, s.striker, s.total_runs
from scores s
join (select match_id, batting_team, innings, max(total_runs) as best from scores group by all) b
  on s.match_id = b.match_id and s.batting_team = b.batting_team and s.innings = b.innings
 and s.total_runs = b.best""")

_MESSAGE = {
    "runs": ["match_id", "batting_team", "innings", "over", "striker", "runs_of_bat"],
    "rate": ["match_id", "batting_team", "innings", "over", "striker", "runs_of_bat", "extras"],
    "bowler": [
        "match_id", "batting_team", "bowling_team", "striker",
        "bowler", "wicket_type", "player_dismissed", "fielder",
    ],
    "deliveries_raw": [
        "match_id", "season", "venue", "innings", "over", "batting_team", "bowling_team", "striker", "bowler",
        "runs_of_bat", "extras", "wides", "wicket_type", "player_dismissed", "fielder",
    ],
}


def _message(topic: str) -> str:
    fields = ", ".join(f"{name} := cast({name} as varchar)" for name in _MESSAGE[topic])
    return f"select '{topic}' as topic, cast(to_json(struct_pack({fields})) as varchar) as value from deliveries"


_RUNS_BY_PLAYER = "select striker as player_name, cast(sum(runs_of_bat) as bigint) as runs_scored from typed group by 1"
_WICKETS_BY_PLAYER = f"select bowler as player_name, count(*) as wickets_taken from typed where {_WICKET} group by 1"

_PLAYERS = TYPED + f""",
batting as (
  select striker as p, sum(runs_of_bat) as runs, sum(balls) as faced from typed group by 1
), bowling as (
  select bowler as p, sum(total_runs) as conceded, sum(balls) as bowled,
    count(*) filter (where {_WICKET}) as taken from typed group by 1
), dismissed as (
  select player_dismissed as p, count(*) as outs from typed where {_WICKET} and player_dismissed <> '' group by 1
), played as (
  select p, count(distinct match_id) as matches
  from (select striker as p, match_id from typed union all select bowler, match_id from typed) group by 1
)"""

_TEAMS = TYPED + """,
totals as (
  select match_id, batting_team, bowling_team, sum(total_runs) as runs, sum(balls) as balls
  from typed group by all
), teams as (
  select a.batting_team as team_name, count(*) as matches_played,
    count(*) filter (where a.runs > b.runs) as matches_won,
    cast(sum(a.runs) as bigint) as scored, cast(sum(a.balls) as bigint) as faced,
    cast(sum(b.runs) as bigint) as conceded, cast(sum(b.balls) as bigint) as bowled
  from totals a join totals b on a.match_id = b.match_id and a.batting_team = b.bowling_team
  group by 1
), rated as (
  select *, 6.0::double * scored / faced - 6.0::double * conceded / bowled as diff from teams
)"""

_RECONCILED = TYPED + f""",
report as (
  select 'top_wicket_takers' as analysis_type,
    count(*) as n from (select bowler from typed where {_WICKET} group by bowler)
  union all select 'highest_scorers', count(*) from (select striker, batting_team from typed group by all)
  union all select 'run_rate_team', count(*) from (select batting_team from typed group by 1)
)"""

_BATCH = {
    "top_wicket_takers": _typed(
        f"select bowler, count(wicket_type) as wickets_taken from typed where {_WICKET} group by bowler"
    ),
    "dismissal_types": _typed(
        f"select wicket_type, count(*) as count from typed where {_WICKET} group by wicket_type"
    ),
    "caught_dismissals": _typed("""
select player_dismissed as batsman from typed
where wicket_type = 'caught' and player_dismissed is not null and player_dismissed <> ''"""),
    "highest_scorers": _typed("""
select striker, batting_team, cast(sum(runs_of_bat) as bigint) as total_runs
from typed group by striker, batting_team"""),
    "scores_match_innings": _with(_SCORES, "select * from scores"),
    "max_score_match_innings": _with(_SCORES, """
select match_id, batting_team, innings, max(total_runs) as max_runs
from scores group by match_id, batting_team, innings"""),
    "top_scorer_match_innings": _TOP_SCORERS,
    "run_rate_match": _run_rate("match_id, innings, batting_team", "total_balls", "run_rate"),
    "run_rate_team": _run_rate("batting_team", "total_balls", "overall_run_rate"),
    "run_rate_striker": _run_rate("striker", "balls_faced", "run_rate"),
    "run_rate_powerplay": _run_rate(
        "batting_team, match_id, innings", "powerplay_balls", "powerplay_runrate", "over < 6"
    ),
}

_STREAMED = [
    "top_wicket_takers", "dismissal_types", "caught_dismissals", "highest_scorers", "top_scorer_match_innings",
    "run_rate_match", "run_rate_team", "run_rate_striker", "run_rate_powerplay",
]

_SEASONS = TYPED + """,
seasons as (
  select striker as player_name, cast(season as int) as season, cast(coalesce(sum(runs_of_bat), 0) as bigint) as runs from typed group by all
)"""

_CONSISTENCY = _with(_SEASONS, """
select player_name, n as seasons, s as runs, s::double / n as mean_runs,
  sqrt((n * q - s::hugeint * s)::double) / n as deviation,
  case when s <> 0 then sqrt((n * q - s::hugeint * s)::double) / s end as variation
from (select player_name, count(*) as n, cast(sum(runs) as bigint) as s, sum(runs::hugeint * runs) as q
      from seasons group by 1) x""")

# A season is in the frame by its number, whether or not the one before it was played.
_FORM = _with(_SEASONS, f"""
select player_name, season, runs, form_runs, form_seasons, {_ratio("form_runs", "form_seasons", 1)} as form_average
from (select a.player_name, a.season, a.runs, cast(sum(b.runs) as bigint) as form_runs, count(*) as form_seasons
      from seasons a join seasons b on a.player_name = b.player_name and b.season between a.season - 2 and a.season
      group by all) x""")


def _phase(name: str, inside: str) -> str:
    balls, runs = f"count(*) filter (where {inside})", f"coalesce(sum(total_runs) filter (where {inside}), 0)"
    return f"""{balls} as {name}_balls, cast({runs} as bigint) as {name}_runs,
  count(*) filter (where {inside} and {_WICKET}) as {name}_wickets, {_ratio(runs, balls, 6)} as {name}_economy"""


_PHASES = {"powerplay": "over < 6", "middle": "over >= 6 and over < 16", "death": "over >= 16"}

_OUTCOMES = TYPED + """,
totals as (
  select match_id, innings, batting_team as team, cast(sum(total_runs) as bigint) as total
  from typed group by all
), outcomes as (
  select a.match_id, a.team as first_team, a.total as first_total, b.team as second_team, b.total as second_total,
    case when b.team is null then 'no result' when a.total > b.total then 'defended'
         when a.total < b.total then 'chased' else 'tie' end as outcome
  from totals a left join totals b on a.match_id = b.match_id and b.innings = 2
  where a.innings = 1
  union all
  select match_id, team, total, null, null, 'no result' from totals c
  where innings = 2 and not exists (select 1 from totals d where d.match_id = c.match_id and d.innings = 1)
)"""

_MILESTONES = _with(DELIVERIES + """,
running as (
  select *, sum(cast(runs_of_bat as int)) over (
    partition by match_id, batting_team, innings, striker
    order by cast(split_part(over, '.', 1) as int), cast(split_part(over, '.', 2) as int), l_orderkey, l_linenumber
    rows unbounded preceding) as so_far
  from deliveries
)""", """
select match_id, batting_team, innings, striker, milestone, over, cast(so_far as bigint) as runs
from running, (values (50), (100)) as marks(milestone)
where so_far >= milestone and so_far - cast(runs_of_bat as int) < milestone""")


_INCOMPLETE = TYPED + """,
ours as (select striker, batting_team, cast(sum(runs_of_bat) as bigint) as total_runs from typed group by all),
theirs as (
  select striker, batting_team, cast(sum(runs_of_bat) as bigint) as total_runs from typed
  where season <> 2022 group by all
)"""

ORACLES: dict[str, str] = {
    **_BATCH,
    **{f"stream_{name}": _BATCH[name] for name in _STREAMED},
    "top_scorer_match_innings_join": _TOP_SCORERS,
    "typed_deliveries": _typed("""
select match_id, season, batting_team, bowling_team, striker, bowler, wicket_type, player_dismissed, fielder,
  innings, over, runs_of_bat, extras, total_runs, balls from typed"""),
    "wicket_flag": _typed("""
select cast(wicket_type is not null as int) as is_wicket, count(*) as n from typed group by 1"""),
    "topic_fanout": _with(DELIVERIES, "\nunion all ".join(_message(topic) for topic in _MESSAGE)),
    "json_decode": _with(
        DELIVERIES, "select match_id, batting_team, innings, over, striker, runs_of_bat from deliveries"
    ),
    "validate_messages": _with(DELIVERIES, """
select case when l_linenumber = 7 then 'quarantine' else 'valid' end as status, count(*) as n
from deliveries group by 1"""),
    "land_runs": _typed("select match_id, batting_team, innings, over, striker, runs_of_bat from typed"),
    "land_rate": _typed("select match_id, batting_team, innings, over, striker, runs_of_bat, extras from typed"),
    "land_bowler": _typed("""
select match_id, batting_team, bowling_team, striker, bowler, wicket_type, player_dismissed, fielder from typed"""),
    "matches_dim": _with(DELIVERIES, "select distinct match_id, season, venue from deliveries"),
    "deliveries_fact": _with(DELIVERIES, """
select match_id, try_cast(innings as int) as innings,
  try_cast(split_part(over, '.', 1) as int) as over_num, try_cast(split_part(over, '.', 2) as int) as ball_num,
  striker, cast(null as varchar) as non_striker, bowler, try_cast(runs_of_bat as int) as runs_of_bat,
  try_cast(extras as int) as extras, try_cast(wides as int) as wides, 0 as noballs, 0 as penalty_runs,
  wicket_type, player_dismissed, fielder, batting_team, bowling_team, season
from deliveries"""),
    "orphan_deliveries": _with(DELIVERIES, """
select match_id, count(*) as n from deliveries d
where not exists (select 1 from (select distinct match_id, season from deliveries) m
                  where m.match_id = d.match_id and m.season > 2020)
group by match_id"""),
    "player_runs_upsert": _typed(_RUNS_BY_PLAYER),
    "player_wickets_upsert": _typed(_WICKETS_BY_PLAYER),
    "player_totals": _typed(f"""
select coalesce(r.player_name, w.player_name) as player_name, coalesce(runs_scored, 0) as runs_scored,
  coalesce(wickets_taken, 0) as wickets_taken
from ({_RUNS_BY_PLAYER}) r full join ({_WICKETS_BY_PLAYER}) w on r.player_name = w.player_name"""),
    "top10_run_scorers": _typed(f"""
select * from ({_RUNS_BY_PLAYER}) where runs_scored > 0 order by runs_scored desc, player_name limit 10"""),
    "top10_wicket_takers": _typed(f"""
select * from ({_WICKETS_BY_PLAYER}) where wickets_taken > 0 order by wickets_taken desc, player_name limit 10"""),
    "top_batters": _with(_PLAYERS, f"""
select p as player_name, cast(runs as bigint) as runs_scored, {_ratio("runs", "faced", 100)} as strike_rate
from batting order by runs desc, p limit 5"""),
    "top_bowlers": _with(_PLAYERS, f"""
select p as player_name, cast(taken as bigint) as wickets_taken, {_ratio("conceded", "bowled", 6)} as economy_rate
from bowling order by taken desc, p limit 5"""),
    "player_stats": _with(_PLAYERS, f"""
select p as player_name, matches as matches_played, cast(coalesce(runs, 0) as bigint) as runs_scored,
  cast(coalesce(taken, 0) as bigint) as wickets_taken,
  cast({_ratio("runs", "outs", 1)} as decimal(10,2)) as batting_average,
  cast({_ratio("conceded", "taken", 1)} as decimal(10,2)) as bowling_average,
  cast({_ratio("runs", "faced", 100)} as decimal(10,2)) as strike_rate,
  cast({_ratio("conceded", "bowled", 6)} as decimal(10,2)) as economy_rate
from played left join batting using (p) left join bowling using (p) left join dismissed using (p)"""),
    "team_stats": _with(_TEAMS, """
select team_name, matches_played, matches_won, scored as total_runs_scored, conceded as total_runs_conceded,
  cast(sign(diff) * floor(abs(diff) * 1000 + 0.5) / 1000 as decimal(10,3)) as net_run_rate
from rated"""),
    "top_teams": _with(_TEAMS, f"""
select team_name, matches_won as wins, {_ratio("matches_won", "matches_played", 100)} as win_percentage
from teams order by matches_won desc, team_name limit 8"""),
    "team_performance": _with(_TEAMS, """
select team_name, matches_played, scored as total_runs_scored from teams"""),
    "reconcile_accuracy": _with(_RECONCILED, """
select analysis_type, n as batch_records, n as stream_records, n as matching_records,
  100.0::double as accuracy from report"""),
    "reconcile_summary": _with(_RECONCILED, """
select count(*) as analyses, cast(sum(n) as bigint) as batch_records, cast(sum(n) as bigint) as stream_records,
  100.0::double as avg_accuracy from report"""),
    "milestones": _MILESTONES,
    "stream_milestones": _with(_SCORES, """
select match_id, batting_team, innings, striker, milestone
from scores, (values (50), (100)) as marks(milestone) where total_runs >= milestone"""),
    "stream_top_scorer_incremental": _TOP_SCORERS,
    "stream_quarantine": _with(DELIVERIES, """
select 'rate' as topic, case when l_linenumber = 7 then 'missing field' else 'not a JSON object' end as problem,
  count(*) as n
from deliveries where l_linenumber in (5, 6, 7) group by all"""),
    **{
        f"routed_{name}": _BATCH[name].replace("from deliveries", "from deliveries where l_linenumber not in (5, 6, 7)")
        for name in ("run_rate_match", "run_rate_team", "run_rate_striker", "run_rate_powerplay")
    },
    "reconcile_diff": _with(_INCOMPLETE, """
select striker, batting_team, o.total_runs as batch_runs, t.total_runs as stream_runs,
  cast(o.total_runs is not null as bigint) as batch_rows, cast(t.total_runs is not null as bigint) as stream_rows
from ours o full join theirs t using (striker, batting_team) where o.total_runs is distinct from t.total_runs"""),
    "reconcile_incomplete": _with(_INCOMPLETE, """
select 'highest_scorers' as analysis_type, batch_records, stream_records, matching_records,
  matching_records * 100.0::double / batch_records as accuracy
from (select (select count(*) from ours) as batch_records, (select count(*) from theirs) as stream_records,
        (select count(*) from ours join theirs using (striker, batting_team, total_runs)) as matching_records) x"""),
    "batter_consistency": _CONSISTENCY,
    "stream_batter_consistency": _CONSISTENCY,
    "season_form": _FORM,
    "stream_season_form": _FORM,
    "phase_economy": _typed(
        "select bowler, " + ", ".join(_phase(*phase) for phase in _PHASES.items()) + " from typed group by bowler"
    ),
    "match_outcomes": _with(_OUTCOMES, "select * from outcomes"),
    "chase_vs_defend": _with(_OUTCOMES, f"""
select team_name, defending, defended, chasing, chased, tied, without_result,
  {_ratio("defended", "defending", 100)} as defended_percentage, {_ratio("chased", "chasing", 100)} as chased_percentage
from (select team_name, count(*) filter (where first) as defending,
        count(*) filter (where first and outcome = 'defended') as defended,
        count(*) filter (where not first) as chasing,
        count(*) filter (where not first and outcome = 'chased') as chased,
        count(*) filter (where outcome = 'tie') as tied,
        count(*) filter (where outcome = 'no result') as without_result
      from (select first_team as team_name, true as first, outcome from outcomes
            union all select second_team, false, outcome from outcomes where second_team is not null) s
      group by 1) x"""),
    "csv_roundtrip": _with(DELIVERIES, """
select match_id, concat(striker, ', "the ', bowler, '"', chr(10), ' of ', venue, ' ') as striker, over, runs_of_bat,
  wicket_type from deliveries"""),
    "csv_faults": _with(DELIVERIES, """
select case when l_linenumber in (6, 7) then 'wrong number of fields' else 'good' end as kind,
  cast(case when l_linenumber not in (6, 7) then length(runs_of_bat) end as int) as size, count(*) as n
from deliveries group by all"""),
}
