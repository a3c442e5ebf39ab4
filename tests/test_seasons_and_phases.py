"""Milestones, phases, outcomes and seasons on rows written by hand, and their plans."""

import pytest

from ballstats.functions import parse
from ballstats.operators import milestones, outcomes, phases, seasons
from tests.helpers import deliveries, plan, rows


def balls(*runs, striker="a", first=0):
    """One ball each, ten to an over so that ball numbers have two digits."""
    return [
        {"striker": striker, "over": f"{(first + k) // 10}.{(first + k) % 10 + 1}", "runs_of_bat": str(r)} for k, r in enumerate(runs)
    ]


def test_milestones_follow_over_and_ball_numbers(spark):
    # As fractions, 0.10 would come before 0.2.
    given = [*balls(*[6] * 8), *balls(1, 2, first=8), *balls(*[6] * 9, striker="b")]
    got = milestones.milestones(deliveries(spark, *reversed(given)))
    assert [(r.striker, r.milestone, r.over, r.runs) for r in got.orderBy("striker").collect()] == [("a", 50, "0.10", 51), ("b", 50, "0.9", 54)]


def test_milestones_are_reached_once(spark):
    given = balls(49, 1, -5, 5, 60, "x", None)
    got = milestones.milestones(deliveries(spark, *given))
    assert [(r.milestone, r.over, r.runs) for r in got.orderBy("milestone").collect()] == [(50, "0.2", 50), (100, "0.5", 110)]
    both = milestones.milestones(deliveries(spark, *balls(200)))
    assert sorted(r.milestone for r in both.collect()) == [50, 100]
    assert milestones.milestones(deliveries(spark, *balls(30)), marks=(10, 20, 40)).count() == 2


def test_milestones_keep_ties_in_the_given_order(spark):
    given = deliveries(spark, {"runs_of_bat": "40"}, {"runs_of_bat": "20"}).selectExpr("*", "cast(runs_of_bat as int) as line")
    assert [r.runs for r in milestones.milestones(given, ["line"]).collect()] == [60]


def test_milestones_shuffle_once(spark):
    found = plan(milestones.milestones(deliveries(spark, {})))
    assert found.count("Exchange") == 1 and "Window" in found


def test_phases(spark):
    given = [
        {"over": "5.6", "extras": "1"}, {"over": "6.1"}, {"over": "15.6", "runs_of_bat": "4", "wicket_type": "bowled"},
        {"over": "16.1", "runs_of_bat": "6"}, {"over": "20.1", "runs_of_bat": "x"}, {"over": "later"}, {"bowler": "c", "over": None},
    ]
    got = phases.phase_economy(parse.typed(deliveries(spark, *given)))
    assert plan(got).count("Exchange") == 1
    assert got.columns[1:5] == ["powerplay_balls", "powerplay_runs", "powerplay_wickets", "powerplay_economy"]
    assert rows(got) == [
        ("b", 1, 2, 0, 12.0, 2, 5, 1, 15.0, 2, 6, 0, 18.0),
        ("c", 0, 0, 0, None, 0, 0, 0, None, 0, 0, 0, None),
    ]
    halves = phases.phase_economy(parse.typed(deliveries(spark, *given)), {"first": (0, 10), "second": (10, 20)})
    assert halves.columns == ["bowler"] + [f"{p}_{w}" for p in ("first", "second") for w in ("balls", "runs", "wickets", "economy")]


def innings(match, number, team, *runs, against="B"):
    return [{"match_id": match, "innings": number, "batting_team": team, "bowling_team": against, "runs_of_bat": r} for r in runs]


def test_outcomes(spark):
    given = [
        *innings("won by runs", "1", "A", "6", "4"), *innings("won by runs", "2", "B", "6", "3"),
        *innings("chased", "2", "A", "6", "6"), *innings("chased", "1", "B", "6", "4"),
        *innings("tied", "1", "A", "4"), *innings("tied", "2", "B", "2", "2"), *innings("tied", "3", "A", "6"), *innings("tied", "4", "B", "1"),
        *innings("rain", "1", "C", "4"), *innings("late", "2", "C", "4"), *innings("unread", "1", "C", "x"), *innings("unread", "2", "A", "1"),
        *innings(None, "1", "C", "4"),
    ]
    found = outcomes.match_outcomes(parse.typed(deliveries(spark, *given)))
    assert rows(found) == sorted(
        [
            ("won by runs", "A", 10, "B", 9, "defended"),
            ("chased", "B", 10, "A", 12, "chased"),
            ("tied", "A", 4, "B", 4, "tie"),
            ("rain", "C", 4, None, None, "no result"),
            ("late", "C", 4, None, None, "no result"),
            ("unread", "C", None, "A", 1, "no result"),
        ],
        key=repr,
    )
    assert rows(outcomes.chase_vs_defend(found)) == [
        ("A", 2, 1, 2, 1, 1, 1, 50.0, 50.0),
        ("B", 1, 0, 2, 0, 1, 0, 0.0, 0.0),
        ("C", 3, 0, 0, 0, 0, 3, 0.0, None),
    ]


@pytest.fixture
def by_season(spark):
    given = {"2018": 10, "2019/20": 20, "2021": 60, "2024": 5, "soon": 90}
    changes = [{"season": season, "striker": "a", "runs_of_bat": str(runs)} for season, runs in given.items()]
    return seasons.season_runs(parse.typed(deliveries(spark, *changes, {"season": "2020", "striker": "b", "runs_of_bat": ""})))


def test_form_counts_missed_seasons(by_season):
    assert rows(seasons.season_form(by_season)) == [
        ("a", 2018, 10, 10, 1, 10.0), ("a", 2019, 20, 30, 2, 15.0), ("a", 2021, 60, 80, 2, 40.0), ("a", 2024, 5, 5, 1, 5.0),
        ("b", 2020, 0, 0, 1, 0.0),
    ]


def test_consistency(by_season):
    a, b = seasons.batter_consistency(by_season).orderBy("player_name").collect()
    assert (a.seasons, a.runs, a.mean_runs) == (4, 95, 23.75)
    assert a.deviation == pytest.approx(21.6145) and a.variation == pytest.approx(21.6145 / 23.75, rel=1e-4)
    assert tuple(b) == ("b", 1, 0, 0.0, 0.0, None)


def test_moments_can_be_merged(by_season):
    parts = [by_season.where("season < 2020"), by_season.where("season >= 2020")]
    whole = seasons.consistency(seasons.merged([seasons.moments(part) for part in parts]))
    assert rows(whole) == rows(seasons.batter_consistency(by_season))
