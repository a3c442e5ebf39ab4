"""Small inputs written by hand."""

import json

from ballstats import schemas

FIELDS = {
    "match_id": "M1", "season": "2022", "venue": "V1", "batting_team": "A", "bowling_team": "B", "innings": "1",
    "over": "0.1", "striker": "a", "bowler": "b", "runs_of_bat": "1", "extras": "0", "wides": "0", "noballs": "0",
    "wicket_type": "", "player_dismissed": "", "fielder": "",
}


def deliveries(spark, *changes):
    """One delivery per dict of changes to a plain one; all text."""
    rows = [tuple({**FIELDS, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, schemas.strings(list(FIELDS)))


def message(topic, drop=(), **changes):
    row = {**FIELDS, **changes}
    return topic, json.dumps({name: row[name] for name in schemas.TOPIC_FIELDS[topic] if name not in drop})


def messages(spark, *rows):
    return spark.createDataFrame(list(rows), "topic string, value string")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
