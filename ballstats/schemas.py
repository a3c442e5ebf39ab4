"""Names and types of deliveries, topics and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic names and their fields, as existing producers and consumers use them.
RAW_TOPIC = "deliveries_raw"
TOPIC_FIELDS: dict[str, list[str]] = {
    "runs": ["match_id", "batting_team", "innings", "over", "striker", "runs_of_bat"],
    "rate": ["match_id", "batting_team", "innings", "over", "striker", "runs_of_bat", "extras"],
    "bowler": [
        "match_id", "batting_team", "bowling_team", "striker",
        "bowler", "wicket_type", "player_dismissed", "fielder",
    ],
}
ALL_FIELDS = list(dict.fromkeys(name for fields in TOPIC_FIELDS.values() for name in fields))
# Fields a message may not lack when it is produced; the others are sent if the row has them.
MANDATORY_FIELDS: dict[str, list[str]] = {"rate": ["extras"]}

# Types of the numeric fields; every other field is text.
NUMERIC_FIELDS: dict[str, str] = {
    "innings": "int",
    "over": "float",
    "runs_of_bat": "int",
    "extras": "int",
    "wides": "int",
    "noballs": "int",
    "penalty_runs": "int",
}

# Spellings found in feeds and databases -> the name used here.
FIELD_ALIASES: dict[str, str] = {
    "runs_off_bat": "runs_of_bat",
    "wide": "wides",
    "wide_runs": "wides",
    "noball_runs": "noballs",
}

# Columns of a deliveries CSV. Needed as a schema only where a stream cannot look at a header.
CSV_FIELDS = [
    "match_id", "season", "match_no", "date", "venue", "batting_team", "bowling_team",
    "innings", "over", "striker", "bowler", "runs_of_bat", "extras", "wides", "noballs",
    "wicket_type", "player_dismissed", "fielder",
]

# Fields looked for in a raw delivery message.
RAW_FIELDS = [*CSV_FIELDS, "non_striker", "penalty_runs"]

MATCH_FIELDS = ["match_id", "season", "match_no", "date", "venue"]

# The deliveries fact table, in column order.
FACT_TYPES: dict[str, str] = {
    "match_id": "string",
    "innings": "int",
    "over_num": "int",
    "ball_num": "int",
    "striker": "string",
    "non_striker": "string",
    "bowler": "string",
    "runs_of_bat": "int",
    "extras": "int",
    "wides": "int",
    "noballs": "int",
    "penalty_runs": "int",
    "wicket_type": "string",
    "player_dismissed": "string",
    "fielder": "string",
    "batting_team": "string",
    "bowling_team": "string",
}

INNINGS_KEYS = ["match_id", "batting_team", "innings"]


def strings(names: list[str]) -> T.StructType:
    """A schema in which every field is text, as on the wire."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


MESSAGE_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())]
)
