"""From wire text to typed columns, and back."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.functions import wickets


def canonical(df: DataFrame) -> DataFrame:
    """Rename known spellings, and join ``over`` + ``ball`` (or ``over_num`` + ``ball_num``) to ``o.b``."""
    present = set(df.columns)
    df = df.withColumnsRenamed(
        {old: new for old, new in schemas.FIELD_ALIASES.items() if old in present and new not in present}
    )
    for over, ball in (("over_num", "ball_num"), ("over", "ball")):
        if {over, ball} <= present:
            joined = _over_and_ball(F.col(over).cast("string"), F.col(ball).cast("string"))
            return df.withColumn("_over", joined).drop(over, ball).withColumnRenamed("_over", "over")
    return df


def _over_and_ball(over: Column, ball: Column) -> Column:
    """``o.b``; an over that has its ball already stays as it is."""
    return F.when(F.contains(over, F.lit(".")), over).otherwise(F.concat(over, F.lit("."), ball))


def over_number(over: str) -> Column:
    """The over of an ``o.b`` in text, as a whole number; null if it cannot be read."""
    return F.substring_index(F.col(over).cast("string"), ".", 1).try_cast("int")


def ball_number(over: str) -> Column:
    """The ball of an ``o.b`` in text; null if there is none."""
    text = F.col(over).cast("string")
    return F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).try_cast("int")


def typed(df: DataFrame, legal_only: bool = False) -> DataFrame:
    """Cast the numeric fields that are there and add ``total_runs`` and ``balls``.

    Unreadable numbers become null instead of failing the query. Every delivery counts as a
    ball, wides and no-balls too, unless ``legal_only`` (which needs those two columns).
    """
    casts = {
        name: F.col(name).try_cast(kind)
        for name, kind in schemas.NUMERIC_FIELDS.items()
        if name in df.columns
    }
    df = df.withColumns(casts)
    derived: dict[str, Column] = {"balls": F.lit(1)}
    if legal_only:
        derived["balls"] = F.when(wickets.legal_ball(), 1).otherwise(0)
    if "runs_of_bat" in df.columns and "extras" in df.columns:
        derived["total_runs"] = F.col("runs_of_bat") + F.col("extras")
    return df.withColumns(derived)


def encode(*fields: str | Column) -> Column:
    """One JSON object of the given fields; a null stays visible as ``null``."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


_END = "_end"
_BLANKS = " \t\r\n"


def objects(text: Column, names: list[str]) -> Column:
    """The fields of a message as an array of one struct; an empty array if the text is not one JSON object.

    Spark's parser ends with the first value and takes no notice of what follows. So the message is parsed
    as the only element of an array: a text without ``]`` cannot end the array itself, so that there is one
    element only if the text is one value. A text with ``]`` is the first of two elements, of which the second
    holds a hash of the message: only if both are there, and no third, is the text one value. A message
    cannot hold its own hash. Texts that do not end as an object are not parsed, as each would cost an exception.
    """
    mark, may_close = F.xxhash64(text), F.contains(text, F.lit("]"))
    marked = F.concat(F.lit("["), text, F.lit(f',{{"{_END}":'), mark.cast("string"), F.lit("}]"))
    alone = F.when(may_close, marked).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    closed = F.endswith(text, F.lit("}")) | F.endswith(F.rtrim(text, F.lit(_BLANKS)), F.lit("}"))
    fields = ", ".join(f"`{name}`: string" for name in names)
    found = F.from_json(F.when(closed, alone), f"array<struct<{fields}, `{_END}`: bigint>>", {"allowSingleQuotes": "false"})

    def whole(f: Column) -> Column:
        ended = F.when(may_close, (F.size(f) == 2) & F.coalesce(F.get(f, F.lit(1))[_END] == mark, F.lit(False)))
        return ended.otherwise(F.size(f) == 1) & F.get(f, F.lit(0)).isNotNull()

    # Parsed once: the array is looked at as a variable of a function.
    return F.transform(F.filter(F.array(found), whole), lambda f: F.get(f, F.lit(0)))


def _readable(messages: DataFrame, names: list[str]) -> DataFrame:
    # ``inline`` keeps later filters on the fields above the parsing. Without it they are pushed
    # below, and the text is parsed again for every field they name.
    text = messages.select(F.col("value").cast("string").alias("value"))
    return text.select(F.inline(objects(F.col("value"), names))).drop(_END)


def decode(messages: DataFrame, topic: str) -> DataFrame:
    """Fields of a topic's messages as text; unreadable messages are left out, see :func:`malformed`.

    Unknown keys are dropped, missing ones become null, and a number is taken as its text.
    """
    return _readable(messages, schemas.TOPIC_FIELDS[topic])


def malformed(messages: DataFrame, topic: str) -> DataFrame:
    """The ``value`` of the messages that :func:`decode` leaves out, but for blank ones."""
    text = messages.select(F.col("value").cast("string").alias("value")).where(F.trim("value") != "")
    return text.where(F.size(objects(F.col("value"), schemas.TOPIC_FIELDS[topic])) == 0)


def decode_raw(messages: DataFrame) -> DataFrame:
    """Whole deliveries out of raw messages, whichever spellings they use."""
    rows = _readable(messages, [*schemas.RAW_FIELDS, "ball", *schemas.FIELD_ALIASES])
    for alias, name in schemas.FIELD_ALIASES.items():
        rows = rows.withColumn(name, F.coalesce(name, alias))
    over = F.when(F.col("ball").isNull(), F.col("over")).otherwise(_over_and_ball(F.col("over"), F.col("ball")))
    return rows.withColumn("over", over).select(*schemas.RAW_FIELDS)


def checked(messages: DataFrame) -> DataFrame:
    """Add ``fields`` (a struct of all topics' fields) and ``problem`` (null where the message is good).

    A message is good if its topic is known, it is one JSON object and nothing else, and it has
    every field of the topic; a field that is there but null is fine. The keys of a message are
    looked at only where one of its fields came out null.
    """
    text = F.col("value").cast("string")
    # A generator, like ``inline`` above: the fields are used many times and parsed once.
    parsed = messages.select("*", F.explode_outer(objects(text, schemas.ALL_FIELDS)).alias("fields"))
    keys = F.when(F.col("fields").isNotNull(), F.json_object_keys(text))
    filled = F.lit(None).cast("boolean")
    for topic, names in schemas.TOPIC_FIELDS.items():
        filled = F.when(F.col("topic") == topic, _all(F.col("fields")[name].isNotNull() for name in names)).otherwise(filled)
    # Short on purpose: code with a test per topic and field is too long for the JVM to compile.
    wanted = F.create_map(*[x for topic, names in schemas.TOPIC_FIELDS.items() for x in (F.lit(topic), F.lit(names))])
    named = F.size(F.array_except(F.try_element_at(wanted, F.col("topic")), keys)) == 0
    problem = (
        F.when(F.col("topic").isNull() | ~F.col("topic").isin(*schemas.TOPIC_FIELDS), "unknown topic")
        .when(filled, None)
        .when(keys.isNull(), "not a JSON object")
        .when(~named, "missing field")
    )
    return parsed.withColumn("problem", problem)


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def table_column(name: str) -> Column:
    """A typed table column out of the ``fields`` of :func:`checked`."""
    return F.col("fields")[name].try_cast(schemas.NUMERIC_FIELDS.get(name, "string")).alias(name)
