"""Invertible Bloom lookup sketches of documents, all in DataFrame functions.

A document's paragraphs (lines, cut after long sentences) are hashed to digests; the set of digests is laid
into ``REGIONS`` times ``WIDTH`` cells, one cell of each region per digest. A cell holds how many
digests fell into it, their XOR and the XOR of their check hashes. The cells, written as hex, are the
fingerprint: equal texts have equal ones.

Two sketches are subtracted cell by cell; what both hold cancels. A cell left with one digest (its
check fits) gives that digest up, which is then taken from its other cells, and so on: peeling recovers
the digests that differ. Where it gets stuck, both sets are split by a hash into parts of about
``PER_PART`` digests with sketches of their own, so many that they hold all digests; parts that get
stuck again have wider sketches with other hashes, ``RETRIES`` times, and after that a set difference.
Likeness is the Jaccard index of the two sets, from their sizes and the recovered digests.

Edge cases: a null text is empty; texts without paragraphs are alike (1.0) and unlike all others (0.0);
a repeated paragraph counts once; repeated documents have the same fingerprint; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

REGIONS, WIDTH = 3, 8
PER_PART = 9
#: Region widths of the sketches that parts are tried with, one after the other.
RETRIES = (8, 16, 32)
#: A part's peeling ends at the latest after so many rounds; a round without a new digest ends it sooner.
ROUNDS = 24
#: A line ends a paragraph, and so does a sentence of 60 characters or more.
PARAGRAPH_END = r"\R+|\s(?<=[.!?]\s)(?<=[^.!?\r\n]{60}[.!?]\s)\s*"
_CELL = "struct<n:bigint,x:bigint,h:bigint>"
_NONE = "array<bigint>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    """The set of paragraph digests."""
    trimmed = F.transform(F.split(text, PARAGRAPH_END), lambda p: F.trim(p))
    return F.array_distinct(F.transform(F.filter(trimmed, lambda p: p != ""), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _place(digest: Column, region: int, width: int, seed: int) -> Column:
    """The cell of a region that a digest falls into, counted over all regions."""
    at = F.pmod(F.xxhash64(digest, F.lit(seed * REGIONS + region)), F.lit(width))
    return (at + F.lit(region * width)).cast("int")


def _cell(n: Column, x: Column, h: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), x.alias("x"), h.alias("h"))


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a.bitwiseXOR(v))


def sketch(found: Column, width: int = WIDTH, seed: int = 0) -> Column:
    """The cells of a set of digests, one region after the other."""
    regions = []
    for region in range(REGIONS):
        placed = F.transform(found, lambda d: F.struct(d.alias("d"), _place(d, region, width, seed).alias("at")))
        cells = lambda both: F.transform(
            F.sequence(F.lit(region * width), F.lit((region + 1) * width - 1)),
            lambda i: let(
                F.transform(F.filter(both, lambda e: e["at"] == i), lambda e: e["d"]),
                lambda own: _cell(F.size(own), _xor(own), _xor(F.transform(own, _check))),
            ),
        )
        regions.append(let(placed, cells))
    return F.concat(*regions)


def fingerprint(cells: Column) -> Column:
    """The cells as hex: count (8 digits), digests (16), check hashes (16)."""
    written = F.transform(
        cells,
        lambda c: F.concat(
            F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["x"]), 16, "0"), F.lpad(F.hex(c["h"]), 16, "0")
        ),
    )
    return F.array_join(written, "")


def subtracted(left: Column, right: Column) -> Column:
    """The left sketch less the right one."""
    return F.zip_with(
        left, right, lambda a, b: _cell(a["n"] - b["n"], a["x"].bitwiseXOR(b["x"]), a["h"].bitwiseXOR(b["h"]))
    )


def peeled(cells: Column, width: int = WIDTH, seed: int = 0) -> Column:
    """What a subtracted sketch gives up: ``removed`` and ``added`` digests, and whether that is all (``ok``)."""
    empty = F.array().cast(_NONE)
    start = F.struct(
        cells.cast(f"array<{_CELL}>").alias("cells"), empty.alias("removed"), empty.alias("added"), F.lit(True).alias("on")
    )

    def pure_of(state: Column) -> Column:
        single = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["h"] == _check(c["x"])))
        known = F.array_distinct(F.transform(single, lambda c: F.struct(c["n"].alias("n"), c["x"].alias("x"))))
        return F.transform(
            known,
            lambda c: F.struct(
                c["n"].alias("n"),
                c["x"].alias("x"),
                _check(c["x"]).alias("h"),
                F.array(*(_place(c["x"], r, width, seed) for r in range(REGIONS))).alias("at"),
            ),
        )

    def round_of(state: Column, pure: Column) -> Column:
        left = F.transform(
            state["cells"],
            lambda c, i: F.aggregate(
                F.filter(pure, lambda p: (p["at"][0] == i) | (p["at"][1] == i) | (p["at"][2] == i)),
                c,
                lambda a, p: _cell(a["n"] - p["n"], a["x"].bitwiseXOR(p["x"]), a["h"].bitwiseXOR(p["h"])),
            ),
        )
        of_side = lambda n: F.transform(F.filter(pure, lambda p: p["n"] == n), lambda p: p["x"])
        return F.struct(
            left.alias("cells"),
            F.concat(state["removed"], of_side(1)).alias("removed"),
            F.concat(state["added"], of_side(-1)).alias("added"),
            F.lit(True).alias("on"),
        )

    def ended(state: Column) -> Column:
        return F.struct(state["cells"].alias("cells"), state["removed"].alias("removed"), state["added"].alias("added"), F.lit(False).alias("on"))

    def step(state: Column, _: Column) -> Column:
        going = let(pure_of(state), lambda pure: F.when(F.size(pure) == 0, ended(state)).otherwise(round_of(state, pure)))
        return F.when(state["on"], going).otherwise(state)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return let(
        end,
        lambda s: F.struct(
            s["removed"].alias("removed"),
            s["added"].alias("added"),
            (~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["x"] != 0) | (c["h"] != 0))).alias("ok"),
        ),
    )


def _parts(found: Column, n: Column) -> Column:
    """A set in ``n`` times ``n`` parts, split twice so that each digest is looked at ``2 n`` times."""
    split = lambda some, seed: F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda i: F.filter(some, lambda d: F.pmod(F.xxhash64(d, F.lit(seed)), n) == i),
    )
    return F.flatten(F.transform(split(found, -2), lambda some: split(some, -3)))


def with_difference(df: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """``df`` with ``out``: digests ``removed`` from the left set and ``added`` by the right one.

    The sets are columns ``<name>digests``, their sketches ``<name>cells``. Steps are columns of their
    own, so that each is computed once per row.
    """
    a, b = F.col(f"{left}digests"), F.col(f"{right}digests")
    first, lefts, rights, cells, tried, removed, added = (f"_{out}_{x}" for x in "first lefts rights cells tried removed added".split())
    df = df.withColumn(cells, subtracted(F.col(f"{left}cells"), F.col(f"{right}cells")))
    df = df.withColumn(first, peeled(F.col(cells))).withColumn(
        f"{out}_n", F.ceil(F.sqrt((F.size(a) + F.size(b)) / F.lit(PER_PART))).cast("bigint")
    )
    ok, nothing = F.col(f"{first}.ok"), F.array().cast(_NONE)
    no_parts = F.array().cast("array<array<bigint>>")
    df = df.withColumns(
        {
            lefts: F.when(ok, no_parts).otherwise(_parts(a, F.col(f"{out}_n"))),
            rights: F.when(ok, no_parts).otherwise(_parts(b, F.col(f"{out}_n"))),
            removed: F.when(ok, F.col(f"{first}.removed")).otherwise(nothing),
            added: F.when(ok, F.col(f"{first}.added")).otherwise(nothing),
        }
    )
    for k, width in enumerate(RETRIES):
        laid = F.zip_with(lefts, rights, lambda x, y: subtracted(sketch(x, width, k + 1), sketch(y, width, k + 1)))
        df = df.withColumn(cells, laid)
        df = df.withColumn(tried, F.transform(cells, lambda c: peeled(c, width, k + 1)))
        done = F.filter(tried, lambda t: t["ok"])
        stuck = lambda parts: F.filter(parts, lambda _, i: ~F.element_at(F.col(tried), i + 1)["ok"])
        df = df.withColumns(
            {
                lefts: stuck(lefts),
                rights: stuck(rights),
                removed: F.concat(removed, F.flatten(F.transform(done, lambda t: t["removed"]))),
                added: F.concat(added, F.flatten(F.transform(done, lambda t: t["added"]))),
            }
        )
    rest_left, rest_right = F.flatten(lefts), F.flatten(rights)
    whole = F.struct(
        F.concat(removed, F.array_except(rest_left, rest_right)).alias("removed"),
        F.concat(added, F.array_except(rest_right, rest_left)).alias("added"),
    )
    return df.withColumn(out, whole).drop(first, lefts, rights, cells, tried, removed, added, f"{out}_n")


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """Jaccard index of two sets from their sizes and the number of differing digests."""
    both = F.size(left) + F.size(right)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def fingerprinted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``digests``, ``cells`` and ``fingerprint``."""
    with_digests = docs.withColumn("digests", digests(F.coalesce(F.col(text_col), F.lit(""))))
    with_cells = with_digests.withColumn("cells", sketch(F.col("digests")))
    return with_cells.withColumn("fingerprint", fingerprint(F.col("cells")))


#: Documents whose ids agree but for the last bits are sorted together.
_BUCKET_BITS, _GROUP_BITS = 10, 18


def _following(buckets: DataFrame, levels: int = 2) -> DataFrame:
    """Each number ``b`` with the next higher one (``up``); after the highest comes the lowest.

    Numbers are sorted in groups of at most 2^18, then the groups' first numbers in the same way.
    """
    if levels == 0:
        order = Window.orderBy("b")  # at most 2^18 rows: what the bits leave
        return buckets.select("b", F.coalesce(F.lead("b").over(order), F.first("b").over(order)).alias("up"))
    grouped = buckets.withColumn("g", F.shiftright("b", _GROUP_BITS))
    firsts = grouped.groupBy("g").agg(F.min("b").alias("first"))
    above = _following(firsts.select(F.col("g").alias("b")), levels - 1)
    joined = above.join(firsts.select(F.col("g").alias("up"), F.col("first").alias("after")), "up")
    order = Window.partitionBy("g").orderBy("b")
    inside = grouped.withColumn("up", F.lead("b").over(order))
    return inside.join(joined.select(F.col("b").alias("g"), "after"), "g").select("b", F.coalesce("up", "after").alias("up"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``digests``, and the latter two of the next document in descending order of ids.

    Texts are shuffled once, by the leading bits of the id, and sorted there. A bucket's first document
    comes after the last one of the bucket above; it is handed over by a join of one row per bucket.
    Null ids come last, repeated ids in the order of their texts' hash.
    """
    bucket = F.shiftright(F.coalesce("doc_id", F.lit(-(2**63))), _BUCKET_BITS).alias("b")
    own = docs.select("doc_id", bucket, "text", digests(F.col("text")).alias("digests"))
    order = Window.partitionBy("b").orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    placed = own.withColumn("place", F.row_number().over(order)).withColumns(
        {"next_text": F.lead("text").over(order), "next_digests": F.lead("digests").over(order)}
    )
    up = _following(docs.select(bucket).distinct())
    handed = (
        placed.where("place = 1")
        .join(up, "b")
        .select(F.col("up").alias("b"), F.col("text").alias("first"), F.col("digests").alias("first_digests"))
    )
    return placed.join(handed, "b", "left").select(
        "doc_id",
        "text",
        "digests",
        F.coalesce("next_text", "first").alias("next_text"),
        F.coalesce("next_digests", "first_digests").alias("next_digests"),
    )


def edited_versions(docs: DataFrame) -> DataFrame:
    """The fingerprints of every text and of its edited text, and how like they are.

    The edited text has the last third replaced by the start of the next document.
    """
    clean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    both = with_next(clean).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.expr("cast(n_chars div 3 as int)")
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int"))
    edited = both.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), cut)))
    sets = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "digests",
        digests(F.col("edited")).alias("edited_digests"),
        "next_digests",
    )
    cells = sets.select(
        "*", *(sketch(F.col(f"{x}digests")).alias(f"{x}cells") for x in ("", "edited_", "next_"))
    )

    for other in ("edited", "next"):
        cells = with_difference(cells, "", f"{other}_", f"{other}_changes")

    def near(other: str) -> Column:
        changed = F.col(f"{other}_changes")
        return likeness(F.col("digests"), F.col(f"{other}_digests"), F.size(changed["removed"]) + F.size(changed["added"]))

    return cells.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("cells")).alias("fingerprint"),
        fingerprint(F.col("edited_cells")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )
