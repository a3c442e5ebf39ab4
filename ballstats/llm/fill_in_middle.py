"""Fill-in-the-middle transformation: a text's middle is moved behind its prefix and suffix.

A text is a run of units. One ``fullmatch`` of ``(unit)*`` by the regex library keeps every repetition of
its group: ``ends(1)`` says how many units there are, and its k-th entry where the first k of them end.
So both places to cut at are looked up, and nothing is counted or walked through.

Where to cut and which form a text takes is drawn from the SHA-256 of the seed and the id, so that a
retry, another partitioning or another run gives the same rows.

Edge cases: a null text is empty; an empty text, one that holds a mark and one that is no run of units
stay as they are (``plain``), the last with no ``n``; an id that is null is drawn for like an empty one;
repeated rows are rows of their own; columns other than id and text are not looked at. The library keeps
some 250 bytes for a repetition, so texts are matched in parts of ``AT_ONCE`` code points if a unit is one
code point, where a part cannot change what its neighbours match; other units need the text in one part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common

CODE_POINT = "."
AT_ONCE = 1 << 16
#: Marks put before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"
_DRAWN = ("h1", "h2", "h3", "h4")
_TRANSFORMED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output", pa.string()),
    ]
)


def drawn(doc_id: str, seed: int) -> list[Column]:
    """``h1`` to ``h4``: the first groups of 8 hexadecimal digits of a hash of seed and id, as numbers."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long").alias(name) for k, name in enumerate(_DRAWN)]


def checked(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    """The marks, if none can be seen where one of them meets a text that holds none."""
    if len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are needed, none of them empty")
    for a in marks:
        heads = [a[:k] for k in range(1, len(a))]
        if any(b.endswith(head) for b in marks for head in heads) or any(a in b for b in marks if b != a):
            raise ValueError(f"marks {marks} overlap")
    return marks


def ends(text: str, pattern: regex.Pattern, at_once: int | None = AT_ONCE) -> np.ndarray | None:
    """Where each unit of the text ends; None if the text is no run of units."""
    size = at_once or max(len(text), 1)
    found = []
    for start in range(0, len(text), size):
        match = pattern.fullmatch(text, start, min(start + size, len(text)))
        if match is None:
            return None
        found.append(np.array(match.ends(1), np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def transformed(
    docs: DataFrame,
    seed: int = 1,
    unit: str = CODE_POINT,
    plain_from: int = 90,
    suffix_first_below: int = 20,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """Per document ``n`` units, ``form``, lengths of prefix and middle in code points, and the ``output``.

    Of 100 documents those from ``plain_from`` on stay plain, and of the others the first
    ``suffix_first_below`` have the suffix before the prefix.
    """
    before, after, between = checked(marks)
    at_once = AT_ONCE if unit == CODE_POINT else None

    def one(pattern: regex.Pattern, text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
        places = ends(text, pattern, at_once)
        if places is None:
            return None, PLAIN, None, None, text
        n = len(places)
        if not n or h3 % 100 >= plain_from or any(mark in text for mark in marks):
            return n, PLAIN, None, None, text
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m = (int(places[k - 1]) if k else 0 for k in (first, second))
        if h4 % 100 < suffix_first_below:
            form, out = SUFFIX_FIRST, (after, text[m:], before, text[:p], between, text[p:m])
        else:
            form, out = PREFIX_FIRST, (before, text[:p], after, text[m:], between, text[p:m])
        return n, form, p, m - p, "".join(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(f"({unit})*+", regex.DOTALL)
        for part in common.parts(batches):
            texts, *numbers = (part.column(name).to_pylist() for name in ("text", *_DRAWN))
            rows = [one(pattern, *row) for row in zip(texts, *numbers, strict=True)]
            columns = [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), list(_TRANSFORMED)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], schema=_TRANSFORMED)

    given = common.id_and_text(docs).select("doc_id", "text", *drawn("doc_id", seed))
    return given.mapInArrow(run, common.ddl(_TRANSFORMED))


def restored(marks: tuple[str, str, str] = MARKS) -> Column:
    """The text, rebuilt from ``output`` and ``form`` alone."""
    quoted = "|".join(f"\\Q{mark}\\E" for mark in checked(marks))
    part = F.split("output", quoted, -1)
    whole = F.when(F.col("form") == PREFIX_FIRST, F.concat(part[1], part[3], part[2]))
    whole = whole.when(F.col("form") == SUFFIX_FIRST, F.concat(part[2], part[3], part[1]))
    return whole.otherwise(F.col("output"))


def digests(docs: DataFrame) -> DataFrame:
    """:func:`transformed` with SHA-256 of the output and of the text rebuilt from it."""
    hashed = lambda text: F.sha2(text.cast("binary"), 256)
    return transformed(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        hashed(F.col("output")).alias("output_sha256"),
        hashed(restored()).alias("restored_sha256"),
    )
