"""Column expressions over texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Runs of ASCII white space, the word separator of most contracts.
WHITE = r"[\x20\x09-\x0D]+"
#: The same characters one by one, for ``translate``.
WHITE_CHARS = " \t\n\x0b\x0c\r"
#: Everything ASCII that is no lower-case letter or digit.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: Column) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column, separators: str = WHITE) -> Column:
    """Words between separators, in order; none for an empty or missing text."""
    return F.array_remove(F.split(whole(text), separators), "")


def lower_ascii(text: Column) -> Column:
    """``A-Z`` lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def covered(spans: Column) -> Column:
    """Positions covered by an array of ``struct<pos int, len int>``."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(acc, s):
        stop = F.greatest(acc["end"], s["pos"] + s["len"])
        fresh = stop - F.greatest(acc["end"], s["pos"])
        return F.struct((acc["n"] + F.greatest(fresh, F.lit(0))).alias("n"), stop.alias("end"))

    return F.aggregate(F.sort_array(spans), start, add, lambda acc: acc["n"])
