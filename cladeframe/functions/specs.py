"""Age, calibration, cost and label expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .headers import sanitize_name

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _number(token: Column) -> Column:
    return F.when(token.rlike(NUMBER), token.cast("double"))


def parse_age(spec) -> Column:
    """``'94'``, ``'100-120'``, ``'100-'`` or ``'-120'`` as a struct
    ``(age, min_age, max_age, error)``.

    A token that reads as a number is a fixed age, so ``'-120'`` is the age
    -120, which is flagged in ``error``.
    """
    token = _strip(_col(spec))
    fixed = _number(token)
    low = _strip(F.regexp_extract(token, r"^([^-]*)-", 1))
    high = _strip(F.regexp_extract(token, r"^[^-]*-(.*)$", 1))
    low_n, high_n = _number(low), _number(high)
    windowed = fixed.isNull() & token.contains("-")
    malformed = (
        (windowed & (low == "") & (high == ""))
        | (windowed & (low != "") & low_n.isNull())
        | (windowed & (high != "") & high_n.isNull())
        | (fixed.isNull() & ~token.contains("-"))
        | token.isNull()
    )
    ok_window = windowed & ~malformed
    error = F.when(malformed, F.lit("unreadable age")).when(fixed < 0, F.lit("negative age"))
    return F.struct(
        fixed.alias("age"),
        F.when(ok_window, low_n).alias("min_age"),
        F.when(ok_window, high_n).alias("max_age"),
        error.alias("error"),
    )


def parse_calibrations(df: DataFrame, spec="spec") -> DataFrame:
    """Rows ``NAME:SP1,SP2:AGE`` to ``(name, sp1, sp2, age, min_age, max_age, error)``."""
    parts = F.split(_col(spec), ":")
    taxa = F.split(F.get(parts, F.lit(1)), ",")
    fields = df.select(
        _col(spec).alias("spec"),
        (F.size(parts) == 3).alias("three"),
        (F.size(taxa) == 2).alias("two"),
        sanitize_name(F.get(parts, F.lit(0))).alias("name"),
        _strip(F.get(taxa, F.lit(0))).alias("sp1"),
        _strip(F.get(taxa, F.lit(1))).alias("sp2"),
        parse_age(F.get(parts, F.lit(2))).alias("a"),
    )
    good = F.col("three") & F.col("two")
    return fields.select(
        "spec",
        *[F.when(good, F.col(c)).alias(c) for c in ("name", "sp1", "sp2")],
        *[F.when(good, F.col(f"a.{c}")).alias(c) for c in ("age", "min_age", "max_age")],
        F.when(~F.col("three"), F.lit("not NAME:SP1,SP2:AGE"))
        .when(~F.col("two"), F.lit("not two taxa"))
        .otherwise(F.col("a.error"))
        .alias("error"),
    )


def pairs_to_calibrations(df: DataFrame, pair="pair", age="age_spec") -> DataFrame:
    """Rows with ``'SP1,SP2'`` and an age token; the name is built from the pair."""
    taxa = F.split(_col(pair), ",")
    named = F.concat_ws("_", _strip(F.get(taxa, F.lit(0))), _strip(F.get(taxa, F.lit(1))))
    spec = F.concat_ws(":", sanitize_name(named), _col(pair), _col(age))
    return parse_calibrations(df.withColumn("spec", spec), "spec")


def calibrations_from_lists(spark, pairs: list[str], ages: list[str]) -> DataFrame:
    """Calibrations from a list of ``'SP1,SP2'`` and one of age tokens of equal length."""
    if len(pairs) != len(ages):
        raise ValueError(f"each pair needs an age: got {len(pairs)} pairs and {len(ages)} ages")
    rows = spark.createDataFrame(list(zip(pairs, ages)), "pair string, age_spec string")
    return pairs_to_calibrations(rows)


def calibrations_from_config(entries: DataFrame) -> DataFrame:
    """Configured entries ``name, taxa array<string>, age, min_age, max_age`` to the columns of
    ``parse_calibrations``; a missing name is made from the taxa."""
    two = F.size("taxa") == 2
    given = F.coalesce("age", "min_age", "max_age").isNotNull()
    blank = F.coalesce(F.col("name"), F.lit("")) == ""
    name = F.when(blank, F.concat_ws("_", "taxa")).otherwise(F.col("name"))
    error = F.when(~F.coalesce(two, F.lit(False)), F.lit("not two taxa")).when(~given, F.lit("no age"))
    good = error.isNull()
    values = {
        "name": sanitize_name(name), "sp1": F.get("taxa", F.lit(0)), "sp2": F.get("taxa", F.lit(1)),
        "age": F.col("age").cast("double"), "min_age": F.col("min_age").cast("double"), "max_age": F.col("max_age").cast("double"),
    }
    return entries.select(
        F.concat_ws(":", name, F.concat_ws(",", "taxa")).alias("spec"),
        *[F.when(good, value).alias(column) for column, value in values.items()], error.alias("error"),
    )


def pair_cost(query_bytes, db_bytes) -> Column:
    """Exact product of two sizes."""
    wide = "decimal(19,0)"
    return _col(query_bytes).cast(wide) * _col(db_bytes).cast(wide)


def merge_labels(label, substitutions=(), merge_only=()) -> Column:
    """Collapse fine labels: first every ``merge_only`` pair ``(a, b)`` (a value
    containing both becomes ``b``), then every exact substitution ``(from, to)``,
    each in list order, so that they chain.  Nulls stay null.
    """
    out = _col(label)
    for a, b in merge_only or ():
        out = F.when(out.contains(a) & out.contains(b), F.lit(b)).otherwise(out)
    for old, new in substitutions or ():
        out = F.when(out == old, F.lit(new)).otherwise(out)
    return out
