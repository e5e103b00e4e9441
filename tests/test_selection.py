"""Order statistics, numbered lines, the completeness gate and configured calibrations."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cladeframe.functions import specs
from cladeframe.operators import selection
from cladeframe.operators import search as P
from cladeframe.operators.checks import validate_counts
from cladeframe.runtime import DataError
from cladeframe.sources import lines as L
from cladeframe.sources import tables as T
from cladeframe.streaming import gate as G

FRACTIONS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("pivots", [4, 512])
def test_quantiles_by_counting(spark, monkeypatch, pivots):
    """Ties, weights, groups of one value, a group without a name, missing values."""
    monkeypatch.setattr(selection, "PIVOTS", pivots)
    rng = random.Random(3)
    rows = [("ties", float(rng.randint(0, 5)), rng.randint(1, 4)) for _ in range(300)]
    rows += [("wide", rng.uniform(-1e9, 1e9), 1) for _ in range(2000)] + [("one", 7.5, 3), (None, 1.0, 2), (None, 2.0, 2)]
    rows += [("ties", None, 9), ("nothing", None, 1), ("wide", 5.0, 0)]
    got = selection.order_statistics(spark.createDataFrame(rows, "k string, value double, n bigint"), ["k"], FRACTIONS)
    expected = {}
    for k, v, n in rows:
        if v is not None and n:
            expected.setdefault(k, []).extend([v] * n)
    assert {r["k"]: list(r["q"]) for r in got.collect()} == {
        k: pytest.approx(list(np.quantile(v, FRACTIONS))) for k, v in expected.items()}
    empty = spark.createDataFrame([], "k string, value double, n bigint")
    assert selection.order_statistics(empty, ["k"], [0.5]).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_median_of_all_rows(spark, values):
    df = spark.createDataFrame([(v, 1) for v in values], "value double, n bigint")
    got = selection.order_statistics(df, [], [0.5]).first()["q"][0]
    assert got == pytest.approx(np.median(values), rel=1e-12, abs=1e-12)


def test_lines_are_numbered_over_pieces(spark, tmp_path, rows):
    folder = tmp_path / "t"
    folder.mkdir()
    texts = {"a.txt": [f"line {i}" * (i % 5) for i in range(3000)], "b c.txt": ["only"], "d+.txt": [str(i) for i in range(40)]}
    for name, content in texts.items():
        (folder / name).write_text("\n".join(content) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = L.numbered_lines(spark, str(folder)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["file"].rpartition("/")[2], r["line"], r["value"]) for r in got) == sorted(
        (name, i + 1, x) for name, content in texts.items() for i, x in enumerate(content))


def test_bad_counts_name_their_line(spark, tmp_path, rows):
    path = tmp_path / "c.tsv"
    path.write_text("Family\temu\trhea\tTotal\r\nF1\t1\t2\t3\r\n\t\t\t\r\n\r\nF2\tx\t\t0\r\nF3\t4\r\nF4\t-1\t0\t0\r\n")
    cells, species = T.read_count_cells(spark, str(path))
    assert species == ["emu", "rhea"]
    assert rows(validate_counts(cells), "code", "subject", "detail") == [
        ("negative_count", "F4/emu", "line 7: -1"), ("not_an_integer", "F2/emu", "line 5: x"),
        ("not_an_integer", "F2/rhea", "line 5: (missing)"), ("not_an_integer", "F3/rhea", "line 6: (missing)")]
    with pytest.raises(Exception, match="count at line [56]"):
        T.read_gene_counts(spark, str(path))[0].collect()
    (tmp_path / "empty.tsv").write_text("")
    with pytest.raises(DataError):
        T.read_count_cells(spark, str(tmp_path / "empty.tsv"))


def test_gate_over_restarts(spark, tmp_path, rows, monkeypatch):
    """Results that come late, again, empty first, or for species that are not known."""
    monkeypatch.setattr(G, "BITS", 64)  # several keys a query
    rng = random.Random(2)
    ids = spark.createDataFrame([(i * 3,) for i in range(150)], "id bigint")
    ranked = G.positions(ids)
    every = []
    for run in range(3):
        part = [(rng.randrange(150) * 3, rng.randrange(150) * 3, rng.randint(0, 3)) for _ in range(9000)]
        part += [(1, 3, 5), (3, 1, 5), (6, 6, None)]
        every += part
        spark.createDataFrame(part, G.RESULTS).repartition(4).write.mode("append").parquet(str(tmp_path / "arrivals"))
        G.run_gate(spark, str(tmp_path / "arrivals"), ranked, str(tmp_path / "gate"), files_per_batch=3)
        expected = P.missing_pairs(ids, spark.createDataFrame(every, G.RESULTS))
        assert rows(G.still_missing(spark, str(tmp_path / "gate"), ranked)) == rows(expected)
    # nothing new: nothing is written
    before = sorted((tmp_path / "gate" / "gate").iterdir())
    G.run_gate(spark, str(tmp_path / "arrivals"), ranked, str(tmp_path / "gate"))
    assert sorted((tmp_path / "gate" / "gate").iterdir()) == before
    present = {(q, d) for q, d, n in every if n and q % 3 == 0 and d % 3 == 0}
    total = G.gate_rows(spark, str(tmp_path / "gate")).agg(F.sum("n_present")).first()[0]
    assert total == len(present)


def test_calibrations_from_lists_and_config(spark, rows):
    got = specs.calibrations_from_lists(spark, ["emu, rhea", "moa,kiwi,gull"], ["5-9", "3"])
    assert rows(got, "name", "sp1", "sp2", "min_age", "max_age", "error") == [
        ("emu_rhea", "emu", "rhea", 5.0, 9.0, None), (None, None, None, None, None, "not two taxa")]
    with pytest.raises(ValueError, match="2 pairs and 1 ages"):
        specs.calibrations_from_lists(spark, ["a,b", "c,d"], ["1"])
    entries = spark.createDataFrame(
        [("old one", ["emu", "rhea"], 12.0, None, None), (None, ["moa", "kiwi"], None, 3.0, None), ("", ["a", "b"], None, None, 4.0),
         ("n", ["a"], 1.0, None, None), ("m", ["a", "b"], None, None, None), ("o", None, 1.0, None, None)],
        "name string, taxa array<string>, age double, min_age double, max_age double")
    assert rows(specs.calibrations_from_config(entries), "name", "sp1", "sp2", "age", "min_age", "max_age", "error") == [
        ("a_b", "a", "b", None, None, 4.0, None), ("moa_kiwi", "moa", "kiwi", None, 3.0, None, None),
        ("old_one", "emu", "rhea", 12.0, None, None, None),
        (None, None, None, None, None, None, "no age"), (None, None, None, None, None, None, "not two taxa"),
        (None, None, None, None, None, None, "not two taxa")]
