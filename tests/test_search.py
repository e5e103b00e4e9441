from fractions import Fraction
from statistics import median

import pytest
from pyspark.sql import functions as F

from cladeframe.operators import checks as V
from cladeframe.operators import search as P


def test_missing_pairs_and_tasks(table, rows):
    ids = table([(0,), (1,), (10,), (7,)], "id int")
    present = [(i, j, 1) for i in (0, 1, 10, 7) for j in (0, 1, 10, 7) if (i, j) not in {(0, 1), (10, 10), (7, 0), (7, 1)}]
    found = table(present + [(0, 1, 0), (99, 0, 5), (0, 99, 5)], "qid int, did int, length long")
    missing = P.missing_pairs(ids, found)
    assert rows(missing) == [(0, 1), (10, 10), (7, 0), (7, 1)]
    assert tuple(P.completeness(ids, missing).first()) == (16, 12, 4)
    manifest = table([(1, 0, 10), (2, 0, 1), (2, 7, 0), (3, 1, 1), (4, 7, 1)], "task_id int, qid int, did int")
    assert rows(P.pairs_to_tasks(missing, manifest)) == [(2,), (4,)]
    everything = P.missing_pairs(ids, found.where("false"))
    assert everything.count() == 16
    complete = table([(i, j, 1) for i in (0, 1, 10, 7) for j in (0, 1, 10, 7)], "qid int, did int, length long")
    assert P.missing_pairs(ids, complete).count() == 0


def test_missing_pairs_do_not_multiply_the_species(table):
    ids = table([(0,), (1,)], "id int")
    plan = P.missing_pairs(ids, table([(0, 0, 1)], "qid int, did int, length long"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in text


def test_costs(table, rows):
    big = 104_857_600
    sizes = table([(0, big), (1, big + 1), (2, 3)], "id int, size_bytes long")
    pairs = table([(0, 1), (1, 0), (2, 2), (2, 9)], "qid int, did int")
    costed = P.pair_costs(pairs, sizes)
    got = {(r["qid"], r["did"]): r["cost"] for r in costed.collect()}
    assert int(got[0, 1]) == big * (big + 1) and int(got[2, 2]) == 9 and got[2, 9] is None
    manifest = table([(5, 0, 1), (5, 1, 0), (6, 2, 2)], "task_id int, qid int, did int")
    summary = P.bucket_summary(costed, manifest)
    best = P.busiest_task(summary).first()
    assert (int(best["max_task_cost"]), best["busiest_task"], best["largest_db_bytes"]) == (
        2 * big * (big + 1), 5, big + 1)


def test_plan_check(table, rows):
    ids = table([(0,), (2,)], "id int")
    databases = table([("diamondDBSpecies0.dmnd",), ("diamondDBSpecies2.dmnd",)], "name string")
    full = table([(i, j) for i in (0, 2) for j in (0, 2)], "qid int, did int")
    assert P.search_plan_check(full, ids, databases).count() == 0
    report = P.search_plan_check(full.where("qid = 0"), ids, databases.where("name like '%0.dmnd'"))
    assert rows(report, "code", "subject", "detail") == [
        ("incomplete_plan", "search plan", "2 of 4 searches"), ("missing_database", "2", "diamondDBSpecies2.dmnd")]


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_throughput(table, n):
    runs = [(10 * i * i + 3, float(i % 5)) for i in range(n + 1)]
    got = P.throughput(table(runs, "cost long, seconds double")).first()
    rates = [Fraction(c) / Fraction(s) for c, s in runs if s > 0]
    assert got["n_runs"] == n + 1
    assert got["median_rate"] == pytest.approx(float(median(rates)))
    assert (got["min_rate"], got["max_rate"]) == (pytest.approx(float(min(rates))), pytest.approx(float(max(rates))))
    assert got["aggregate_rate"] == pytest.approx(sum(c for c, _ in runs) / sum(s for _, s in runs))


def test_volume(table):
    assert tuple(P.proteome_volume(table([(5,), (7,)], "length long")).first()) == (12, 7, 2)
    assert tuple(P.proteome_volume(table([], "length long")).first()) == (0, 0, 0)


def test_proteome_folder(spark, tmp_path):
    def report():
        return sorted((r["code"], r["subject"]) for r in V.validate_proteomes(spark, str(tmp_path)).collect()
                      if r["severity"] != "INFO")

    for i in range(5):
        (tmp_path / f"species{i}.fa").write_text(">a\nM\n")
    assert report() == []
    (tmp_path / "empty.fasta").write_text("")
    (tmp_path / "text.faa").write_text("MKT\n>a\nM\n")
    (tmp_path / "species0.faa").write_text(">a\nM\n")
    (tmp_path / "odd name.fa").write_text(">a\nM\n")
    (tmp_path / ("x" * 201 + ".fa")).write_text(">a\nM\n")
    assert report() == [
        ("duplicate_species", "species0"), ("empty_file", "empty.fasta"),
        ("long_name", "x" * 201 + ".fa"), ("not_fasta", "text.faa"), ("unusual_name", "odd name.fa")]
    few = tmp_path / "few"
    few.mkdir()
    (few / "a.fa").write_text(">a\nM\n")
    assert [r["code"] for r in V.validate_proteomes(spark, str(few)).where("severity = 'ERROR'").collect()] == ["too_few_species"]


def test_record_checks(table, rows):
    records = table([("a", "x", "x gene:1", 3), ("a", "x", "x gene:1", 0), ("b", "XP_1", "XP_1 p [M]", 5)],
                    "species string, accession string, header string, length int")
    expected = table([("a",), ("b",), ("c",)], "species string")
    report = V.validate_proteome_set(records, expected, "ensembl")
    assert rows(report, "code", "subject", "detail") == [
        ("duplicate_accession", "a", "1"), ("empty_sequence", "a", "1"),
        ("header_format", "b", "1"), ("missing_species", "c", "no proteome")]
    widths = V.alignment_width(table([("t", 12), ("t", 12), ("u", 4), ("u", 2)], "species string, length int"))
    assert rows(widths) == [("t", 2, 12, True), ("u", 2, None, False)]
    was = table([("p", "1"), ("q", "2"), ("r", "3")], "path string, md5 string")
    now = table([("p", "1"), ("q", "9"), ("s", "4")], "path string, md5 string")
    assert rows(V.verify_manifest(was, now)) == [("q", "changed"), ("r", "missing"), ("s", "new")]


def test_global_rank_with_ties(spark):
    from cladeframe.runtime import global_rank

    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("k"))
    got = global_rank(df, [F.col("k").desc(), F.col("id")], "pos").collect()
    expected = sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert {r["id"]: r["pos"] for r in got} == {i: p for p, i in enumerate(expected)}


def test_costs_are_added_exactly(table):
    got = P.throughput(table([(2**53 + 1, 1.0), (2, 3.0)], "cost long, seconds double")).first()
    assert int(got["total_cost"]) == 2**53 + 3


def test_a_command_list_is_written_by_several_tasks(spark, tmp_path):
    import glob

    import __spark_entry__ as entry
    from cladeframe.runtime import checkpoint_root

    spark.range(400).selectExpr(
        "id as l_orderkey", "cast(id % 7 + 1 as int) as l_linenumber", "id % 50 as l_partkey", "id % 9 as l_suppkey"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = set(glob.glob(f"{checkpoint_root(spark)}/commands-*"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = entry.queries()["search_command_file"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder, = set(glob.glob(f"{checkpoint_root(spark)}/commands-*")) - seen
    assert len(glob.glob(f"{folder}/commands/part-*")) > 1
    expected = {i: (i % 50, i % 9) for i in range(400) if i % 7 != 6}
    assert {r["line_index"]: (r["qid"], r["did"]) for r in got if r["error"] is None} == {
        i: pair for i, pair in expected.items() if i % 7 not in (4, 5)
    }
    assert {r["line_index"] for r in got} == set(expected)
