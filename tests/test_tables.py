import pytest

from cladeframe.operators import checks as V
from cladeframe.operators import counts as C
from cladeframe.runtime import DataError
from cladeframe.sources import reports as R
from cladeframe.sources import tables as S

SPECIES = ["moa", "emu", "kiwi", "rhea", "gull"]
#: Copies by rule: eight families, of which the third and the seventh have many copies in
#: several species, and none has one copy in all.
COPIES = {
    f"F{f}": [(f * f + 3 * s) % 6 + (90 * (s + 1) if f % 4 == 3 and s % 2 == 0 else 0) for s in range(5)] for f in range(1, 9)
}


def count_table():
    """The table with totals, and a blank row in it."""
    lines = ["\t".join(["Family", *SPECIES, "Total"])]
    for family, copies in COPIES.items():
        lines.append("\t".join(map(str, [family, *copies, sum(copies)])))
        if family == "F4":
            lines.append("\t" * 6)
    return "\n".join(lines) + "\n"


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def lines(folder):
    parts = sorted(folder.glob("part-*"))
    return [x for p in parts for x in p.read_text().splitlines()]


def test_gene_counts_round_trip(spark, tmp_path, rows):
    long, species = S.read_gene_counts(spark, put(tmp_path / "c.tsv", count_table()))
    assert species == SPECIES
    assert rows(long) == sorted(((f, s, n) for f, c in COPIES.items() for s, n in zip(SPECIES, c)), key=repr)
    wide = C.wide_counts(long, species)
    assert rows(wide) == sorted(((f, *c) for f, c in COPIES.items()), key=repr)
    assert rows(C.long_counts(wide, species)) == rows(long)
    # only the last column can be the total
    inner = put(tmp_path / "n.tsv", "F\ta\ttotal\tb\tc\nx\t1\t2\t3\t4\n")
    assert S.read_gene_counts(spark, inner)[1] == ["a", "total", "b", "c"]


def test_bad_counts(spark, tmp_path, rows):
    bad = put(tmp_path / "b.tsv", "F\ta\tb\nx\tNA\t2\ny\t1\nz\t-1\t 4 \n")
    long, _ = S.read_gene_counts(spark, bad)
    with pytest.raises(Exception, match="Non-integer or missing count"):
        long.collect()
    cells, _ = S.gene_count_cells(S.read_tsv(spark, bad))
    report = V.validate_counts(cells)
    assert rows(report, "code", "subject", "detail") == [
        ("negative_count", "z/a", "-1"), ("not_an_integer", "x/a", "NA"),
        ("not_an_integer", "y/b", "(missing)")]
    with pytest.raises(DataError):
        S.read_gene_counts(spark, put(tmp_path / "one.tsv", "F\nx\n"))
    with pytest.raises(DataError):
        S.read_gene_counts(spark, put(tmp_path / "t.tsv", "F\tTotal\nx\t1\n"))


@pytest.mark.parametrize("limit", [100, 300, None])
def test_matrix_and_size_filter(spark, tmp_path, rows, limit):
    long, species = S.read_gene_counts(spark, put(tmp_path / "c.tsv", count_table()))
    matrix = C.count_matrix(long, species, "fam")
    assert matrix.columns == ["Desc", "Family ID", *SPECIES]
    kept, large = C.split_large(matrix, species, *([limit] if limit else []))
    big = {f for f, c in COPIES.items() if limit and max(c) >= limit}
    assert {r[0] for r in rows(large, "Family ID")} == big
    assert {r[0] for r in rows(kept, "Family ID")} == set(COPIES) - big


def test_written_matrix(spark, tmp_path):
    long, species = S.read_gene_counts(spark, put(tmp_path / "c.tsv", count_table()))
    S.write_count_matrix(long, str(tmp_path / "m"), species)
    expected = {"\t".join(map(str, ["(null)", f, *c])) for f, c in COPIES.items()}
    assert set(lines(tmp_path / "m")) == expected | {"\t".join(["Desc", "Family ID", *SPECIES])}


def test_write_tsv(spark, tmp_path, table):
    df = table([("1", None, "x")], "a string, b string, extra string")
    S.write_tsv(df, str(tmp_path / "o"), ["b", "a", "c"])
    # every part file starts with the header
    assert set(lines(tmp_path / "o")) == {"b\ta\tc", "\t1\t"}
    back = S.read_tsv(spark, str(tmp_path / "o"))
    assert all(t == "string" for _, t in back.dtypes)


def test_totals_and_single_copy(spark, table, rows):
    members = table([("f1", "a"), ("f1", "b"), ("f2", "a"), ("f2", "a"), ("f3", "a")],
                    "family_id string, species string")
    wide = C.gene_counts(members, ["a", "b"])
    assert rows(wide) == [("f1", 1, 1, 2), ("f2", 2, 0, 2), ("f3", 1, 0, 1)]
    assert rows(C.single_copy(C.family_counts(members), 2)) == [("f1",)]


def test_memberships(spark, tmp_path, rows):
    text = "Orthogroup\tteal\twren\nOG0\tg1, g2\tc1\nOG1\t\tc2\n"
    got = S.read_orthogroups(spark, put(tmp_path / "o.tsv", text))
    assert rows(got) == [("OG0", "teal", "g1"), ("OG0", "teal", "g2"), ("OG0", "wren", "c1"), ("OG1", "wren", "c2")]
    assert rows(S.read_single_copy(spark, put(tmp_path / "s.txt", "OG1\nOG2\n\n"))) == [("OG1",), ("OG2",)]


def test_phenotype_table(spark, tmp_path, rows):
    text = "id\ttrait\tx\nteal\t Omnivore \t1\nnewt\tNA\t2\n\tLost\t3\nwren\t\t4\n"
    path = put(tmp_path / "p.tsv", text)
    got = S.read_phenotypes(spark, path, "id", "trait")
    assert rows(got) == [("newt", None), ("teal", "Omnivore"), ("wren", None)]
    with pytest.raises(DataError, match="nope"):
        S.read_phenotypes(spark, path, "id", "nope")


def test_search_artefacts(spark, tmp_path, rows):
    command = ("diamond blastp -d w/diamondDBSpecies{j} -q w/Species{i}.fa -o w/Blast{o} -p 1")
    text = "\n".join([
        "diamond commands that must be run",
        "  " + command.format(i=0, j=10, o="0_10.txt.gz"),
        command.format(i=1, j=0, o="2_0.txt.gz"),
        command.format(i=1, j=3, o="1_0.txt.gz"),
        command.format(i=4, j=5, o="x"),
        "diamond makedb --in x",
        "blastp -x",
    ])
    got = R.read_search_pairs(spark, put(tmp_path / "c.txt", text))
    assert rows(got, "qid", "did", "error") == [
        (0, 10, None), (1, 0, "database token disagrees"), (2, 0, "query token disagrees"),
        (4, 5, None), (None, None, "no species pair")]
    ids = R.read_species_ids(spark, put(tmp_path / "SpeciesIDs.txt", "0: a.fa\n#1: b.fa\n2: c.fa\n"))
    assert rows(ids) == [(0, "a.fa"), (2, "c.fa")]
    with pytest.raises(DataError):
        R.read_species_ids(spark, put(tmp_path / "e.txt", "#1: b.fa\n"))
    m = tmp_path / "m"
    m.mkdir()
    put(m / "search_task_3.txt", command.format(i=0, j=10, o="Blast0_10.txt.gz"))
    assert rows(R.read_task_manifests(spark, str(m))) == [(3, 0, 10)]
    r = tmp_path / "r"
    r.mkdir()
    put(r / "Blast0_1.txt.gz", "x")
    put(r / "other.txt", "x")
    assert rows(R.read_result_inventory(spark, str(r))) == [(0, 1, 1)]


def test_solver_logs(spark, tmp_path, rows):
    d = tmp_path / "logs"
    d.mkdir()
    dated = ["((a:1,b:1):3,(c:2,d:2):2);", "(((a:1,b:1):1,c:2):5,(d:4,e:4):3);"]
    put(d / "a.log", "[banner]\ntree first = [&R] ((a:.1,b:.2):.3,(c:.1,d:.7):.1);\nlines\n"
        f"TREE second = [&U] {dated[1]}\n  tree third = {dated[0]}  \nno tree here;\n")
    put(d / "c.log", f"tree only = [&r] {dated[1]}\n")
    assert rows(R.read_dated_trees(spark, str(d))) == [("a.log", dated[0]), ("c.log", dated[1])]
    put(d / "b.log", "nothing\n")
    with pytest.raises(DataError, match="b.log"):
        R.read_dated_trees(spark, str(d))


def test_turnover_outputs(spark, tmp_path, rows):
    d = tmp_path / "turnover"
    d.mkdir()
    put(d / "Base_count.tab", "FamilyID\tteal<1>\t<4>\nOG0\t3\t2\n")
    with pytest.raises(DataError, match="results.txt"):
        R.read_turnover(spark, str(d))
    put(d / "Base_results.txt", "ok")
    put(d / "Base_change.tab", "FamilyID\tteal<1>\t<4>\nOG0\t+1\t-2\n")
    put(d / "Gamma_family_results.txt", "#FamilyID\tpvalue\tSig\nOG0\t0.01\ty\n")
    put(d / "Second_count.tab", "FamilyID\t_canis<2>\tlutra<3>\nOG7\t11\tN/A\n")
    put(d / "Second_family_results.txt", "#FamilyID\tpvalue\nOG7\t0.5\n")
    got = R.read_turnover(spark, str(d))
    assert sorted(got) == ["changes", "counts", "pvalues"]
    assert rows(got["changes"], "family_id", "branch", "change") == [("OG0", "<4>", -2), ("OG0", "teal<1>", 1)]
    assert rows(got["counts"], "family_id", "node", "copies", "run")[2:] == [
        ("OG7", "_canis<2>", 11, "Second"), ("OG7", "lutra<3>", None, "Second")]
    assert rows(got["pvalues"], "family_id", "pvalue", "run") == [("OG0", 0.01, "Gamma"), ("OG7", 0.5, "Second")]
    put(d / "Third_count.tab", "FamilyID\tlutra<3>\nOG8\tmany\n")
    with pytest.raises(Exception, match="no number"):
        R.read_turnover(spark, str(d))["counts"].collect()
