import bz2
import gzip
import hashlib
import random
import re
import warnings

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cladeframe.operators import isoforms as A
from cladeframe.plans.cleaning import clean_directory
from cladeframe.runtime import DataError
from cladeframe.sources import fasta as S
from cladeframe.sources import fasta_source, splitting
from cladeframe.sources import files as FS

def proteome(seed, layout, genes=9, loose=0):
    """A proteome by rule: gene ``g`` has ``1 + g * seed % 4`` records, shuffled; ``loose``
    records name no gene.  Returns its text and ``(header, sequence, gene)`` of its records."""
    draw = random.Random(seed)
    found = []
    for g in range(genes):
        for i in range(1 + g * seed % 4):
            sequence = "M" + "".join(draw.choices("ACDEFGHIKLMNPQRSTVWY", k=draw.randint(3, 150)))
            if layout == "tagged":
                header = f"T{seed}.{g}.{i} pep chromosome:{g}:{i} {draw.choice(['gene:', 'gene='])}G{g}.{seed} biotype:x"
                found.append((header, sequence, f"G{g}.{seed}"))
            else:
                form = f" isoform X{i + 1}" if i else ""
                header = f"XP_{seed}{g:03d}{i}.1 enzyme {g} like{form} [Alces alces]"
                # without the isoform's mark each record is a gene of its own
                found.append((header, sequence, f"enzyme {g} like [Alces alces]" if i else header))
    found += [(f"L{k}.{seed} pep scaffold:{k}", "M" * (k + 2), None) for k in range(loose)]
    draw.shuffle(found)
    text = "".join(f">{h}\n" + "".join(f"{q[i : i + 41]}\n" for i in range(0, len(q), 41)) for h, q, _ in found)
    return text, found


def longest(found):
    """The first of the longest records of each gene, and all without a gene."""
    best = {}
    for k, (_, q, gene) in enumerate(found):
        key = gene if gene is not None else k
        if key not in best or len(q) > len(found[best[key]][1]):
            best[key] = k
    return [found[k] for k in sorted(best.values())]


def stats(records, **kw):
    return A.filter_stats(records, **kw).first().asDict()


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("layout, name", [("tagged", "ensembl"), ("bracketed", "ncbi")])
@pytest.mark.parametrize("seed", [3, 7])
def test_header_layouts(spark, tmp_path, rows, layout, name, seed):
    text, found = proteome(seed, layout, loose=4 if layout == "tagged" else 0)
    r = S.read_fasta(spark, put(tmp_path / "Alces_alces.v3.fa", text))
    assert rows(r, "header", "sequence") == sorted((h, q) for h, q, _ in found)
    kept = longest(found)
    loose = sum(g is None for _, _, g in found)
    assert stats(r) == {
        "species": "Alces_alces.v3", "total_records": len(found), "unique_genes": len(kept) - loose,
        "unidentified": loose, "output_records": len(kept), "detected_format": name}
    assert rows(A.longest_isoform(r), "header", "sequence", "gene_id") == sorted(kept, key=repr)


def test_unidentified_are_kept_after_genes_in_order(spark, tmp_path):
    text = ">B x\nMM\n>A2 gene:G2\nMMM\n>C y\nMM\n>A1 gene:G1\nMMM\n"
    r = S.read_fasta(spark, put(tmp_path / "s.fa", text))
    S.write_fasta(A.longest_isoform(r), str(tmp_path / "out"))
    parts = sorted((tmp_path / "out" / "species=s").glob("part-*.fa"))
    written = "".join(p.read_text() for p in parts)
    assert [x.split()[0] for x in written.splitlines() if x[0] == ">"] == [">A1", ">A2", ">B", ">C"]
    assert stats(r)["unidentified"] == 2


def test_ties_go_to_the_first_record(spark, tmp_path):
    text = ">A gene:G\nMMM\n>B gene:G\nKKK\n"
    r = S.read_fasta(spark, put(tmp_path / "s.fa", text))
    assert A.longest_isoform(r).first()["accession"] == "A"


def test_duplicate_accessions(spark, tmp_path, rows):
    # three accessions come again, one of them twice; the first record counts, longer or not
    text, found = proteome(5, "tagged")
    again = [found[i] for i in (1, 4, 4, 9)]
    text += "".join(f">{h}\n{q}{'K' * 400 if k % 2 else ''}\n" for k, (h, q, _) in enumerate(again))
    r = S.read_fasta(spark, put(tmp_path / "d.fa", text))
    with pytest.raises(DataError, match="Duplicate accession"):
        A.longest_isoform(r, on_duplicate="error")
    for policy in ("skip", "warn"):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            kept = A.longest_isoform(r, on_duplicate=policy)
            assert rows(kept, "header", "sequence", "gene_id") == sorted(longest(found), key=repr)
            assert stats(r, on_duplicate=policy)["total_records"] == len(found) + 4
    with pytest.raises(ValueError):
        A.longest_isoform(r, on_duplicate="never")


def test_format_is_detected_once_per_species(spark, tmp_path):
    text = ">XP_1 a isoform X1 [M]\nMM\n>E2 gene:G1\nMMM\n>E3 gene:G1\nMMMM\n"
    r = S.read_fasta(spark, put(tmp_path / "s.fa", text))
    genes = {k["gene_id"] for k in A.longest_isoform(r).collect()}
    assert genes == {"a [M]", "E2 gene:G1", "E3 gene:G1"}


def test_several_files_are_one_species(spark, tmp_path, rows):
    texts = [proteome(seed, "tagged", genes=4) for seed in (2, 3, 5)]
    paths = [put(tmp_path / name, text) for name, (text, _) in zip(("z.fa", "m.fa", "a.fa"), texts)]
    r = S.read_fasta(spark, paths, species="sp")
    in_order = [x["header"] for x in r.orderBy("ord").collect()]
    assert in_order == [h for _, found in texts for h, _, _ in found]
    assert {x["species"] for x in r.collect()} == {"sp"}
    with pytest.raises(ValueError):
        S.read_fasta(spark, paths)


@pytest.mark.parametrize("split", [1 << 26, 700, 37])
def test_formats_are_told_by_content(spark, tmp_path, rows, split):
    text, found = proteome(11, "tagged", genes=30)
    expected = sorted((h, q) for h, q, _ in found)
    folder = tmp_path / "c"
    folder.mkdir()
    data = text.encode()
    half = data.index(b"\n", len(data) // 2)
    files = {
        "plain.fa": data, "zip.fa.gz": gzip.compress(data), "block.fa.bz2": bz2.compress(data),
        "hidden.fa": gzip.compress(data[:half]) + gzip.compress(data[half:]), "wrong.fa.gz": data,
        "streams.faa": bz2.compress(data[:half]) + bz2.compress(data[half:]),
    }
    for name, content in files.items():
        (folder / name).write_bytes(content)
    got = S.read_fasta_directory(spark, str(folder), split_bytes=split).cache()
    for species in ("plain", "zip", "block", "hidden", "wrong", "streams"):
        assert rows(got.where(F.col("species") == species), "header", "sequence") == expected, species
    in_order = [r["header"] for r in got.where("species = 'streams'").orderBy("ord").collect()]
    assert in_order == [h for h, _, _ in found]


def test_bzip2_blocks_are_decoded_apart(tmp_path):
    """Ranges of one file give its records once, wherever they are cut."""
    lines = "".join(f">R{i}\n{random.Random(i).randbytes(900).hex()}\n" for i in range(700))
    path = tmp_path / "x.bz2"
    path.write_bytes(bz2.compress(lines.encode(), 1))
    size = path.stat().st_size
    with open(path, "rb") as handle:
        blocks = [m for m, is_block in splitting._marks(handle, 0, size) if is_block]
        assert len(blocks) > 8
        for step in (size, 100_000, 33_333):
            got = []
            for start in range(0, size, step):
                chunks = splitting.decoded(handle, start, min(start + step, size), size)
                got += [b.split(b"\n")[0] for b in fasta_source.record_bodies(chunks, start == 0)]
            assert got == [b"R%d" % i for i in range(700)]


def test_many_small_ranges_share_tasks(tmp_path):
    """The number of tasks is bounded, the ranges are as asked for."""
    import json

    path = put(tmp_path / "x.fa", "".join(f">R{i}\n{'M' * (i % 90)}\n" for i in range(4000)))
    size = (tmp_path / "x.fa").stat().st_size
    options = {"paths": json.dumps([path]), "splitbytes": "50"}
    plan = fasta_source.plan_ranges(options)
    parts = [p for r in plan for p in r.parts]
    assert [p[2:4] for p in parts] == [(i, min(i + 50, size)) for i in range(0, size, 50)]
    assert len(parts) > 3 * fasta_source.TASKS >= len(plan) * 2
    reader = fasta_source.FastaReader(options)
    got = [h for r in plan for b in reader.read(r) for h in b.column("header").to_pylist()]
    assert got == [f"R{i}" for i in range(4000)]


def test_small_ranges_read_little_beyond_their_end(tmp_path, monkeypatch):
    """A range without a bzip2 block decodes none, a plain one reads on in small steps."""
    lines = "".join(f">R{i}\n{random.Random(i).randbytes(900).hex()}\n" for i in range(1400))
    packed, plain = tmp_path / "x.bz2", tmp_path / "x.fa"
    packed.write_bytes(bz2.compress(lines.encode(), 9))
    plain.write_text(lines)
    decode, decoded = splitting.decode_block, []
    monkeypatch.setattr(splitting, "decode_block", lambda *a: decoded.append(a) or decode(*a))
    for path in (packed, plain):
        size, got = path.stat().st_size, []
        with open(path, "rb") as handle:
            for start in range(0, size, 1 << 16):
                chunks = list(splitting.decoded(handle, start, min(start + (1 << 16), size), size))[:2]
                assert path == packed or all(len(data) <= 1 << 16 for data, _ in chunks)
                chunks = splitting.decoded(handle, start, min(start + (1 << 16), size), size)
                got += [b.split(b"\n")[0] for b in fasta_source.record_bodies(chunks, start == 0)]
        assert got == [b"R%d" % i for i in range(1400)]
    empty = [start for start in range(0, packed.stat().st_size, 1 << 16) if not any(
        8 * start <= first < 8 * (start + (1 << 16)) for first in {a[1] for a in decoded})]
    assert empty
    decoded.clear()
    with open(packed, "rb") as handle:
        for start in empty:
            assert list(splitting.decoded(handle, start, start + (1 << 16), packed.stat().st_size)) == []
    assert not decoded


def test_cut_files_fail(spark, tmp_path):
    text, _ = proteome(3, "tagged", genes=40)
    for name, packed in (("g.fa", gzip.compress(text.encode())), ("b.fa", bz2.compress(text.encode()))):
        (tmp_path / name).write_bytes(packed[:-20])
        with pytest.raises(Exception, match="before its end mark"):
            S.read_fasta(spark, str(tmp_path / name)).count()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=">\n\rAB", max_size=60), st.lists(st.integers(1, 9), min_size=1, max_size=60))
def test_every_record_is_in_one_range(text, steps):
    data = text.encode()
    expected = re.split(rb"\n>", b"\n" + data)[1:]
    cuts = [0]
    for step in steps:
        cuts.append(min(cuts[-1] + step, len(data)))
    cuts.append(len(data))
    got = []
    for low, high in zip(cuts, cuts[1:]):
        if low == high:
            continue
        own = [(data[i : i + 2], True) for i in range(low, high, 2)]
        own[-1] = (own[-1][0][: high - low - 2 * (len(own) - 1)], True)
        after = [(data[i : i + 3], False) for i in range(high, len(data), 3)]
        got += fasta_source.record_bodies(iter(own + after), low == 0)
    assert [g.rstrip(b"\n") for g in got] == [e.rstrip(b"\n") for e in expected]


def test_scan_details(spark, tmp_path, rows):
    crlf = put(tmp_path / "crlf.fa", "junk\r\n\r\n>A one\r\nMA\r\nSE\r\n>B two > x\r\nM M\r\n")
    assert rows(S.read_fasta(spark, crlf), "header", "sequence") == [("A one", "MASE"), ("B two > x", "MM")]
    assert S.read_fasta(spark, put(tmp_path / "empty.fa", "")).count() == 0
    blank = S.read_fasta(spark, put(tmp_path / "blank.fa", ">A\nM\n>\nM\n"))
    with pytest.raises(Exception, match="blank FASTA header"):
        A.longest_isoform(blank, on_duplicate="skip").collect()


def test_result_does_not_depend_on_splits(spark, tmp_path, rows):
    text = "".join(f">P{i} gene:G{i % 50}\n{'MK' * (1 + i * 7 % 90)}\n" for i in range(2000))
    path = put(tmp_path / "big.fa", text)
    whole = rows(A.longest_isoform(S.read_fasta(spark, path)), "header", "sequence")
    scan = S.read_fasta(spark, path, split_bytes=9000)
    assert scan.rdd.getNumPartitions() > 4
    assert rows(A.longest_isoform(scan), "header", "sequence") == whole
    assert scan.count() == 2000


def test_directory(spark, tmp_path, rows):
    d = tmp_path / "proteomes"
    d.mkdir()
    made = {name: proteome(seed, layout, genes=5) for name, seed, layout in (
        ("lynx.fa", 3, "tagged"), ("moose.FAA", 5, "bracketed"), ("otter.fasta.gz", 7, "tagged"), ("stoat.faa", 9, "tagged"))}
    for name, (text, _) in made.items():
        (d / name).write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
    put(d / "README.txt", "not a fasta file\n")
    found = [r["name"] for r in FS.fasta_inventory(spark, str(d)).collect()]
    assert found == sorted(made)
    cleaned = clean_directory(spark, str(d), str(tmp_path / "out"))
    kept = {name.split(".")[0]: longest(records) for name, (_, records) in made.items()}
    assert rows(cleaned.stats, "species", "output_records") == [(s, len(k)) for s, k in sorted(kept.items())]
    assert spark.read.json(str(tmp_path / "out" / "stats")).count() == 4
    written = S.read_fasta_sink(spark, str(tmp_path / "out" / "fasta"))
    assert rows(written, "species", "header", "sequence") == sorted((s, h, q) for s, k in kept.items() for h, q, _ in k)
    wrapped = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "out" / "fasta"))
    assert wrapped.where("length(value) > 60 and value not like '>%'").count() == 0
    put(d / "lynx.faa", made["lynx.fa"][0])
    with pytest.raises(DataError, match="lynx"):
        S.read_fasta_directory(spark, str(d))
    (tmp_path / "none").mkdir()
    put(tmp_path / "none" / "x.txt", "x")
    with pytest.raises(FileNotFoundError):
        S.read_fasta_directory(spark, str(tmp_path / "none"))


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows_ = spark.range(0, 4000, 1, 4).select(
        (F.col("id") % 3).cast("string").alias("file"),
        F.when(F.col("id") == 3999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="broken row"):
        S.write_lines(rows_.sortWithinPartitions("file"), str(tmp_path / "lines"))
    assert [p for p in (tmp_path / "lines").rglob("*") if p.is_file()] == []
    # one file by one task only
    with pytest.raises(Exception, match="several tasks"):
        S.write_lines(rows_.where("id < 3000").sortWithinPartitions("file"), str(tmp_path / "exact"), exact=True)
    assert [p for p in (tmp_path / "exact").rglob("*") if p.is_file()] == []
    good = rows_.where("id < 3000").sortWithinPartitions("file")
    S.write_lines(good, str(tmp_path / "lines"))
    names = {str(p.relative_to(tmp_path / "lines")) for p in (tmp_path / "lines").rglob("*") if p.is_file()}
    assert names == {"_SUCCESS", *[f"{f}/part-{k:05d}" for f in range(3) for k in range(3)]}
    assert spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "lines")).count() == 3000


def test_wrapping(spark):
    df = spark.createDataFrame([("h", "M" * 125)], "header string, sequence string")
    lines = df.select(S.fasta_text()).first()[0].split("\n")
    assert [len(x) for x in lines] == [2, 60, 60, 5]


def test_manifest_sizes_and_results(spark, tmp_path):
    import os

    p = put(tmp_path / "Species7.fa", ">a\nM\n")
    put(tmp_path / "Species12.fa", ">a\nMMMM\n")
    put(tmp_path / "SpeciesIDs.txt", "7: a\n")
    sizes = {r["id"]: r["size_bytes"] for r in FS.proteome_sizes(spark, str(tmp_path)).collect()}
    assert sizes == {7: 5, 12: 8}
    m = FS.file_manifest(spark, p).first()
    assert m["md5"] == hashlib.md5(b">a\nM\n").hexdigest()
    put(tmp_path / "long.fa", ">b\n" + "MK" * 5000)
    whole = (tmp_path / "long.fa").read_bytes()
    chunks = [hashlib.md5(whole[i : i + 999]).hexdigest() for i in range(0, len(whole), 999)]
    t = FS.tree_manifest(spark, str(tmp_path / "long.fa"), chunk_bytes=999).first()
    assert (t["tree_md5"], t["n_chunks"]) == (hashlib.md5("".join(chunks).encode()).hexdigest(), 11)
    heads = {r["name"]: r["head"] for r in FS.file_heads(spark, str(tmp_path)).collect()}
    assert heads["Species7.fa"] == b">a\nM\n".hex() and heads["long.fa"] == whole[:16].hex()
    root = tmp_path / "of"
    for name, when in (("Results_old", 1_000_000), ("Results_new", 2_000_000)):
        st = root / name / "Species_Tree"
        st.mkdir(parents=True)
        put(st / "t.txt", "(a,b);")
        os.utime(st / "t.txt", (when, when))
    assert FS.latest_results(spark, str(root)).endswith("/Results_new")
    deep = root / "Results_new" / "WorkingDirectory" / "inner" / "Results_final"
    deep.mkdir(parents=True)
    put(deep / "t.txt", "(a,b);")
    assert FS.latest_results(spark, str(root)).endswith("/Results_final")
    (tmp_path / "nothing").mkdir()
    put(tmp_path / "nothing" / "x", "x")
    with pytest.raises(DataError):
        FS.latest_results(spark, str(tmp_path / "nothing"))
