import pytest
from pyspark.sql import functions as F

from cladeframe.functions import headers as H
from cladeframe.functions import specs as X

TAGGED = "QX7 pep chromosome:v2:9 gene:WALNUT44.3 description:kinase"


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "h string").select(column).first()[0]


@pytest.mark.parametrize(
    "header, expected",
    [
        (TAGGED, "ensembl"),
        ("QX7 gene=WALNUT44", "ensembl"),
        ("YP_88 lysozyme, partial [Juglans regia]", "ncbi"),
        ("YP_88 [Juglans regia] trailing words", "ensembl"),
        ("QX7", "ensembl"),
        ("YP_88 gene:WALNUT45 lysozyme [Juglans]", "ensembl"),
    ],
)
def test_header_format(spark, header, expected):
    assert one(spark, header, H.header_format("h")) == expected


@pytest.mark.parametrize(
    "header, fmt, expected",
    [
        (TAGGED, "ensembl", "WALNUT44.3"),
        ("QX7 pep description:kinase", "ensembl", None),
        ("YP_90 expansin isoform X12 [Juglans regia]", "ncbi", "expansin [Juglans regia]"),
        ("YP_91 expansin [Juglans regia]", "ncbi", "YP_91 expansin [Juglans regia]"),
        (TAGGED, "auto", "WALNUT44.3"),
        ("YP_92 expansin isoform X3 [Juglans regia]", "auto", "expansin [Juglans regia]"),
    ],
)
def test_gene_id(spark, header, fmt, expected):
    assert one(spark, header, H.gene_id("h", fmt)) == expected


def test_unknown_format():
    with pytest.raises(ValueError, match="Unknown header format"):
        H.gene_id("h", "bogus")


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/a/Homo_sapiens.pep.all.fa.gz", "Homo_sapiens.pep.all"),
        ("x.fasta.bz2", "x"),
        ("dir.d/y.faa", "y"),
    ],
)
def test_species_from_path(spark, path, expected):
    assert one(spark, path, H.species_from_path("h")) == expected


def test_names(spark):
    assert one(spark, " a b-c ", H.sanitize_name("h")) == "a_b_c"
    assert one(spark, "   ", H.sanitize_name("h")) == "node"
    assert one(spark, "A.b_c-1", H.is_safe_species("h")) is True
    assert one(spark, "a:b", H.is_safe_species("h")) is False


@pytest.mark.parametrize(
    "text, expected",
    [
        ("94", (94.0, None, None, None)),
        (" 1e2 ", (100.0, None, None, None)),
        ("100-120", (None, 100.0, 120.0, None)),
        ("100-", (None, 100.0, None, None)),
        ("-120", (-120.0, None, None, "negative age")),
        ("-", (None, None, None, "unreadable age")),
        ("old", (None, None, None, "unreadable age")),
        ("a-5", (None, None, None, "unreadable age")),
    ],
)
def test_parse_age(spark, text, expected):
    assert tuple(one(spark, text, X.parse_age("h"))) == expected


def test_calibrations(spark, rows):
    df = spark.createDataFrame(
        [("hc a:human, cat:94",), ("root:human,dog:100-120",), ("x:human:1",), ("bad",)], "spec string"
    )
    got = {r["spec"]: r for r in X.parse_calibrations(df).collect()}
    hc = got["hc a:human, cat:94"]
    assert (hc["name"], hc["sp1"], hc["sp2"], hc["age"], hc["error"]) == ("hc_a", "human", "cat", 94.0, None)
    assert got["root:human,dog:100-120"]["max_age"] == 120.0
    assert got["x:human:1"]["error"] == "not two taxa"
    assert got["bad"]["error"].startswith("not NAME")
    pairs = spark.createDataFrame([("human,cat", "5-")], "pair string, age_spec string")
    r = X.pairs_to_calibrations(pairs).first()
    assert (r["name"], r["min_age"], r["max_age"]) == ("human_cat", 5.0, None)


def test_pair_cost_is_exact(spark):
    df = spark.createDataFrame([(104857601, 104857603)], "q long, d long")
    assert int(df.select(X.pair_cost("q", "d")).first()[0]) == 104857601 * 104857603
    big = spark.createDataFrame([(4 * 10**18, 4 * 10**18)], "q long, d long")
    assert int(big.select(X.pair_cost("q", "d")).first()[0]) == 16 * 10**36


def test_merge_labels_chain_in_order(spark):
    def merged(label):
        return one(spark, label, X.merge_labels(
            "h", [("Piscivore", "Carnivore")], [("Carnivore", "Piscivore")]))

    assert merged("Carnivore/Piscivore") == "Carnivore"
    assert merged("Piscivore") == "Carnivore"
    assert merged("Omnivore") == "Omnivore"
    df = spark.createDataFrame([(None,)], "h string")
    assert df.select(X.merge_labels("h", [("a", "b")], [("a", "b")])).first()[0] is None
    chained = X.merge_labels("h", [("a", "b"), ("b", "c")])
    assert one(spark, "a", chained) == "c"
    # a token is matched literally
    assert one(spark, "axb", X.merge_labels("h", (), [("a.b", "a")])) == "axb"
    assert one(spark, "k", F.col("h")) == "k"
