"""A corpus pipeline of five stages over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that the next one
gets, with the columns of ``documents``; the last returns the index of the token files.

Defined results, for every stage: other columns are passed on and their names matter
nothing; rows are told apart as rows, so that a missing or repeated id is no reason to
drop or merge any; an empty table gives an empty one; texts are taken whole, however long.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import decontaminate, jaccard_join, mixing, subword_quality, token_files
from cladeframe.llm.catalog import remainder
from cladeframe.runtime import drop_tables, materialize, stored_tables

#: Documents scored lower go.
QUALITY = 0.7

#: Tables that the stage before has stored on its way.
_left: list[str] = []


def tidy(stage):
    """A stage that first deletes what the stage before it has left in the shared folder:
    its result is written when the next one starts."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _left)
        with stored_tables() as made:
            out = stage(spark, docs, sf_dir)
        _left.extend(made)
        return out

    return run_stage


@tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.  A missing or empty text has a score like any
    other; equal texts have equal scores.  Without labels all scores are 0.5: none stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = subword_quality.fit(docs, labels, learn=remainder("doc_id", 4) != 2)
    return docs.where(subword_quality.score(F.col("text"), model) >= QUALITY)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: a row with its smallest id, any one of
    them where several rows have it or none has an id.  Documents without words are in
    no group and stay."""
    return jaccard_join.keep_one(docs)


@tidy
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too much of the benchmark in them.  A missing or empty text has no
    words and stays; equal texts stay or go together."""
    return decontaminate.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the curriculum takes them.  A missing text
    has size 0, a missing source is a source; ties are settled by row, so repeated rows are
    taken one by one."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token files written from the documents, in the order of ids, a
    missing one first.  A missing or empty text has the end id only."""
    import public_tokenizers

    drop_tables(spark, _left)  # its own stay: they hold the result
    return token_files.encode_and_index(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID output", tokens),
]

#: The classifier is learned and the tokenizer is a library: no SQL says the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
