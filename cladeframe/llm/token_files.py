"""Token ids in ORC files.

Texts are range-sorted by document id, encoded, and written as ORC: ids as integer
arrays in run-length encoded streams, row indexes every ``STRIDE`` rows, Bloom filters
on the document id.  A reader takes stripes in parallel and skips those, and the row
groups, whose metadata rule out the ids it asks for.

Encoding meets the same words again and again.  A text is cut at single spaces and line
breaks, where the byte-level tokenizer begins a new piece anyway, and every distinct
piece is encoded by the tokenizer once per worker; texts with other white space are
encoded whole.

Defined results: a missing text is empty and gets the end id only; a missing document
id sorts first; rows with equal ids follow one another, in the order of their texts' crc32,
and ``start`` counts the ids that stand before a row in the files.
An empty table gives a folder without rows.
"""

from __future__ import annotations

import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeframe.runtime import checkpoint_root, materialize

from .pieces import LONG, batches, flat, places
from .text import whole

STRIDE = 1000
STRIPE_BYTES = 64 << 20
#: The column that tells where in its file a row stands.
ROW = "row_in_file"
#: Bytes of text encoded at once.
BATCH_BYTES = 4 << 20
#: Distinct pieces a worker remembers before it forgets those that did not come again; a
#: matter of memory only.
REMEMBERED = 500_000
#: White space other than single spaces and line breaks, or the start of a special token.
IRREGULAR = (
    r"[ \n][ \n]|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|<\|"
)


#: A space as byte-level vocabularies write it (fixed value).
SPACE = "\u0120"


class Encoder:
    """A tokenizer file with the ids of the pieces it has met, as bytes of int32."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.line_break = self.ids("\n")
        vocabulary = self.tokenizer.get_vocab()
        self.has_space = np.zeros(max(vocabulary.values()) + 1, bool)
        self.has_space[[i for token, i in vocabulary.items() if token[:1] == SPACE]] = True
        # the pieces met lately, their ids one after another, and how many each has
        self.pieces = pa.array([], pa.string())
        self.piece_ids, self.sizes, self.long = np.zeros(0, np.int32), np.zeros(0, np.int64), False

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32).tobytes()

    def _all(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def together(self, pieces: list[str]) -> list[bytes]:
        """Encode pieces in one call: line breaks between them are tokens of their own."""
        if not pieces:
            return []
        ids = self._all("\n".join(pieces))
        ends = 4 * np.append(np.flatnonzero(ids == np.frombuffer(self.line_break, np.int32)[0]), len(ids))
        packed, ends = ids.tobytes(), ends.tolist()
        return [packed[low:end] for low, end in zip([0, *[e + 4 for e in ends]], ends)]

    def after_spaces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode pieces, each with a space before it, in one call: only the first id of
        a piece holds a space.  Their ids one after another, and how many each has."""
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ids = self._all(" " + " ".join(pieces))
        starts = np.flatnonzero(self.has_space[ids])
        if len(starts) != len(pieces):
            return flat([self.ids(f" {p}") for p in pieces], np.int32)
        return ids, np.diff(starts, append=len(ids))

    def others(self, pieces: list[str]) -> list[bytes]:
        """Encode pieces that are no words after a space."""
        bare = list({p.lstrip("\n") for p in pieces if p[:1] == "\n"} - {""})
        ids = dict(zip(bare, self.together(bare)), **{"": b""})
        found = []
        for p in pieces:
            if p[:1] == "\n":
                start = b"" if p[:2] == "\n\n" else self.line_break
                found.append(start + ids[p.lstrip("\n")])
            else:  # an empty one is a space at the end of the text
                found.append(self.ids(p[1:] if p else " "))
        return found

    def learn(self, new: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Encode pieces: a word stands for itself after a space, ``\n`` and a word for
        itself after a line break, ``\n\n`` and a word for the start of a text, a space
        and a text for a whole text."""
        other = np.asarray(pc.match_substring_regex(new, r"\A(?:[\n ]|\z)")).astype(bool)
        words, rest = np.flatnonzero(~other), np.flatnonzero(other)
        word_ids, word_sizes = self.after_spaces(new.take(pa.array(words)).to_pylist())
        rest_ids, rest_sizes = flat(self.others(new.take(pa.array(rest)).to_pylist()), np.int32)
        ids, sizes = np.concatenate([word_ids, rest_ids]), np.concatenate([word_sizes, rest_sizes])
        back = np.empty(len(new), np.int64)
        back[np.concatenate([words, rest])] = np.arange(len(new))
        at, _ = places(sizes, back)
        return ids[at], sizes[back]

    def codes(self, pieces: pa.StringArray) -> np.ndarray:
        """The place of each piece among those known, which the new ones join."""
        if self.long or len(self.pieces) > REMEMBERED:
            # whole texts and other long pieces hardly come again; of many, those stay that do
            keep = pc.less_equal(pc.utf8_length(self.pieces), LONG)
            if len(self.pieces) > REMEMBERED:
                keep = pc.and_(keep, pc.is_in(self.pieces, pieces))
            kept = np.flatnonzero(np.asarray(keep))
            at, self.sizes = places(self.sizes, kept)
            self.pieces, self.piece_ids, self.long = self.pieces.take(pa.array(kept)), self.piece_ids[at], False
        codes = pc.index_in(pieces, self.pieces)
        if codes.null_count:
            unknown = np.asarray(pc.is_null(codes))
            new = pieces.filter(pa.array(unknown)).dictionary_encode()
            ids, sizes = self.learn(new.dictionary)
            codes = np.asarray(codes.fill_null(0)).astype(np.int64)
            codes[unknown] = np.asarray(new.indices).astype(np.int64) + len(self.pieces)
            self.pieces = pa.concat_arrays([self.pieces, new.dictionary.cast(pa.string())])
            self.piece_ids, self.sizes = np.concatenate([self.piece_ids, ids]), np.concatenate([self.sizes, sizes])
            self.long = pc.max(pc.utf8_length(new.dictionary)).as_py() > LONG
        return np.asarray(codes).astype(np.int64)

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all whole texts one after another, ``end_id`` after each, and where each
        starts."""
        odd = pc.match_substring_regex(column, IRREGULAR)
        lines = pc.binary_join_element_wise("\n\n", pc.replace_substring(column, "\n", " \n"), "")
        lists = pc.split_pattern(lines, " ")
        if pc.any(odd).as_py():
            offsets = pa.array(np.arange(len(column) + 1), pa.int32())
            one = pa.ListArray.from_arrays(offsets, pc.binary_join_element_wise(" ", column, ""))
            lists = pc.if_else(odd, one, lists)
        starts = np.asarray(lists.offsets).astype(np.int64)
        codes = self.codes(lists.values.slice(starts[0], starts[-1] - starts[0]))
        starts -= starts[0]
        ids, sizes = np.append(self.piece_ids, np.int32(end_id)), np.append(self.sizes, 1)
        at, many = places(sizes, np.insert(codes, starts[1:], len(self.sizes)))
        ends = np.concatenate([[0], np.cumsum(many)])
        return ids[at], ends[starts + np.arange(len(starts))]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
    end_id: int = 0, name: str = "key",
) -> None:
    """Encode every whole text and write ``key, ids`` as ORC, in ascending key order
    over the files and inside them.  ``tokenizer`` is a tokenizer file that every
    executor has; ``end_id`` is appended to each document."""

    def encode(rows):
        encoder, row = _encoder(tokenizer), 0
        for whole_batch in rows:
            for part in batches(whole_batch, 1, BATCH_BYTES):
                ids, starts = encoder.encode(part.column(1), end_id)
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                places_ = pa.array(np.arange(row, row + part.num_rows))
                row += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), lists, places_], names=["key", "ids", ROW])

    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    # equal keys are spread by text; rows equal in both may be split anywhere
    ranged = rows.repartitionByRange(F.col("key").asc_nulls_first(), F.crc32("text"), F.monotonically_increasing_id())
    ranged = ranged.sortWithinPartitions(F.col("key").asc_nulls_first(), F.crc32("text"))
    kind = docs.schema[key].dataType.simpleString()
    encoded = ranged.mapInArrow(encode, f"key {kind}, ids array<int>, {ROW} long")
    (
        encoded.withColumnRenamed("key", name)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", STRIDE)
        .option("orc.bloom.filter.columns", name)
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, keys: list[int] | None = None, name: str = "key") -> DataFrame:
    """The stored ``key, ids``; with ``keys``, only those documents, other stripes and
    row groups being skipped by their metadata."""
    stored = spark.read.orc(path).drop(ROW)
    return stored if keys is None else stored.where(F.col(name).isin(keys))


def index_tokens(spark: SparkSession, path: str, name: str = "key") -> DataFrame:
    """Per stored document: ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers).

    Files hold ranges of keys: running sums inside a file are added to the sums of the
    files before it, one row per file.
    """
    stored = spark.read.orc(path)
    kind = stored.schema[name].dataType.simpleString()

    def digest(batches):
        for b in batches:
            lists = b.column(1)
            ids = np.asarray(lists.flatten()).astype("<u4", copy=False)
            ends = np.cumsum(np.asarray(lists.value_lengths()).astype(np.int64))
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            crc = [zlib.crc32(ids[i:j].tobytes()) for i, j in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ends - starts), pa.array(crc, pa.int64()), b.column(2), b.column(3)],
                names=["key", "n_tokens", "ids_crc32", ROW, "file"],
            )

    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    rows = materialize(stored.select(F.col(name).alias("key"), "ids", ROW, file.alias("file")).mapInArrow(
        digest, f"key {kind}, n_tokens long, ids_crc32 long, {ROW} long, file string"
    ))
    files = rows.groupBy("file").agg(
        F.sum("n_tokens").alias("held"), F.min(F.struct(F.col("key").isNotNull(), "key")).alias("low")
    )
    before = Window.orderBy("low", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("file").orderBy(ROW)
    inside = F.sum("n_tokens").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return rows.withColumn("inside", inside).join(files, "file").select(
        F.col("key").alias(name), (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_and_index(docs: DataFrame, tokenizer: str, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files of ``docs`` (under the shared checkpoint folder when no
    path is given) and return their index."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_root(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, key, text, name=key)
    return index_tokens(spark, path, key)
