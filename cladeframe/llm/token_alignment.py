"""Alignment of the tokens of two tokenizers by diagonal run skipping.

Tokenizer A is a byte-level vocabulary, B one of word pieces with byte fallback that puts
a space before a text.  Offsets at which tokens of both end cut them into groups.

``align`` walks the two arrays of ends.  At the current shift between the indexes it
probes ever longer stretches for equal ends and jumps over what is one-to-one; at the
first difference it advances the side that is behind until the ends meet again, which
closes an irregular group and gives the next shift.

Neither vocabulary has a token over a single space between two words (``IRREGULAR`` lists
the texts of which this is not known; they are aligned as a whole).  So a text is a row of
pieces that both tokenizers end at, and a batch of texts is aligned over its distinct
pieces, whose groups are those of the texts.

What the corpus says of a pair of ids is counted block by block: a task gathers blocks of
some megabytes of text, of which it keeps the distinct pairs once and, for each document,
places among them.  Pairs are summed over blocks, and a block's documents meet the sums of
the block's pairs in one task of bounded size.  A pair that all documents have is one row
a block.

Defined results: a missing or empty text, and one whose tokens do not spell a space and
the text, has no tokens: zeros and an empty ``groups_sha256``.  Rows are judged one by
one, so a repeated or missing id gives a result each and counts as a document each; other
columns are not looked at; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.runtime import materialize

from .pieces import Known, batches, coded, flat, places, sums
from .text import whole

#: Bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: Distinct pieces a worker remembers; a matter of memory only.
REMEMBERED = 150_000
#: Links of a group from which on equal ids are put together before pairs are made.
LARGE_GROUP = 1 << 12
#: White space other than single spaces and line breaks inside, and the mark that B has
#: for a space.
IRREGULAR = (
    r"^[ \n]|[ \n][ \n]|[ \n]\z|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{2581}]"
)
#: How B writes a space (fixed value).
PIECE_SPACE = "▁"


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """For each group, the index after its last token in A and in B.  Both ascend and
    their last ends are equal."""
    i = j = 0
    stops_a: list[int] = []
    stops_b: list[int] = []
    while i < len(ends_a):
        if ends_a[i] == ends_b[j]:
            run, step = 1, 1
            while step and ends_a[i + run : i + run + step] == ends_b[j + run : j + run + step] and i + run + step <= len(ends_a):
                run, step = run + step, 2 * step
            while step := step // 2:
                if i + run + step <= len(ends_a) and ends_a[i + run : i + run + step] == ends_b[j + run : j + run + step]:
                    run += step
            stops_a.extend(range(i + 1, i + run + 1))
            stops_b.extend(range(j + 1, j + run + 1))
            i, j = i + run, j + run
            continue
        x, y = ends_a[i], ends_b[j]
        while x != y:
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        i, j = i + 1, j + 1
        stops_a.append(i)
        stops_b.append(j)
    return stops_a, stops_b


def links(
    ids_a: np.ndarray, ids_b: np.ndarray, many_a: np.ndarray, many_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of an A and a B token of one group as ``a << 32 | b``, how often each
    stands there, and the group it comes from."""
    product = many_a * many_b
    first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
    large = np.flatnonzero(product > LARGE_GROUP)
    size = product.copy()
    size[large] = 0
    group = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
    a = ids_a[first_a[group] + inside // many_b[group]].astype(np.int64)
    b = ids_b[first_b[group] + inside % many_b[group]].astype(np.int64)
    keys, times, owners = [a << 32 | b], [np.ones(len(group), np.int64)], [group]
    for g in large.tolist():
        a, n = np.unique(ids_a[first_a[g] : first_a[g] + many_a[g]], return_counts=True)
        b, m = np.unique(ids_b[first_b[g] : first_b[g] + many_b[g]], return_counts=True)
        keys.append((a.astype(np.int64)[:, None] << 32 | b.astype(np.int64)[None, :]).ravel())
        times.append((n[:, None] * m[None, :]).ravel())
        owners.append(np.full(len(a) * len(b), g))
    return np.concatenate(keys), np.concatenate(times), np.concatenate(owners)


class Pieces(NamedTuple):
    """Tokens and groups of distinct pieces, one after another."""

    a: np.ndarray  # ids
    b: np.ndarray
    n_a: np.ndarray  # tokens of each piece
    n_b: np.ndarray
    many_a: np.ndarray  # tokens of each group
    many_b: np.ndarray
    groups: np.ndarray  # groups of each piece


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones
    stand for themselves, the others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Aligner:
    """Two tokenizer files: A byte-level (tokenizers), B word pieces (sentencepiece)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_of()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # special tokens hold characters of their own; texts never get them
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.has_space = np.array([t[:1] == b" " for t in self.bytes_a])
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(PIECE_SPACE, " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.sizes_a = np.array(list(map(len, self.bytes_a)))
        self.sizes_b = np.array(list(map(len, self.bytes_b)))
        # ids as text, by what follows them in a group: another of the same side, the other
        # side, another group
        self.text_a = [np.array([f"{i}{c}" for i in range(len(self.bytes_a))], object) for c in ",|"]
        self.text_b = [np.array([f"{i}{c}" for i in range(len(self.bytes_b))], object) for c in ",;"]
        self.known = Known(self.learn, REMEMBERED)

    def _ids_a(self, words: list[str]) -> list[bytes]:
        """Ids of words after a space: in one call, as only first tokens hold a space."""
        ids = np.array(self.a.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        starts = 4 * np.flatnonzero(self.has_space[ids])
        if len(starts) != len(words):
            found = self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)
            return [array("i", e.ids).tobytes() for e in found]
        packed, starts = ids.tobytes(), starts.tolist()
        return [packed[i:j] for i, j in zip(starts, [*starts[1:], len(packed)])]

    def learn(self, pieces: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of pieces: a word after a space; ``\n`` and a word right after the word
        before; or, with a space in front, a whole text.  None for a piece that the tokens
        of either don't spell."""
        ids_a: dict[str, bytes] = {}
        words = [p for p in pieces if p[0] not in " \n"]
        for low in range(0, len(words), 2000):
            some = words[low : low + 2000]
            ids_a.update(zip(some, self._ids_a(some)))
        other = [p for p in pieces if p[0] in " \n"]
        found = self.a.encode_batch_fast([p if p[0] == " " else f" {p}" for p in other], add_special_tokens=False)
        ids_a.update((p, array("i", e.ids[p[0] == "\n" :]).tobytes()) for p, e in zip(other, found))
        lists = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        ids = [(ids_a[p], array("i", x[1:] if p[0] == "\n" else x).tobytes()) for p, x in zip(pieces, lists)]
        spelled = [(p if p[0] in " \n" else f" {p}").encode() for p in pieces]
        if self._spell(ids) == (b"".join(spelled),) * 2:
            return ids
        return [x if self._spell([x]) == (s, s) else None for s, x in zip(spelled, ids)]

    def _spell(self, ids: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
        a = np.frombuffer(b"".join([x for x, _ in ids]), np.int32).tolist()
        b = np.frombuffer(b"".join([x for _, x in ids]), np.int32).tolist()
        return b"".join(map(self.bytes_a.__getitem__, a)), b"".join(map(self.bytes_b.__getitem__, b))

    def align(self, ids: list[tuple[bytes, bytes]]) -> Pieces:
        """Align distinct pieces: in one array of ends, as each piece ends where both end."""
        a, n_a = flat([x for x, _ in ids], np.int32)
        b, n_b = flat([x for _, x in ids], np.int32)
        stops = align(np.cumsum(self.sizes_a[a]).tolist(), np.cumsum(self.sizes_b[b]).tolist())
        stop_a, stop_b = (np.array(s, np.int64) for s in stops)
        groups = np.diff(np.searchsorted(stop_a, np.cumsum(n_a), "right"), prepend=0)
        return Pieces(a, b, n_a, n_b, np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0), groups)

    def texts(self, pieces: Pieces) -> list[str]:
        """The groups of each piece as ``a1,a2|b1,b2;``."""
        stop_a, stop_b = np.cumsum(pieces.many_a), np.cumsum(pieces.many_b)
        # tokens in the order of their groups, those of A first
        at_a = np.arange(len(pieces.a)) + np.repeat(stop_b - pieces.many_b, pieces.many_a)
        at_b = np.arange(len(pieces.b)) + np.repeat(stop_a, pieces.many_b)
        out = np.empty(len(at_a) + len(at_b), object)
        out[at_a], out[at_b] = self.text_a[0][pieces.a], self.text_b[0][pieces.b]
        out[at_a[stop_a - 1]] = self.text_a[1][pieces.a[stop_a - 1]]
        out[at_b[stop_b - 1]] = self.text_b[1][pieces.b[stop_b - 1]]
        parts, ends = out.tolist(), np.cumsum(pieces.n_a + pieces.n_b).tolist()
        return ["".join(parts[i:j]) for i, j in zip([0, *ends], ends)]

    def cut(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[bytes, bytes]]]:
        """Codes of the pieces of all texts, where each text starts, and the ids of the
        distinct pieces; a text without tokens has no pieces."""
        odd = pc.match_substring_regex(column, IRREGULAR)
        lists = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        if pc.any(odd).as_py():
            one = pc.binary_join_element_wise(" ", column, "")
            offsets = pa.array(np.arange(len(column) + 1), pa.int32())
            lists = pc.if_else(odd, pa.ListArray.from_arrays(offsets, one), lists)
        codes, starts, distinct = coded(lists)
        found = self.known.of([d or " " for d in distinct])
        # an empty text is one empty piece, a text that is not spelled has a bad one
        bad = np.array([not d or f is None for d, f in zip(distinct, found)], bool)
        if bad.any():
            bad_text = sums(bad[codes].astype(np.int64), starts) > 0
            keep = np.repeat(~bad_text, np.diff(starts))
            starts = np.concatenate([[0], np.cumsum(np.where(bad_text, 0, np.diff(starts)))])
            codes = codes[keep]
            found = [(b"", b"") if b else f for b, f in zip(bad.tolist(), found)]
        return codes, starts, found


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, a_ids, b_ids, group_a, group_b`` of every document: its tokens, and how many
    of A and of B each group has."""

    def rows(given):
        aligner = _aligner(path_a, path_b)
        for whole_batch in given:
            for batch in batches(whole_batch, 1):
                codes, starts, found = aligner.cut(batch.column(1))
                p = aligner.align(found)
                out = [batch.column(0)]
                for values, sizes in ((p.a, p.n_a), (p.b, p.n_b), (p.many_a, p.groups), (p.many_b, p.groups)):
                    at, many = places(sizes, codes)
                    out.append(_lists(values[at], np.cumsum(sums(many, starts)), pa.int32()))
                yield pa.RecordBatch.from_arrays(out, names=["key", "a_ids", "b_ids", "group_a", "group_b"])

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    schema = f"key {kind}, a_ids array<int>, b_ids array<int>, group_a array<int>, group_b array<int>"
    return narrow.mapInArrow(rows, schema).withColumnRenamed("key", key)


def _block(aligner: Aligner, batch: pa.RecordBatch) -> list[pa.Array]:
    """Statistics of a block's documents; its last row holds the distinct pairs of the
    block and how many of its documents have each."""
    codes, starts, found = aligner.cut(batch.column(1))
    n = batch.num_rows
    p = aligner.align(found)
    table = np.stack([p.n_a, p.n_b, p.groups], axis=1)
    keys, times, group = links(p.a, p.b, p.many_a, p.many_b)
    # groups of many links come last: bring the pairs of a piece together
    piece = np.searchsorted(np.cumsum(p.groups), group, "right")
    order = np.argsort(piece, kind="stable")
    keys, times = keys[order], times[order]
    sizes = np.bincount(piece, minlength=len(found))
    pairs, place = np.unique(keys, return_inverse=True)
    at, many = places(sizes, codes)
    owner = np.repeat(np.repeat(np.arange(n), np.diff(starts)), many)
    combined = owner * max(1, len(pairs)) + place[at]
    order = np.argsort(combined, kind="stable")
    combined = combined[order]
    first = np.flatnonzero(np.diff(combined, prepend=-1))
    held = np.add.reduceat(times[at[order]], first) if len(first) else np.zeros(0, np.int64)
    doc, pair = np.divmod(combined[first], max(1, len(pairs)))
    ends = np.searchsorted(doc, np.arange(n), "right")
    n_links = sums(held, np.concatenate([[0], ends]))
    names, digests = list(map(aligner.texts(p).__getitem__, codes.tolist())), []
    for i, j in zip(starts.tolist(), starts[1:].tolist()):
        digests.append(hashlib.sha256("".join(names[i:j])[:-1].encode()).hexdigest() if j > i else "")
    last = np.concatenate([ends, ends[-1:]])
    whole_row = np.concatenate([np.zeros(n, np.int64), [len(pairs)]])
    out = [pa.concat_arrays([batch.column(0), pa.nulls(1, batch.column(0).type)])]
    for c in range(3):
        out.append(pa.array(np.append(sums(table[codes, c], starts), 0)))
    out += [
        pa.array(np.append(n_links, 0)), pa.array([*digests, None], pa.string()),
        _lists(pair, last, pa.int32()), _lists(held, last, pa.int64()),
        _lists(pairs, np.cumsum(whole_row), pa.int64()),
        _lists(np.bincount(pair, minlength=len(pairs)), np.cumsum(whole_row), pa.int64()),
    ]
    return out


BLOCKS = (
    "block long, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places array<int>, times array<long>, pairs array<long>, docs array<long>"
)


def blocks(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored blocks of aligned documents, a row for each and one more, without
    ``groups_sha256``, for the pairs of the block."""
    kind = docs.schema[key].dataType.simpleString()
    schema = BLOCKS.format(kind=kind)
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(given):
        aligner = _aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for whole_batch in given:
            for batch in batches(whole_batch, 1, BLOCK_BYTES):
                columns = _block(aligner, batch)
                block = pa.array(np.full(batch.num_rows + 1, number))
                number += 1
                yield pa.RecordBatch.from_arrays([block, *columns], names=names)

    narrow = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    return materialize(narrow.mapInArrow(rows, schema))


def pair_counts(stored: DataFrame) -> DataFrame:
    """``pair, n_docs, best`` of all linked ids: the documents that hold the pair, and
    whether no pair with the same A id is held by more."""
    held = stored.where("groups_sha256 IS NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counted = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n_docs"))
    # as many rows as B has ids, at most
    same_a = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", F.col("n_docs") == F.max("n_docs").over(same_a))


def alignment_statistics(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its tokens, groups, links and the digest of its groups, and, by the
    corpus-wide counts of its links, ``n_best`` and ``count_sum``."""
    stored = blocks(docs, path_a, path_b, key, text)
    kind = docs.schema[key].dataType.simpleString()
    scored = pair_counts(stored)
    each = stored.where("groups_sha256 IS NULL").select("block", F.posexplode("pairs").alias("place", "pair"))
    known = each.join(scored, "pair").select("block", "place", "n_docs", "best")
    rows = stored.where("groups_sha256 IS NOT NULL").drop("pairs", "docs").withColumn("of", F.col("block") + 0).drop("block")
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def sum_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n_docs, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right["place"].to_numpy()
        n_docs[at], best[at] = right["n_docs"].to_numpy(), right["best"].to_numpy().astype(np.int64)
        pair = pc.list_flatten(left["places"]).to_numpy()
        times = pc.list_flatten(left["times"]).to_numpy()
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(left["places"]).to_numpy())])
        left = left.append_column("n_best", pa.array(sums(times * best[pair], starts), pa.int64()))
        left = left.append_column("count_sum", pa.array(sums(times * n_docs[pair], starts), pa.int64()))
        return left.select(names)

    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    summed = rows.groupBy("of").cogroup(known.groupBy("block")).applyInArrow(sum_up, schema)
    return summed.withColumnRenamed("key", key)
