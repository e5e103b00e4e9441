"""Quality classifier on learned subword embeddings.

A text is the average of its words' vectors, a word the average of learned vectors of
itself and of its character n-grams, all hashed into ``BUCKETS`` rows.  A softmax over
two classes is trained on them by stochastic gradient descent in numpy, on a bounded
sample of labelled texts (``SAMPLE`` whole documents, chosen by the hash of their id).

Words are joined by two marks, which stand for word n-grams that no hashing of words can
see as one thing: a word that repeats the word before it, and a word in a line that
repeats an earlier line.

As the model is linear after averaging, scoring needs one number per word, kept by each
worker for the words it has met; a text's score is exact and over its whole length.

Defined results: a missing or empty text has the end mark only and gets its score; with
no labelled text, or labels of one kind, all scores are 0.5.  A label that is null is no
label, repeated labels count as often as they stand, of rows with equal ids the smallest
text is learned.  Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import whole

#: Labelled documents that are learned at most.
SAMPLE = 4000
BUCKETS = 1 << 18
DIM = 8
EPOCHS = 4
RATE = 0.5
GRAMS = (3, 4, 5)
#: Words a worker remembers before it starts anew, and texts it cuts into words at once;
#: matters of memory only.
REMEMBERED = 100_000
SLICE = 128
#: Marks, which hold no word's characters.
AGAIN, LINE_AGAIN, END = "\x02", "\x03", "\x04"


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after another, and how many each word has: its own and
    those of the character n-grams of ``<word>``."""
    own = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    text = "".join([f"<{w}>" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    end_of = np.repeat(ends, sizes)
    word_of = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes))
    buckets, owners = [own * np.uint64(0x9E3779B97F4A7C15)], [np.arange(len(words))]
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        tail = np.zeros(len(codes), np.uint64)
        tail[: len(codes) - n + 1] = codes[n - 1 :] if len(codes) >= n else 0
        rolled = (rolled + tail + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
        if n in GRAMS:
            inside = place + n <= end_of
            mixed = rolled[inside] ^ (rolled[inside] >> np.uint64(29))
            buckets.append(mixed * np.uint64(0xBF58476D1CE4E5B9))
            owners.append(word_of[inside])
    owner = np.concatenate(owners)
    by_word = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(buckets)[by_word] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    return bucket, np.bincount(owner, minlength=len(words))


def marked(text: str | None) -> tuple[list[str], int, int]:
    """Words of a text; how many repeat the word before; how many stand in a line that
    repeats an earlier one."""
    text = text or ""
    words = text.split()
    again = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    line_again = 0
    if len(set(lines)) < len(lines):
        seen: set[str] = set()
        for x in lines:
            if x in seen:
                line_again += len(x.split())
            seen.add(x)
    return words, again, line_again


@dataclass
class Model:
    """The log odds each bucket adds to a word that has it."""

    odds: np.ndarray

    def of_words(self, words: list[str]) -> np.ndarray:
        bucket, sizes = word_features(words)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self.odds[bucket], starts) / sizes


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.marks = dict(zip((AGAIN, LINE_AGAIN, END), model.of_words([AGAIN, LINE_AGAIN, END]).tolist()))

    def score(self, texts: list[str | None]) -> list[float]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        parts = [marked(t) for t in texts]
        new = list(set().union(*[p[0] for p in parts]).difference(self.known))
        for low in range(0, len(new), 20_000):
            some = new[low : low + 20_000]
            self.known.update(zip(some, self.model.of_words(some).tolist()))
        get, m, out = self.known.__getitem__, self.marks, []
        for words, again, line_again in parts:
            odds = sum(map(get, words)) + again * m[AGAIN] + line_again * m[LINE_AGAIN] + m[END]
            out.append(odds / (len(words) + again + line_again + 1))
        return (1 / (1 + np.exp(-np.clip(out, -50, 50)))).tolist()


def document(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the weight of each in its average."""
    words, again, line_again = marked(text)
    counts = Counter(words)
    counts.update({mark: n for mark, n in ((AGAIN, again), (LINE_AGAIN, line_again), (END, 1)) if n})
    bucket, sizes = word_features(list(counts))
    share = np.array(list(counts.values()), np.float64)
    used, back = np.unique(bucket, return_inverse=True)
    weight = np.bincount(back, np.repeat(share / share.sum() / sizes, sizes))
    return used.astype(np.int32), weight.astype(np.float32)


def train(texts: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Fit the vectors on ``(buckets, weights, label)`` of each text."""
    if len({y for _, _, y in texts}) < 2:
        return Model(np.zeros(BUCKETS, np.float32))
    random = np.random.default_rng(seed)
    vectors = random.random((BUCKETS, DIM), np.float32) * np.float32(2 / DIM) - np.float32(1 / DIM)
    top = np.zeros((DIM, 2), np.float32)
    steps, done = EPOCHS * len(texts), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(texts)):
            used, share, y = texts[k]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = share @ vectors[used]
            z = hidden @ top
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            grad = top @ p
            top -= rate * np.outer(hidden, p)
            # a bucket's step does not shrink with the length of the text
            vectors[used] -= (rate * len(used) ** 0.5) * share[:, None] * grad
    return Model((vectors @ (top[:, 1] - top[:, 0])).astype(np.float32))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", learn: Column | None = None, sample: int = SAMPLE,
) -> Model:
    """A model of ``label`` (1 or 0) learned from at most ``sample`` labelled documents;
    ``learn`` is a condition on the key for rows that may be learned from."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    allowed = F.lit(True) if learn is None else learn
    known = known.where(F.col("label").isin(0, 1) & F.col("key").isNotNull() & F.coalesce(allowed, F.lit(False)))
    chosen = known.orderBy(F.xxhash64("key"), "key", "label").limit(sample)
    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text")).join(chosen, "key")
    rows = rows.groupBy("key", "label").agg(F.min("text").alias("text"))

    def features(batches):
        for d in batches:
            found = [document(t) for t in d["text"]]
            yield pd.DataFrame({
                "key": d["key"].astype(str), "label": d["label"],
                "used": [u.tobytes() for u, _ in found], "share": [w.tobytes() for _, w in found],
            })

    got = rows.mapInPandas(features, "key string, label int, used binary, share binary")
    # at most ``sample`` documents, as the weights of their distinct buckets; packed one after
    # another, so that the driver has its memory back when they are learned
    order, used, share, at = [], bytearray(), bytearray(), 0
    for r in got.toLocalIterator():
        used += r["used"]
        share += r["share"]
        order.append((r["key"], r["label"], at, len(used) // 4))
        at = len(used) // 4
    order.sort()
    buckets, weights = np.frombuffer(used, np.int32), np.frombuffer(share, np.float32)
    return train([(buckets[low:high], weights[low:high], y) for _, y, low, high in order])


def score(text: Column, model: Model) -> Column:
    """The probability of label 1, for every whole text."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            # the words of few texts are held at once, however many rows Arrow brings
            parts = [scorer.score(texts.iloc[i : i + SLICE].to_list()) for i in range(0, len(texts), SLICE)]
            yield pd.Series([s for part in parts for s in part], dtype="float64")

    return F.pandas_udf(scored, "double")(text)
