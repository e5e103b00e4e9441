"""Language identification by cross-parsing entropy.

Labelled text of each language goes into a suffix automaton.  A text is parsed greedily
into longest matches with each automaton, and the language needing the fewest phrases
per character wins.  A phrase never goes on over a word's start (the space before a word
belongs to it), so the phrases of a word are counted once per worker and language, and a
text's count is the sum over its words, whole texts of any length included.

Each language is learned from a bounded sample: at most ``SAMPLE`` documents chosen by the
hash of their id, each of which gives the same share of ``CHARS`` characters, a passage
that starts at a place drawn by the hash; a document shorter than its share is learned
whole.  Scored texts are parsed over their whole length.

Defined results: ``und`` with score 0 for a text that is missing or has no letter, and
for all texts when no language is known.  Ties go to the language first by code point.
A missing language is none.  Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.runtime import small_rows

#: Documents and characters that a language is learned from at most.
SAMPLE = 64
CHARS = 24_000
#: Cells of an automaton's table of all codes.
DENSE = 1 << 22
#: Languages that one model may hold.
MAX_LANGUAGES = 1000
#: Words a worker remembers before it starts anew; a matter of memory only.
REMEMBERED = 400_000
UNKNOWN = "und"


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


class Automaton:
    """The automaton of all substrings of a text: state 0 is the start, -1 no transition.

    Codes of characters are those of the text's own alphabet, from 1; 0 stands for all
    others.  Transitions are a sorted array of ``state * width + code``, so that memory
    grows with the text and not with the number of its characters times its alphabet;
    a table of all codes is kept besides where it is as small (``DENSE`` cells).
    """

    def __init__(self, text: str):
        self.symbols = {ch: i + 1 for i, ch in enumerate(sorted(set(text)))}
        self.width = len(self.symbols) + 1
        following: list[dict[int, int]] = [{}]
        length, link, last = [0], [-1], 0
        for ch in text:
            c = self.symbols[ch]
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            following.append({})
            p = last
            while p != -1 and c not in following[p]:
                following[p][c] = new
                p = link[p]
            if p != -1:
                q = following[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    following.append(dict(following[q]))
                    while p != -1 and following[p].get(c) == q:
                        following[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.states = len(following)
        steps = sorted((s * self.width + c, to) for s, out in enumerate(following) for c, to in out.items())
        self.keys = np.array([k for k, _ in steps], np.int64)
        self.to = np.array([t for _, t in steps], np.int32)
        self.table = None
        if self.states * self.width <= DENSE:
            self.table = np.full(self.states * self.width, -1, np.int32)
            self.table[self.keys] = self.to

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Where each state goes with each code."""
        key = state.astype(np.int64) * self.width + code
        if self.table is not None:
            return self.table[key]
        if not len(self.keys):
            return np.full(len(key), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], np.int32(-1))

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Codes of characters given as code points."""
        own = np.array([ord(ch) for ch in self.symbols], np.int64)
        if not len(own):
            return np.zeros(len(points), np.int64)
        at = np.minimum(np.searchsorted(own, points), len(own) - 1)
        return np.where(own[at] == points, at + 1, 0)


@dataclass
class Model:
    languages: list[str]
    automata: list[Automaton]

    def phrases(self, words: list[str]) -> np.ndarray:
        """Phrases of `` word`` for each word and language: greedy longest matches, a
        character that starts no match being a phrase of its own.

        Only letters are parsed.  All words advance together by one character; words
        that have ended drop out.
        """
        words = [letters(w) for w in words]
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        text = [" " + words[i] if words[i] else "" for i in order]
        sizes = np.array([len(t) for t in text], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        points = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.zeros((len(words), len(self.languages)), np.int32)
        for k, automaton in enumerate(self.automata):
            codes = automaton.codes(points)
            state = np.zeros(len(text), np.int32)
            count = np.zeros(len(text), np.int32)
            live = len(text)
            for i in range(int(sizes[0]) if len(sizes) else 0):
                live = int(np.searchsorted(-sizes[:live], -i, side="left"))
                c = codes[starts[:live] + i]
                s = state[:live]
                to = automaton.step(s, c)
                ended = to < 0
                if ended.any():
                    count[:live] += ended & (s > 0)
                    again = automaton.step(np.zeros(live, np.int32), c)
                    count[:live] += ended & (again < 0)
                    to = np.where(ended, np.maximum(again, 0), to)
                state[:live] = to
            out[order, k] = count + (state > 0)
        return out


class Identifier:
    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.counts = np.zeros((0, len(model.languages)), np.int32)

    def learn(self, words: list[str]) -> None:
        base = len(self.place)
        self.place.update(zip(words, range(base, base + len(words))))
        rows = [self.model.phrases(words[i : i + 50_000]) for i in range(0, len(words), 50_000)]
        self.counts = np.concatenate([self.counts, *rows])

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.place) > REMEMBERED:
            self.place, self.counts = {}, self.counts[:0]
        parsed = [t.lower().split() if t and self.model.languages else [] for t in texts]
        new = set().union(*parsed).difference(self.place)
        if new:
            self.learn(list(new))
        names, scores = [], []
        get = self.place.__getitem__
        for text, words in zip(texts, parsed):
            if not words or not any(map(str.isalpha, text)):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.counts[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0, dtype=np.int64)
            best = int(total.argmin())
            second = int(np.partition(total, 1)[1]) if len(total) > 1 else 0
            names.append(self.model.languages[best])
            scores.append(1.0 - int(total[best]) / second if second else 1.0)
        return names, scores


def build(texts: dict[str, list[str]]) -> Model:
    """Automata of the texts of each language."""
    languages = sorted(texts)
    bodies = ["".join([" " + w for t in texts[x] for w in map(letters, t.lower().split()) if w]) for x in languages]
    return Model(languages, [Automaton(b) for b in bodies])


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    learn: Column | None = None, sample: int = SAMPLE, chars: int = CHARS,
) -> Model:
    """A model of the languages of ``docs``; ``learn`` is a condition on the key for rows
    that may be learned from."""
    allowed = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    known = docs.where(allowed & F.col(lang).isNotNull() & (F.length(text) > 0))
    draw = F.xxhash64(F.col(key).cast("string"))
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    counted = known.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = small_rows(counted, "languages", MAX_LANGUAGES)
    if not sizes:
        return Model([], [])
    limit = F.lit(None).cast("double")
    for r in sizes:  # the hash below which about ``sample`` rows of the language lie
        part = min(1.0, sample / r["n"])
        limit = F.when(F.col("lang") == r["lang"], F.lit((2 * part - 1) * 2.0**63)).otherwise(limit)
    drawn = known.where(F.col("draw").cast("double") <= limit)
    # every drawn document gives its share of the characters, from any place in it
    share = max(1, chars // sample)
    start = F.pmod(F.xxhash64("draw"), F.greatest(F.length("text") - share, F.lit(0)) + 1)
    drawn = drawn.select("lang", "draw", F.substring("text", (start + 1).cast("int"), F.lit(share)).alias("text"))
    order = Window.partitionBy("lang").orderBy("draw", "text")
    drawn = drawn.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample)
    rows = drawn.orderBy("lang", "nth").collect()  # sample texts of a share of characters per language
    texts: dict[str, list[str]] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append(r["text"])
    return build(texts)


def identify(text: Column, model: Model) -> Column:
    """``struct<lang_pred string, score double>`` of every whole text."""

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Identifier(model)
        for texts in batches:
            names, scores = known.identify(texts.to_list())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return F.pandas_udf(judge, "lang_pred string, score double")(text)
