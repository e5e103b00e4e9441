"""Rows that are awkward for text operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n, words="the of and stone river walk light under seven green paper again over north"):
    draw = random.Random(seed)
    return " ".join(draw.choice(words.split()) + str(draw.randrange(50)) for _ in range(n))


def odd_rows():
    """Missing values, empty and very long texts, ties, repeated rows, copies."""
    base = prose(1, 300)
    near = " ".join(w if i % 100 else "other" for i, w in enumerate(base.split()))
    rows = [
        (0, base, "en", "a"), (1, base, "en", "a"), (2, near, None, "a"), (3, None, "en", "b"), (4, "", None, None),
        (5, " \t\n ", "de", None), (6, "One two", "de", "b"), (7, prose(2, 40_000), "en", "c"), (8, prose(3, 4), None, "c"),
        (9, prose(3, 4), "en", "c"), (9, prose(3, 4), "en", "c"), (None, prose(4, 60), "en", "c"), (None, None, None, None),
        (10, "Ünïcode süß 日本語 " * 40, "de", "ü"), (11, prose(5, 50) + "\n" + prose(5, 50) + "\n" + prose(5, 50), "en", "a"),
        (12, "same same same " * 30, "en", "a"), (13, prose(6, 90) + " " + prose(1, 120), "en", "b"), (14, "\x00\x01 a\x85b\u2003c", "en", "b"),
        (15, "don't <|endoftext|>  stop\n\n now  \t 12 3", "en", "b"),
    ]
    return [(*r, len(r[1] or "")) for r in rows]
