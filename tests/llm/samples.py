"""Small odd inputs that every operator's tests share, and plain-Python helpers to compare with."""

import random
import re

SPACES = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(SPACES, lower(text or ""))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices(["th", "er", "on", "an", "re", "é", "st", "en"], k=r.randint(1, 4))) for _ in range(n))


BASE = prose(1, 120)
NEAR = BASE.replace(BASE.split(" ")[60], "changed", 1)

#: (doc_id, text): nulls, empty and blank texts, ties, repeated rows and ids, copies, near copies, long texts, odd characters.
DOCS = [
    (1, BASE),
    (2, BASE),
    (3, NEAR),
    (3, NEAR),
    (4, prose(2, 200)),
    (4, prose(3, 50)),
    (None, prose(4, 40)),
    (None, None),
    (5, None),
    (6, ""),
    (7, " \t\n\r "),
    (8, "one two three"),
    (9, "One  TWO\tthree"),
    (10, "a b c d e"),
    (11, prose(5, 6000)),
    (12, "w " * 400),
    (13, "Same line here.\n" * 30),
    (14, "### $$$ %%% &&& *** ||| <<< >>> ### $$$ %%% &&&"),
    (15, "漢字 テスト 😀 naïve Ünï ÉCOLE don't <|endoftext|> x <|im_end|>"),
    (16, "Released under the MIT License.\n" + prose(6, 30)),
    (17, "\x85  mixed​spaces \x0b\x0c end"),
]

#: Columns that a caller may have and that the operators use as names of their own.
CLASHES = ["_id", "_key", "_row", "_text", "fp", "n", "key", "score", "value", "_score", "kept"]


def frame(spark, rows=DOCS):
    """The rows as a documents table with extra columns whose names clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), *["x"] * len(CLASHES)) for i, t in rows], schema).repartition(3)


def empty(spark):
    return frame(spark, DOCS[:1]).limit(0)
