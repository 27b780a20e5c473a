"""Spelling variants by a dictionary of trie-node pairs (operator 13).

Which words differ by exactly one inserted, deleted or replaced code point, and which frequent word is each one's form?

1. Words. Letter runs are counted per document and batch before the shuffle; the words with enough occurrences are
   numbered in code-point order.
2. Trie nodes. Word w has the forward nodes w[:0] ... w[:L] (prefixes) and the reversed nodes w[L:] ... w[0:] (suffixes).
   A node's number follows from its parent's, ``number * base + code point`` modulo 2^61 - 1, so that all tasks number
   the tries alike without meeting, in time linear in the word. A second numbering with other bases goes along as a check:
   two different places of the dictionary agree in all numbers with a probability below 10^-30.
3. Pairs. A word enters its pair (prefix node, suffix node) for every skipped position (w[:i], w[i+1:]) and for every
   split (w[:i], w[i:]). Two words that meet in a skipped pair are a replacement apart; a skipped pair that meets a split
   pair is a deletion (the split word is the other without that letter). In a run of equal letters only the first may be
   skipped for a deletion, so each pair of words meets exactly once, and counts need no distinct.
4. A pair holds one split word at most, and one skipped word per letter of the alphabet (90), so the lists that meet are
   bounded whatever the corpus.
5. A word's form is its most frequent neighbour (ties: the smallest) if that one is ``ratio`` times as frequent. Along
   forms the frequency grows by that factor, so doubling the pointers ends after a few joins.

Nulls and empty texts have no words; a null id counts as the empty text in the hash. Repeated rows count each time.
Texts and runs of any length are read whole (a run of L letters makes 2L + 1 pairs). An empty table, or one without words,
gives no rows. Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.tables import as_docs, cut

#: Different words that a task holds before it sends their counts on.
FLUSH_WORDS = 400_000

_P = (1 << 61) - 1
#: Bases of the two numberings, each forward and reversed.
_BASES = (1_000_003_000_017, 777_767_777_011, 1_152_921_504_606_000_001, 998_244_353_987_654_321)


def _counter(least: int, every: int):
    runs_of = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall

    def batch(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    def run(batches):
        held: Counter = Counter()
        for rows in batches:
            for key, text in zip(rows.column(0), rows.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{key.as_py() or ''}:".encode())
                # bytes.lower() changes A-Z only
                for word, times in Counter(runs_of(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    held[word] += times
            if len(held) >= FLUSH_WORDS:
                yield batch(held)
                held.clear()
        if held:
            yield batch(held)

    return run


def word_counts(docs: DataFrame, least: int, occurrences: int, every: int) -> DataFrame:
    """(wid, word, n): the words with ``occurrences`` or more, numbered in code-point order."""
    rows = docs.select(F.col("_id").cast("string").alias("_id"), "_text")
    counts = rows.mapInArrow(_counter(least, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ordered = cut(counts.filter(F.col("n") >= occurrences)).sort("word")
    return cut(ordered.select(F.monotonically_increasing_id().alias("wid"), "word", "n"))


def node_numbers(word: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """Forward nodes 0..L and reversed nodes 0..L (of the suffix from there on), in both numberings."""
    out = []
    for k, base in enumerate(_BASES):
        at, path = 1, [1]
        for c in map(ord, word if k % 2 == 0 else reversed(word)):
            at = (at * base + c) % _P
            path.append(at)
        out.append(path if k % 2 == 0 else path[::-1])
    return tuple(out)


def _pairs(batches):
    for rows in batches:
        a, b, check, wid, n, split, first = [], [], [], [], [], [], []
        for i, w, times in zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True):
            f, r, f2, r2 = node_numbers(w)
            size = len(w)
            a += f[:size] + f
            b += r[1:] + r
            check += [(x * 3 + y) % _P for x, y in zip(f2[:size] + f2, r2[1:] + r2, strict=True)]
            split += [False] * size + [True] * (size + 1)
            first += [k == 0 or w[k] != w[k - 1] for k in range(size)] + [False] * (size + 1)
            wid += [i] * (2 * size + 1)
            n += [times] * (2 * size + 1)
            if len(a) >= 100_000:
                yield _pair_batch(a, b, check, wid, n, split, first)
                a, b, check, wid, n, split, first = [], [], [], [], [], [], []
        if a:
            yield _pair_batch(a, b, check, wid, n, split, first)


def _pair_batch(a, b, check, wid, n, split, first) -> pa.RecordBatch:
    longs = [pa.array(x, pa.int64()) for x in (a, b, check, wid, n)]
    return pa.RecordBatch.from_arrays([*longs, pa.array(split), pa.array(first)], ["a", "b", "c", "wid", "n", "split", "first"])


def node_pairs(words: DataFrame) -> DataFrame:
    """The pair dictionary: one row per word and skipped or split position. ``first``: may be skipped for a deletion."""
    return words.select("wid", "word", "n").mapInArrow(_pairs, "a long, b long, c long, wid long, n long, split boolean, first boolean")


def neighbours(words: DataFrame) -> DataFrame:
    """(wid, n_near, best_n, best): how many words are near, and the most frequent one (ties: the smallest)."""
    met = node_pairs(words).groupBy("a", "b", "c").agg(F.collect_list(F.struct("wid", "n", "split", "first")).alias("m"))
    met = met.filter(F.size("m") > 1).select("m", F.explode("m").alias("x"))
    x = F.col("x")
    near = F.filter(
        "m",
        lambda y: F.when(x["split"], y["first"]).when(y["split"], x["first"]).otherwise(y["wid"] != x["wid"]),
    )
    one = met.select(x["wid"].alias("wid"), near.alias("near")).filter(F.size("near") > 0)
    best = F.array_max(F.transform("near", lambda y: F.struct(y["n"].alias("n"), (-y["wid"]).alias("w"))))
    one = one.select("wid", F.size("near").alias("k"), best.alias("best"))
    per = one.groupBy("wid").agg(F.sum("k").cast("long").alias("n_near"), F.max("best").alias("best"))
    return per.select("wid", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.w")).alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(wid, root): where the forms (wid, to) of every word that has one end."""
    pointer = cut(forms)
    while True:
        there = pointer.select(F.col("wid").alias("to"), F.col("to").alias("further"))
        after = cut(pointer.join(there, "to", "left").select("wid", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        pointer = after.select("wid", "to")
        if not after.filter("moved").head(1):
            return pointer.withColumnRenamed("to", "root")


def spelling_variants(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 7,
    occurrences: int = 2,
    ratio: int = 10,
    every: int = 31,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of ``least`` code points and ``occurrences`` or more.

    In the document with id d, a run whose crc32 of ``d:run`` is divisible by ``every`` loses the letter at crc32 modulo
    its length (the planted misspellings). See the module's text for the method and for odd input.
    """
    words = word_counts(as_docs(df, id_col, text_col), least, occurrences, every)
    near = cut(words.select("wid", "n").join(neighbours(words), "wid", "left"))
    has = F.col("best_n") >= ratio * F.col("n")
    forms = near.filter(has).select("wid", F.col("best").alias("to"))
    name = lambda c: words.select(F.col("wid").alias(c), F.col("word").alias(f"{c}_word"))
    named = forms.join(last_forms(forms), "wid").join(name("to"), "to").join(name("root"), "root")
    named = named.select("wid", F.col("to_word").alias("form"), F.col("root_word").alias("root"))
    return (
        words.select("wid", "word")
        .join(near, "wid")
        .join(named, "wid", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
        )
    )


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
g AS (SELECT d, w, count(*) AS k FROM t WHERE length(w) >= 7 GROUP BY 1, 2),
c AS (SELECT w, k, list_transform(string_split(d || ':' || w, ''), lambda x: unicode(x)) AS cp FROM g),
y AS (SELECT w, k, flatten(list_transform(cp, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END)) AS bytes FROM c),
z AS (SELECT w, k, flatten(list_transform(bytes, lambda x: [CAST((x >> 0) & 1 AS BIGINT), (x >> 1) & 1, (x >> 2) & 1, (x >> 3) & 1,
    (x >> 4) & 1, (x >> 5) & 1, (x >> 6) & 1, (x >> 7) & 1])) AS bits FROM y),
h AS (SELECT w, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bits),
    lambda a, x: xor(a >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295) AS h FROM z),
s AS (SELECT CASE WHEN h % 31 = 0 THEN w[1 : h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM s WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
p AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM v),
r AS (SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest FROM p),
e AS (SELECT x.word AS a, y.word AS b, y.n AS m FROM r x JOIN r y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT r.word, v.word, v.n FROM r JOIN v ON v.word = r.rest
  UNION SELECT v.word, r.word, r.n FROM r JOIN v ON v.word = r.rest),
f AS (SELECT a, count(*) AS n_near, max(m) AS m FROM e GROUP BY 1),
b AS (SELECT a, min(b) AS b, max(e.m) AS m FROM e JOIN f USING (a) WHERE e.m = f.m GROUP BY 1),
q AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.m >= 10 * n THEN b.b END AS form, CASE WHEN b.m >= 10 * n THEN b.m END AS form_n
  FROM v LEFT JOIN f ON f.a = word LEFT JOIN b ON b.a = word),
u AS (SELECT word AS start, word AS at FROM q UNION ALL SELECT start, form FROM u JOIN q ON q.word = u.at WHERE form IS NOT NULL)
SELECT q.word, q.form, u.at AS root, q.n, CAST(q.n_near AS BIGINT) AS n_near, q.form_n
FROM q JOIN u ON u.start = q.word JOIN q l ON l.word = u.at WHERE l.form IS NULL
"""
