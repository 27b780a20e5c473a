"""Benchmark decontamination with a distributed positional inverted index (operator 5): DataFrame functions only.

Benchmark items are cut into windows of ``window`` words (an item of fewer words is one window).
1. The test terms' frequencies are counted over the whole corpus; a window with a term that the corpus lacks is dropped.
2. The ``rarest`` terms of each window are its anchors. The index stores their postings (text, position) in
   the shared checkpoint folder.
3. The anchors' lists, less their offsets in the window, are intersected: starts that all anchors give are candidates.
   With ``slack``, anchors whose adjusted positions lie close together give proximity matches.
4. The postings of all words of candidate texts are intersected with the windows' words in the same way, so that a match
   is exact in every word.

Frequent terms are counted with partial aggregation and never anchors unless a window has no rarer one; the benchmark side of
a join is broadcast only if it has ``BROADCAST_KEYS`` rows at most, else both are shuffled. Texts are told apart by
a 64-bit hash, so copies share their postings.

Words are runs of digits, letters and other characters beyond ASCII, in lower case (A-Z only). The search for candidates
folds the case of all letters of each word, the exact step only A-Z. Null texts have no words; items without words or with a null id are not
searched; an empty benchmark hits nothing. Repeated items count once by id. Repeated rows and ids of documents each give their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.llm.tables import cut, small

WINDOW, RAREST = 10, 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What ends a word, before and after lower-casing.
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def raw_words(text: Column) -> Column:
    """Words as they are; the first and last may be empty. Case is folded word by word, as the small form of a
    letter (capital sigma) may depend on what stands after the word."""
    return F.split(text, _BREAK)


def exact_words(text: Column) -> Column:
    """Words with A-Z in lower case; the first and last may be empty."""
    return F.split(F.translate(text, _UPPER, _LOWER), _BREAK)


def windows_of(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, wid, words): the windows of every item, ``wid`` the same for the same words."""
    words = F.array_remove(exact_words(F.col(f"`{text_col}`").cast("string")), "")
    rows = items.select(F.col(f"`{id_col}`").alias("item"), words.alias("_w")).filter("item is not null and size(_w) > 0")
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("_w") - window + 1, F.lit(1))))
    rows = rows.withColumn("_s", start).select("item", F.slice("_w", F.col("_s"), window).alias("words"))
    return rows.withColumn("wid", F.xxhash64("words", F.size("words"))).distinct()


def texts_of(df: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.xxhash64(text).alias("key"), text.alias("_text"))


def term_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, freq): occurrences of the test terms in all texts."""
    tokens = texts.select(F.explode(raw_words(F.col("_text"))).alias("word")).select(F.lower("word").alias("term"))
    return tokens.join(small(terms), "term").groupBy("term").agg(F.count("*").alias("freq"))


def anchors_of(windows: DataFrame, counts: DataFrame, rarest: int) -> DataFrame:
    """(wid, term, offset, bit, full): the rarest distinct terms of each window whose terms all occur."""
    places = windows.select("wid", "words").dropDuplicates(["wid"]).select("wid", F.posexplode("words").alias("offset", "word"))
    terms = places.withColumn("term", F.lower("word")).groupBy("wid", "term").agg(F.min("offset").alias("offset"))
    terms = terms.join(small(counts), "term", "left")
    ranked = terms.groupBy("wid").agg(
        F.slice(F.sort_array(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "term", "offset"))), 1, rarest).alias("a")
    )
    ranked = ranked.filter(F.col("a")[0]["freq"] > 0)
    one = ranked.select("wid", F.size("a").alias("n"), F.posexplode("a").alias("i", "x"))
    return one.select(
        "wid", F.col("x.term").alias("term"), F.col("x.offset").alias("offset"),
        F.expr("shiftleft(1, i)").alias("bit"), F.expr("shiftleft(1, n) - 1").alias("full"),
    )


def postings(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, pos, term): the positional index of the given terms."""
    tokens = texts.select("key", F.posexplode(raw_words(F.col("_text"))).alias("pos", "word"))
    tokens = tokens.select("key", "pos", F.lower("word").alias("term"))
    return tokens.join(small(terms), "term").select("key", "pos", "term")


def adjusted(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """Postings of the anchors with their offsets in the windows taken off."""
    return index.join(small(anchors), "term").select("key", "wid", (F.col("pos") - F.col("offset")).alias("start"), "bit", "full")


def intersected(lists: DataFrame) -> DataFrame:
    """(key, wid, start) that every anchor's adjusted list holds."""
    found = lists.filter("start >= 0").groupBy("key", "wid", "start").agg(F.bit_or("bit").alias("got"), F.first("full").alias("full"))
    return found.filter("got = full").select("key", "wid", "start")


def proximity(lists: DataFrame, slack: int) -> DataFrame:
    """(key, wid): all anchors of a window within ``slack`` words of where the phrase would have them
    (adjusted positions in one of two overlapping rows of cells of 2 * slack words)."""
    cell = F.explode(F.array(F.floor(F.col("start") / (2 * slack)) * 2, F.floor((F.col("start") + slack) / (2 * slack)) * 2 + 1))
    near = lists.withColumn("cell", cell).groupBy("key", "wid", "cell").agg(F.bit_or("bit").alias("got"), F.first("full").alias("full"))
    return near.filter("got = full").select("key", "wid").distinct()


def exact_matches(texts: DataFrame, candidates: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, wid, start, length) of the candidates all of whose words are in their places."""
    keys = candidates.select("key").distinct()
    chosen = texts.join(small(keys), "key", "left_semi")
    words = windows.select("wid", "words").dropDuplicates(["wid"])
    wanted = candidates.join(small(words), "wid").select("key", "wid", "start", F.size("words").alias("length"), F.posexplode("words").alias("o", "word"))
    wanted = wanted.withColumn("pos", F.col("start") + F.col("o"))
    terms = words.select(F.explode("words").alias("word")).distinct()
    tokens = chosen.select("key", F.posexplode(exact_words(F.col("_text"))).alias("pos", "word")).join(small(terms), "word", "left_semi")
    tokens = tokens.groupBy("key", "pos", "word").agg(F.count("*").alias("_n"))  # copies of a text count once
    met = wanted.join(tokens, ["key", "pos", "word"]).groupBy("key", "wid", "start").agg(F.count("*").alias("n"), F.first("length").alias("length"))
    return met.filter("n = length").select("key", "wid", "start", "length")


def hits(df: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str, window: int, rarest: int) -> DataFrame:
    """(key, n_hit, items): per text with a match, its hit words and the items found."""
    texts = texts_of(df, text_col)
    windows = cut(windows_of(benchmark, item_col, item_text, window))
    terms = cut(windows.select(F.explode("words").alias("w")).select(F.lower("w").alias("term")).distinct())
    anchors = cut(anchors_of(windows, cut(term_counts(texts, terms)), rarest))
    index = cut(postings(texts, anchors.select("term").distinct()))
    candidates = cut(intersected(adjusted(index, anchors)))
    matches = cut(exact_matches(texts, candidates, windows))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))
    step = lambda a, x: F.struct(
        (a["sum"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["end"]))).alias("sum"), F.greatest(x["end"], a["end"]).alias("end")
    )
    runs = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).cast("int").alias("end"))))
    covered = matches.groupBy("key").agg(F.aggregate(runs, zero, step, lambda a: a["sum"]).alias("n_hit"))
    found = matches.select("key", "wid").distinct().join(small(windows.select("wid", "item").distinct()), "wid")
    items = found.groupBy("key").agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    return cut(covered.join(items, "key"))


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    rarest: int = RAREST,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = hits(df, benchmark, text_col, item_col, item_text, window, rarest)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    n_words = F.size(F.array_remove(F.split(text, _BREAK), ""))
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("key"), n_words.cast("long").alias("n_words"))
    items = F.coalesce(F.sort_array("items"), F.array().cast("array<string>"))
    return rows.join(small(found), "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_rows(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    name = "_key"
    while name in df.columns:
        name += "_"
    found = hits(df, benchmark, text_col, "item_id", "text", WINDOW, RAREST).select(F.col("key").alias(name))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    clean = df.withColumn(name, F.xxhash64(text)).join(small(found), name, "left_anti")
    return clean.select([F.col(f"`{c}`") for c in df.columns])


def proximity_matches(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: int = 10, rarest: int = 3
) -> DataFrame:
    """``doc_id, item``: items of which some window has its rarest terms near their places in the document
    (a softer test than the exact phrase: words between them may be changed, added or left out)."""
    texts = texts_of(df, text_col)
    windows = cut(windows_of(benchmark, "item_id", "text", WINDOW))
    terms = cut(windows.select(F.explode("words").alias("w")).select(F.lower("w").alias("term")).distinct())
    anchors = cut(anchors_of(windows, cut(term_counts(texts, terms)), rarest))
    near = proximity(adjusted(cut(postings(texts, anchors.select("term").distinct())), anchors), slack)
    near = cut(near.join(small(windows.select("wid", "item").distinct()), "wid").select("key", "item").distinct())
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("key")).join(small(near), "key").select("doc_id", "item")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i+9], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT doc_id, k, i, array_to_string(w[i:i+k-1], ' ') AS s
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM v) WHERE len(w) >= k)),
m AS (SELECT g.doc_id, g.i, g.k, v.item_id FROM g JOIN v ON v.s = g.s AND v.k = g.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
