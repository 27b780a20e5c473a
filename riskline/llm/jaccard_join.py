"""N-gram Jaccard join by vertical partitioning (operator 10).

Which texts have word-shingle sets with a Jaccard similarity of at least
``similar`` percent? The result is exact. Copies of one set share a
class (its fingerprint); links are looked for between classes.

The global order of the n-grams is cut into fragments (ranges of the 64-bit
n-gram hash). Each step looks at fragments on their own and adds up what they
give per set or per pair:

1. ``lone`` counts. A linked set shares at least t = ceil(similar * n / 100) of its n
   n-grams, so a set with more than n - t n-grams that no other set has is linked with
   nothing. The leading fragments (``LEADING`` of the hash space) are counted first for all
   sets; the sets that remain are counted over all fragments. N-grams are pre-aggregated
   before the shuffle: one that several sets of a batch share becomes one entry.
2. Prefixes. Two linked sets share an n-gram among the first n - t + 1 of
   each in one global order: n-grams by hash, the frequent ones (more than
   1/100,000 of all entries each, so at most 100,000 of them) last, by frequency.
3. Star pairs. In each list of sets with one prefix n-gram, the set with the largest
   shared portion is the centre, and is paired with the others. That is linear in the lists.
4. ``overlaps``. For the pairs, each fragment counts its partial overlap; the sums are exact.
   Linked pairs join components.
5. The other pairs of a list matter only between components. For x and y around a centre c,
   |x&y| <= min(|x&c|, |y&c|) + |(x-c)&(y-c)|. What members have outside their centre is fetched only for centres with members
   of several components that are not all nearest to one other centre. Pairs that the first part leaves, or that share one of the first n-grams
   outside the centre (a prefix as in 2), are counted as in 4; of two sets that are nearest to one centre, that centre decides.

Nulls, empty texts and texts of white space have an empty set and are linked with nothing.
Repeated rows and repeated or null ids are allowed: each input row gives one row; a class
that has only null ids has a null component id. Fewer words than ``k`` make one n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.tables import as_docs, cut, parts, small, step
from riskline.llm.textblocks import mix, run_starts, word_chunks

#: Part of the hash space whose n-grams are counted for all sets: above 1/5, so that a set
#: of 80 % similarity can be ruled out by them alone.
LEADING = 0.3
#: Fragments of the global order for the overlaps of pairs.
FRAGMENTS = 4
#: N-grams counted in one task; frequent n-grams at most (as 1/x of all entries).
BUCKET_GRAMS = 2_000_000
#: Sets whose counts are summed in one task.
SLICE_SETS = 200_000
FREQUENT = 100_000
#: N-grams held in a task before they are sent on.
FLUSH_GRAMS = 4_000_000

_U = np.uint64


def gram_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk of texts: (first row, last row + 1, n-gram hashes, row of each), sorted by row and hash, distinct."""
    for a, b, w in word_chunks(column):
        g, d = w.ngrams(k)
        for c in range(1, k):
            few = np.flatnonzero(w.count == c)
            if len(few):
                whole = w.hash[w.first[few]]
                for j in range(1, c):
                    whole = whole * _U(0xD6E8FEB86659FD93) + w.hash[w.first[few] + j]
                g, d = np.concatenate([g, mix(whole)]), np.concatenate([d, few])
        order = np.lexsort((g, d))
        g, d = g[order], d[order]
        at = run_starts(d, g)
        yield a, b, g[at], d[at]


def fingerprints(g: np.ndarray, d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit fingerprint (sum of mixed hashes) of each of n sets."""
    total = np.zeros(len(g) + 1, np.uint64)
    np.cumsum(mix(g ^ _U(0x5851F42D4C957F2D)), out=total[1:])
    first = np.searchsorted(d, np.arange(n + 1))
    size = np.diff(first)
    return size, mix(total[first[1:]] - total[first[:-1]] + size.astype(np.uint64))


def profile(docs: DataFrame, k: int) -> DataFrame:
    """One row per text: ``_id``, ``_key`` (hash of the text), ``n`` (set size), ``fp`` (null for empty sets)."""

    def run(batches):
        for batch in batches:
            text, n = batch.column(2), batch.num_rows
            size, fp = np.zeros(n, np.int64), np.zeros(n, np.uint64)
            for a, b, g, d in gram_sets(text, k):
                size[a:b], fp[a:b] = fingerprints(g, d, b - a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), pa.array(fp.view(np.int64), mask=size == 0)],
                names=["_id", "_key", "n", "fp"],
            )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.select("_id", F.xxhash64("_text").alias("_key"), "_text").mapInArrow(run, f"_id {kind}, _key long, n long, fp long")


class _Entries:
    """Gathers (n-gram, set) pairs of a task. ``flush`` gives one row per bucket: the n-grams that one set has,
    with the set, and those that several sets have, with their number."""

    def __init__(self, buckets: int):
        self.buckets, self.grams, self.sets, self.held = buckets, [], [], 0

    def add(self, g: np.ndarray, fp: np.ndarray) -> None:
        self.grams.append(g)
        self.sets.append(fp)
        self.held += len(g)

    def flush(self) -> pa.RecordBatch | None:
        if not self.held:
            return None
        g, f = np.concatenate(self.grams), np.concatenate(self.sets)
        self.grams, self.sets, self.held = [], [], 0
        order = np.lexsort((f, g))
        g, f = g[order], f[order]
        at = run_starts(g, f)
        g, f = g[at], f[at]
        at = run_starts(g)
        count = np.diff(np.append(at, len(g)))
        g, f = g[at], f[at]
        bucket = ((g & _U(0xFFFFFFFF)) * _U(self.buckets) >> _U(32)).astype(np.int64)
        order = np.lexsort((count > 1, bucket))
        g, f, count, bucket = g[order], f[order], count[order], bucket[order]
        at = run_starts(bucket)
        to = np.append(at[1:], len(g))
        rows = {"bucket": bucket[at], "one": [], "sets": [], "more": [], "counts": []}
        for a, b in zip(at, to, strict=True):
            one = a + int(np.searchsorted(count[a:b] > 1, True))
            rows["one"].append(g[a:one].tobytes())
            rows["sets"].append(f[a:one].tobytes())
            rows["more"].append(g[one:b].tobytes())
            rows["counts"].append(count[one:b].astype(np.int32).tobytes())
        return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "bucket" else pa.binary()) for k, v in rows.items()})


ENTRY_SCHEMA = "bucket int, one binary, sets binary, more binary, counts binary"


def _joined(rows: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows), kind)


def _count_bucket(slices: int, frequent_from: int | None):
    """Reducer of one bucket: lone n-grams per set, by slices of the sets; and the frequent n-grams with their number of sets."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one, sets = _joined(rows["one"], np.uint64), _joined(rows["sets"], np.int64)
        more, counts = _joined(rows["more"], np.uint64), _joined(rows["counts"], np.int32)
        order = np.lexsort((sets, one))
        one, sets = one[order], sets[order]
        at = run_starts(one, sets)  # copies of a set count once
        one, sets = one[at], sets[at]
        at = run_starts(one)
        times = np.diff(np.append(at, len(one)))
        lone = at[(times == 1) & ~np.isin(one[at], more)] if len(at) else at
        fp, n = np.unique(sets[lone], return_counts=True)
        part = ((fp.view(np.uint64) >> _U(32)) * _U(slices) >> _U(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        fp, n, part = fp[order], n[order].astype(np.int32), part[order]
        cuts = run_starts(part)
        ends = np.append(cuts[1:], len(part))
        rows = [(int(part[x]), fp[x:y].tobytes(), n[x:y].tobytes(), None, None) for x, y in zip(cuts, ends, strict=True)]
        if frequent_from is not None:
            every, weight = np.concatenate([one[at], more]), np.concatenate([times, counts])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            at = run_starts(every)
            if len(at):
                df = np.add.reduceat(weight, at)
                hot = df >= frequent_from
                rows += [(-1, None, None, g, d) for g, d in zip(every[at][hot].view(np.int64).tolist(), df[hot].tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["slice", "fps", "lone", "gram", "df"]).astype({"gram": "Int64", "df": "Int64"})

    return run


def _sum_slice(rows: pd.DataFrame) -> pd.DataFrame:
    """Lone n-grams per set of one slice, over all buckets."""
    fp, which = np.unique(_joined(rows["fps"], np.int64), return_inverse=True)
    total = np.bincount(which, weights=_joined(rows["lone"], np.int32), minlength=len(fp))
    return pd.DataFrame({"fp": fp, "lone": total.astype(np.int64)})


def _counts(entries: DataFrame, sets: int, frequent_from: int | None) -> DataFrame:
    """Counts of all buckets, still by slice; the frequent n-grams in rows of their own (slice -1)."""
    slices = parts(entries.sparkSession, sets, SLICE_SETS)
    return entries.groupBy("bucket").applyInPandas(_count_bucket(slices, frequent_from), "slice int, fps binary, lone binary, gram long, df long")


def _lone(counted: DataFrame) -> DataFrame:
    """(fp, lone) for the sets that have lone n-grams."""
    return counted.filter("slice >= 0").groupBy("slice").applyInPandas(_sum_slice, "fp long, lone long")


def leading_entries(docs: DataFrame, k: int, part: float, buckets: int) -> DataFrame:
    """Entries of the n-grams in the leading part of the hash space, over all texts."""
    limit = _U(int(part * 2.0**64))

    def run(batches):
        held = _Entries(buckets)
        for batch in batches:
            for a, b, g, d in gram_sets(batch.column(0), k):
                _, fp = fingerprints(g, d, b - a)
                lead = g < limit
                held.add(g[lead], fp.view(np.int64)[d[lead]])
                if held.held >= FLUSH_GRAMS and (out := held.flush()):
                    yield out
        if out := held.flush():
            yield out

    return docs.select("_text").mapInArrow(run, ENTRY_SCHEMA)


def set_rows(docs: DataFrame, k: int) -> DataFrame:
    """fp, n and the sorted n-grams of each text (one row per text that has words)."""

    def run(batches):
        for batch in batches:
            for a, b, g, d in gram_sets(batch.column(0), k):
                n, fp = fingerprints(g, d, b - a)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp.view(np.int64)[some]), pa.array(n[some]), _lists(g, np.append(0, np.cumsum(n[some])))],
                    names=["fp", "n", "grams"],
                )

    return docs.select("_text").mapInArrow(run, "fp long, n long, grams array<long>")


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _grams_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a list column, and the row of each."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
    return values, np.repeat(np.arange(len(column)), np.diff(offsets))


def set_entries(sets: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        held = _Entries(buckets)
        for batch in batches:
            g, d = _grams_of(batch.column(1))
            held.add(g, batch.column(0).to_numpy()[d])
            if held.held >= FLUSH_GRAMS and (out := held.flush()):
                yield out
        if out := held.flush():
            yield out

    return sets.select("fp", "grams").mapInArrow(run, ENTRY_SCHEMA)


def prefixes(sets: DataFrame, similar: int, hot: np.ndarray) -> DataFrame:
    """(gram, fp, n, s) for the prefix n-grams of each set; ``hot``: the frequent n-grams, the rarest first."""
    by_gram = np.sort(hot)
    rank = np.argsort(hot, kind="stable").astype(np.int64)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            g, d = _grams_of(batch.column(3))
            place = np.zeros(len(g), np.int64)
            if len(by_gram):
                i = np.minimum(np.searchsorted(by_gram, g), len(by_gram) - 1)
                place = np.where(by_gram[i] == g, rank[i] + 1, 0)
            order = np.lexsort((g, place, d))  # by set, then the global order
            n = batch.column(1).to_numpy()
            keep = n - (similar * n + 99) // 100 + 1
            first = np.searchsorted(d, np.arange(len(n)))
            taken = order[np.arange(len(d)) - first[d] < keep[d]]
            row = d[taken]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[taken].view(np.int64)), *(batch.column(i).take(pa.array(row)) for i in range(3))], names=["gram", "fp", "n", "s"]
            )

    return sets.select("fp", "n", "s", "grams").mapInArrow(run, "gram long, fp long, n long, s long")


def fragments(sets: DataFrame, pieces: int) -> DataFrame:
    """(fp, fragment, part): each set cut into its fragments of the global order."""
    cuts = np.array([int(i * 2.0**64 / pieces) for i in range(1, pieces)], np.uint64)

    def run(batches):
        for batch in batches:
            g, d = _grams_of(batch.column(1))
            fragment = np.searchsorted(cuts, g, "right")
            order = np.lexsort((g, fragment, d))
            g, d, fragment = g[order], d[order], fragment[order]
            at = run_starts(d, fragment)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(d[at])), pa.array(fragment[at].astype(np.int32)), _lists(g, np.append(at, len(g)))],
                names=["fp", "fragment", "part"],
            )

    return sets.select("fp", "grams").mapInArrow(run, "fp long, fragment int, part array<long>")


def _meeting(pairs: DataFrame, segments: DataFrame, fragment: int, rows: int) -> DataFrame:
    """``pairs`` with the segments ``part_a`` and ``part_b`` of one fragment, where b has one. The members' segments (b)
    travel to the centres' (a), which are fewer; few pairs are sent to the segments."""
    centres = small(pairs.select("a").distinct(), rows)
    mine = segments.filter(F.col("fragment") == fragment).drop("fragment")
    left = mine.join(centres, mine.fp == centres.a, "left_semi").select(F.col("fp").alias("a"), F.col("part").alias("part_a"))
    right = mine.join(small(pairs, rows), mine.fp == F.col("b")).drop("fp").withColumnRenamed("part", "part_b")
    return right.join(left, "a", "left").withColumn("part_a", F.coalesce("part_a", F.array().cast("array<bigint>")))


def overlaps(pairs: DataFrame, segments: DataFrame, rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b, overlap): partial overlaps counted in each fragment, summed per pair. One fragment travels at a time, so that
    disk holds no more than its segments and the counts of those before it: the cuts that are returned too."""
    pairs, counts = pairs.select("a", "b"), []
    for i in range(FRAGMENTS):
        both = _meeting(pairs, segments, i, rows)
        counts.append(step(both.select("a", "b", F.size(F.array_intersect("part_a", "part_b")).alias("overlap"))))
    return reduce(DataFrame.union, counts).groupBy("a", "b").agg(F.sum("overlap").cast("long").alias("overlap")), counts


def rest_of(pairs: DataFrame, segments: DataFrame, rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b, rest): the first ``most`` (a column of ``pairs``) n-grams, by fragment and hash, of b that a has not; and the
    cuts it is read from. Fragments are read in their order, each for the pairs that have not enough yet."""
    found: list[DataFrame] = []
    open_ = pairs.select("a", "b", "most")
    for i in range(FRAGMENTS):
        both = _meeting(open_.filter("most > 0"), segments, i, rows)
        rest = F.slice(F.array_sort(F.array_except("part_b", "part_a")), 1, F.col("most"))
        found.append(step(both.select("a", "b", rest.alias("rest"))))
        got = found[-1].select("a", "b", F.size("rest").alias("got"))
        open_ = open_.join(small(got, rows), ["a", "b"], "left").select("a", "b", (F.col("most") - F.coalesce("got", F.lit(0))).alias("most"))
    return reduce(DataFrame.union, found).groupBy("a", "b").agg(F.flatten(F.collect_list("rest")).alias("rest")), found


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the edges (a, b)."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("root").alias("near"))
        step = label.join(near, label.node == near.a).select("node", F.least("root", "near").alias("hop"), F.col("root").alias("was"))
        jump = label.select(F.col("node").alias("hop"), F.col("root").alias("far"))
        after = cut(step.join(jump, "hop", "left").select("node", F.least("hop", "far").alias("root"), "was"))
        if not after.filter("root != was").head(1):
            return after.select("node", "root")
        label = after.select("node", "root")


def linked_classes(docs: DataFrame, classes: DataFrame, k: int, similar: int) -> DataFrame | None:
    """(node, root) for the classes (fp) that have a link; None if no set can have any."""
    spark = docs.sparkSession
    total = classes.agg(F.sum("n"), F.count("*")).first()
    if not total[0]:
        return None
    spare = F.col("n") - F.floor((similar * F.col("n") + 99) / 100).cast("long")
    lone = _lone(_counts(leading_entries(docs, k, LEADING, parts(spark, total[0] * LEADING, BUCKET_GRAMS)), total[1], None))
    left = classes.join(lone, "fp", "left").filter(F.coalesce("lone", F.lit(0)) <= spare)
    left = step(left.select("fp", "n", "_key"))
    rows, grams = left.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not rows:
        return None
    chosen = small(left.select("_key").distinct(), rows)
    texts = docs.withColumn("_key", F.xxhash64("_text")).join(chosen, "_key", "left_semi")
    sets = set_rows(texts, k).groupBy("fp").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))
    sets = step(sets.join(small(left.select("fp"), rows), "fp", "left_semi"))

    # all fragments, over the sets that are left
    tallies = step(_counts(set_entries(sets, parts(spark, grams, BUCKET_GRAMS)), rows, max(3, grams // FREQUENT)))
    hot = tallies.filter("gram is not null").orderBy("df", "gram").select("gram").toPandas()["gram"].to_numpy(np.int64).view(np.uint64)
    lone = cut(_lone(tallies))
    open_ = sets.join(small(lone, rows), "fp", "left").withColumn("s", F.col("n") - F.coalesce("lone", F.lit(0))).drop("lone")
    sets = step(open_.filter(F.col("n") - F.col("s") <= spare), sets, tallies)
    segments = fragments(sets, FRAGMENTS)

    # star pairs
    lists = prefixes(sets, similar, hot)
    best = F.max(F.struct((F.col("s") / F.col("n")).alias("r"), "n", "fp", "s"))
    centre = lists.groupBy("gram").agg(best.alias("c"), F.count("*").alias("m")).filter("m > 1").select("gram", F.col("c.fp").alias("a"))
    star = lists.select("gram", "fp").join(centre, "gram").filter("fp != a").select("a", F.col("fp").alias("b")).distinct()
    star = step(star)
    sizes = sets.select("fp", "n", "s")
    size_a = sizes.select(F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a"))
    size_b = sizes.select(F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("s_b"))

    def counted(pairs: DataFrame) -> DataFrame:
        met, done = overlaps(pairs, segments, pairs.count())
        return step(met.join(small(size_a, rows), "a").join(small(size_b, rows), "b"), *done)

    enough = (100 + similar) * F.col("overlap") >= similar * (F.col("n_a") + F.col("n_b"))
    stars = counted(star)
    edges = stars.filter(enough).select("a", "b")
    root = components(edges)

    # Between components, around a common centre: one of the two is outside the centre's component. Their overlap is
    # at most min(|x&c|, |y&c|), and what they share outside the centre. Of two sets that are nearest to the
    # same centre, only that centre decides.
    named = root.select("node", "root")
    x = stars.select("a", "b", F.col("n_b").alias("n"), F.col("overlap").alias("o"))
    top = cut(x.groupBy("b").agg(F.max(F.struct("o", "a"))["a"].alias("top")))
    least = cut(x.groupBy("a").agg(F.min("n").alias("least_n")))
    x = x.join(small(named.withColumnRenamed("node", "b"), rows), "b", "left").withColumn("root", F.coalesce("root", "b"))
    x = x.join(small(top, rows), "b").join(small(least, rows), "a")
    # centres whose members are all of one component, or all nearest to one other centre, decide no pair
    ends = [f(c).alias(f"{m}_{c}") for c in ("root", "top") for m, f in (("low", F.min), ("high", F.max))]
    deciding = cut(x.groupBy("a").agg(*ends).filter("low_root != high_root and (low_top != high_top or low_top = a)").select("a"))
    x = x.join(small(deciding, rows), "a", "left_semi")
    # a partner of x has similar / 100 * n n-grams at least, so they share ``wanted``; among the first of rest in any
    # one order there is one that they share, if they share enough outside the centre
    partner = F.greatest(F.col("least_n"), F.ceil(similar * F.col("n") / 100))
    wanted = F.ceil(similar * (F.col("n") + partner) / (100 + similar)).cast("long")
    length = F.greatest(F.col("n") - wanted + 1, F.lit(0)).cast("int")
    whole = F.col("n") - F.col("o") <= 2 * length  # near the centre: all of rest, so that counts are exact
    x = cut(x.withColumns({"enough": F.col("o") >= wanted, "whole": whole, "length": length}).drop("least_n"))
    most = F.when(F.col("whole"), F.col("n")).otherwise(F.col("length")).cast("int")
    met, done = rest_of(x.withColumn("most", most), segments, x.count())
    kept = ["n", "o", "root", "top", "enough", "whole", F.coalesce("rest", F.array().cast("array<bigint>")).alias("rest")]
    x = step(x.join(met, ["a", "b"], "left").select("a", "b", *kept), x, *done)
    centres = small(named.select(F.col("node").alias("a"), F.col("root").alias("root_a")), rows)
    outside = x.join(centres, "a", "left").filter(F.col("root") != F.coalesce("root_a", "a")).drop("root_a")
    y = x.select("a", *(F.col(c).alias(f"{c}2") for c in ("b", "n", "o", "root", "top", "whole", "rest")))
    apart = (F.col("root") != F.col("root2")) & ((F.col("top") != F.col("top2")) | (F.col("top") == F.col("a")))
    need = similar * (F.col("n") + F.col("n2"))
    pair = [F.least("b", "b2").alias("a"), F.greatest("b", "b2").alias("b")]
    # within the centre alone
    hopeful = outside.filter("enough").drop("rest")
    inner = hopeful.join(y.drop("rest2"), "a").filter(apart & ((100 + similar) * F.least("o", "o2") >= need)).select(*pair)
    # with shared n-grams outside the centre
    mine = outside.withColumn("gram", F.explode("rest")).drop("rest")
    theirs = y.withColumn("gram", F.explode("rest2")).drop("rest2")
    theirs = theirs.join(small(outside.select("a").distinct(), rows), "a", "left_semi")
    outer = mine.join(theirs, ["a", "gram"]).filter(apart & (F.col("n") * 100 >= F.col("n2") * similar) & (F.col("n2") * 100 >= F.col("n") * similar))
    kept = ["n", "n2", "o", "o2", "whole", "whole2"]
    outer = outer.groupBy("a", "b", "b2").agg(F.count("*").alias("extra"), *(F.first(c).alias(c) for c in kept))
    # a count over the whole of both is exact
    outer = outer.filter(~(F.col("whole") & F.col("whole2")) | ((100 + similar) * (F.least("o", "o2") + F.col("extra")) >= need)).select(*pair)
    near = step(inner.union(outer).distinct(), x)
    more = step(counted(near).filter(enough).select("a", "b"), sets)
    if not more.head(1):
        return root
    return components(edges.union(more))


def _grouped(docs: DataFrame, k: int, similar: int) -> tuple[DataFrame, DataFrame]:
    """The texts' profiles, and (fp, root, low) of every class: the class its component is named by, and the smallest id in it."""
    rows = cut(profile(docs, k))
    classes = cut(
        rows.filter("fp is not null").groupBy("fp").agg(F.first("n").alias("n"), F.min("_key").alias("_key"), F.min("_id").alias("low"))
    )
    roots = linked_classes(docs, classes, k, similar)
    if roots is None:
        return rows, classes.select("fp", F.col("fp").alias("root"), "low")
    wide = classes.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "low")
    lowest = wide.groupBy("root").agg(F.min("low").alias("lowest"))
    wide = cut(wide.join(lowest, "root").select("fp", "root", "lowest"))
    every = classes.join(wide, "fp", "left")
    return rows, every.select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("low"))


def near_duplicate_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similar: int = 80
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links, its own
    included; a null id has its class's component). See the module's text for the method and for odd input."""
    rows, classes = _grouped(as_docs(df, id_col, text_col), k, similar)
    return rows.join(classes, "fp", "left").select(
        F.col("_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("fp").isNull(), F.col("_id")).otherwise(F.col("low")).alias("component_id"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similar: int = 80) -> DataFrame:
    """The rows of ``df``, one of each component: that with the smallest id (null ids last), of repeated rows one.
    Rows without words are all kept."""
    docs = as_docs(df, id_col, text_col)
    rows, classes = _grouped(docs, k, similar)
    row = lambda i, t: F.xxhash64(i.cast("string"), t)  # noqa: E731  names a row by its id and text
    rows = rows.filter("fp is not null").join(classes.select("fp", "root"), "fp")
    rows = cut(rows.groupBy("root", "_id", "_key").agg(F.count("*").alias("times")).withColumn("_row", row(F.col("_id"), F.col("_key"))))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("x"), "_id", "_key", "_row", "times")).alias("m"))
    first = cut(first.select("m._row", "m.times"))
    dropped = cut(rows.select("_row").distinct().join(first.select("_row"), "_row", "left_anti"))
    name = "_row"
    while name in df.columns:
        name += "_"
    text = F.col(f"`{text_col}`").cast("string")
    named = df.withColumn(name, row(F.col(f"`{id_col}`"), F.xxhash64(text)))
    kept = named.join(small(dropped.withColumnRenamed("_row", name)), name, "left_anti")
    again = first.filter("times > 1").select(F.col("_row").alias(name))
    if again.head(1):
        again = small(again)
        kept = kept.join(again, name, "left_anti").unionByName(kept.join(again, name, "left_semi").dropDuplicates([name]))
    return kept.select([F.col(f"`{c}`") for c in df.columns])
