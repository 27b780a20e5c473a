import os
import time
from collections import Counter

from pyspark.sql import functions as F

from riskline.llm.jaccard_join import FRAGMENTS, fragments, keep_one, near_duplicate_components, overlaps, rest_of
from riskline.llm.tables import cut, step
from tests.llm.samples import DOCS, empty, frame, prose, words


def shingles(text, k=5):
    w = words(text)
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {" ".join(w)} if w else set()


def roots(rows):
    """Every pair compared: the set of each row, and a row that names its component."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def lowest_ids(rows, root):
    low = {r: None for r in root}
    for (d, _), r in zip(rows, root, strict=True):
        if d is not None and (low[r] is None or d < low[r]):
            low[r] = d
    return low


def brute(rows):
    """(id, set size, smallest id of the component) of every row."""
    sets, root = roots(rows)
    low = lowest_ids(rows, root)
    return [(d, len(s), low[r] if s else d) for (d, _), s, r in zip(rows, sets, root, strict=True)]


def edited(text, seed, times):
    import random

    r, w = random.Random(seed), text.split(" ")
    for _ in range(times):
        w[r.randrange(len(w))] = f"edit{r.random()}"
    return " ".join(w)


def rows():
    passage = prose(77, 60)
    found = list(DOCS)
    for g in range(4):  # groups of near copies around the threshold, and chains of edits
        base = prose(100 + g, 150)
        chain = base
        for i in range(14):
            found.append((1000 + 100 * g + i, edited(base, 10 * g + i, i % 7)))
            chain = edited(chain, 500 + i, 1)
            found.append((1050 + 100 * g + i, chain))
    for i in range(20):  # a passage that many documents share
        found.append((3000 + i, prose(300 + i, 30 + 3 * i) + " " + passage + " " + prose(400 + i, 10)))
    found += [(4000 + i, "few words only" + " x" * (i % 3)) for i in range(6)]
    return found


def test_components_and_keepers(spark):
    every = rows()
    want = brute(every)
    got = near_duplicate_components(frame(spark, every))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == Counter(want)

    kept = keep_one(frame(spark, every))
    assert kept.columns == frame(spark, every).columns
    kept = Counter((r.doc_id, r.text) for r in kept.collect())
    sets, root = roots(every)
    blank = Counter(x for x, s in zip(every, sets, strict=True) if not s)
    assert all(kept[r] == n for r, n in blank.items())
    low = lowest_ids(every, root)
    first = Counter(low[r] for r in {r for r, s in zip(root, sets, strict=True) if s})
    assert Counter(d for (d, t), n in kept.items() if shingles(t) for _ in range(n)) == first


def test_empty_tables(spark):
    assert near_duplicate_components(empty(spark)).count() == 0
    assert keep_one(frame(spark, [(1, None), (1, ""), (None, " ")])).count() == 3


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_step_leaves_only_what_later_steps_read(spark):
    """Disk holds neither the cuts that nothing reads any more nor the shuffles of finished jobs."""
    first = cut(spark.range(1000).select("id", (F.col("id") % 7).alias("k")))
    counted = step(first.groupBy("k").count().orderBy("k"), first)
    assert os.path.exists(counted._cut_path.removeprefix("file:")) and not os.path.exists(first._cut_path.removeprefix("file:"))
    spark._jvm.System.gc()
    time.sleep(2)
    before = _shuffle_files(spark)
    for i in range(3):
        step(spark.range(1000).groupBy((F.col("id") % (5 + i)).alias("k")).count())
    step(spark.range(1).select("id"))
    deadline = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < deadline:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert [tuple(r) for r in counted.orderBy("k").collect()] == [(k, len(range(k, 1000, 7))) for k in range(7)]


def test_rest_is_read_fragment_by_fragment_until_it_is_enough(spark):
    grams = {1: [-5, 3, 9], 2: [-(2**62) - 9, -7, -5, 1, 4, 2**62 + 1, 2**63 - 1], 3: [-5]}
    sets = spark.createDataFrame([(k, v) for k, v in grams.items()], "fp long, grams array<long>")
    pairs = spark.createDataFrame([(1, 2, 3), (1, 3, 5), (3, 2, 99)], "a long, b long, most int")
    met, _ = rest_of(pairs, fragments(sets, FRAGMENTS), 3)
    # unsigned order: 1, 4, 2^62 + 1, 2^63 - 1, then the negative ones
    got = {(r["a"], r["b"]): r["rest"] for r in met.collect()}
    assert sorted(got[(1, 2)]) == [1, 4, 2**62 + 1] and got[(1, 3)] == [] and sorted(got[(3, 2)]) == sorted(set(grams[2]) - {-5})
    met, counts = overlaps(pairs, fragments(sets, FRAGMENTS), 3)
    assert {(r["a"], r["b"]): r["overlap"] for r in met.collect()} == {(1, 2): 1, (1, 3): 1, (3, 2): 1} and len(counts) == FRAGMENTS


def test_kept_rows_leave_no_sets_on_disk(spark):
    """The pipeline's stage: what is left in the shared folder names classes and rows, but holds no set's n-grams."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    top = os.path.dirname(cut(spark.range(1))._cut_path.removeprefix("file:"))
    assert folder
    before = set(os.listdir(top))
    keep_one(frame(spark, rows())).count()
    left = [d for d in os.listdir(top) if d not in before and d.startswith("cut-")]
    columns = {c for d in left for c in spark.read.parquet(f"{top}/{d}").columns}
    assert "fp" in columns and not columns & {"grams", "rest", "one", "sets", "fps"}
