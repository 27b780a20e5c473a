import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from riskline.llm.spelling_variants import node_numbers, spelling_variants
from tests.llm.samples import DOCS, empty, frame, lower


def word_counts(rows, least=7, occurrences=2, every=31):
    n = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= occurrences}


def edits(a, b):
    """Whether two different words are one inserted, deleted or replaced code point apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = word_counts(rows)
    near = {w: [v for v in n if v != w and edits(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def got(df):
    out = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(tuple(r) for r in out)


def rows():
    found = list(DOCS)
    # chains: 200, 20 and 2 times; ties; runs of one letter; an insert, a replacement and a deletion of the same word
    for i, (word, times) in enumerate(
        {"straightforward": 200, "straightforwarx": 20, "straightforwaxx": 2, "aaaaaaaa": 50, "aaaaaaaaa": 5, "aaaaaaaaaa": 2, "éclairage": 30,
         "éclairrage": 3, "eclairage": 2, "xaaaaaaa": 50, "baaaaaaa": 50, "caaaaaaa": 4, "ÉCLAIRAGE": 40, "under": 9, "Windows": 6, "wîndows": 3}.items()
    ):
        found += [(1000 + i * 300 + k, f"{word},{word.title()}_{word}") for k in range(times)]
    long = "longrun" * 3000
    return found + [(9, f"{long} {long[:-1]}"), (12, f"{long[:-1]}1{long}"), (14, long[:-1] + " " + long), (None, "nullidword nullidword")]


def test_words_forms_and_roots_equal_brute_force(spark):
    want = brute(rows())
    assert got(spelling_variants(frame(spark, rows()))) == want
    assert sum(w[1] is not None for w in want) >= 8 and any(w[2] not in (w[0], w[1]) for w in want)


def test_empty_tables_have_no_words(spark):
    assert got(spelling_variants(empty(spark))) == []
    assert got(spelling_variants(frame(spark, [(1, None), (2, ""), (3, "few of those"), (None, None)]))) == []


@settings(max_examples=200, deadline=None)
@given(st.text("abé", min_size=1, max_size=7), st.text("abé", min_size=1, max_size=7))
def test_pairs_of_nodes_meet_exactly_for_neighbours(a, b):
    """Skipped and split pairs of two words meet once if they are one edit apart, never else."""

    def pairs(w):
        f, r, *_ = node_numbers(w)
        skip = [(f[i], r[i + 1]) for i in range(len(w))]
        first = [p for i, p in enumerate(skip) if i == 0 or w[i] != w[i - 1]]
        return skip, first, [(f[i], r[i]) for i in range(len(w) + 1)]

    if a == b:
        return
    (s, d, p), (t, e, q) = pairs(a), pairs(b)
    meets = len(set(s) & set(t)) + len(set(d) & set(q)) + len(set(e) & set(p))
    assert meets == (1 if edits(a, b) else 0)
