"""Quality rules, decontamination and chat formatting against plain Python."""

import hashlib
import random
import re
from collections import Counter

from riskline.llm import chat_format, decontamination, quality_rules
from tests.llm.samples import BASE, DOCS, empty, frame, prose


def base_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def kept(text):
    n, chars, symbols, dup, rep = base_measures(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letters, capitals = len(re.findall("[A-Za-z]", text or "")), len(re.findall("[A-Z]", text or ""))
    failed = n < 10 or 100 * rep > 20 * n
    bad = 100 * symbols > 30 * n or (len(lines) > 3 and 100 * dup > 50 * len(lines)) or chars < 2 * n or chars > 14 * n
    return failed, not (failed or bad or (letters > 20 and 100 * capitals > 60 * letters))


def rule_rows():
    r = random.Random(5)
    extra = [(100 + i, " ".join(r.choices(["a", "bb", "c\n", "dd", "E", "#"], k=r.randint(0, 40)))) for i in range(60)]
    return [*DOCS, *extra, (300, "LOUD WORDS EVERYWHERE " * 4 + BASE[:20]), (301, "a b c d e f " + BASE + " a b c d e f")]


def test_quality_rules(spark):
    rows = rule_rows()
    got = quality_rules.judge(frame(spark, rows))
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert Counter(map(tuple, got.collect())) == Counter((i, *base_measures(t), *kept(t)) for i, t in rows)
    good = quality_rules.keep_good(frame(spark, rows))
    assert good.columns == frame(spark, rows).columns
    assert Counter((r.doc_id, r.text) for r in good.collect()) == Counter((i, t) for i, t in rows if kept(t)[1])


def test_rules_are_ordered_by_rejection_per_cost(spark):
    order = quality_rules.order_rules(frame(spark, rule_rows()))
    assert {r.name for r, _, _ in order} == {r.name for r in quality_rules.RULES}
    worth = [share / cost for _, cost, share in order]
    assert worth == sorted(worth, reverse=True)
    assert quality_rules.judge(empty(spark)).count() == 0
    # among texts that the rules before have left: no text is counted twice
    rows = rule_rows()
    assert abs(sum(share for _, _, share in order) - sum(not kept(t)[1] for _, t in rows) / len(rows)) < 1e-9


def test_order_of_the_shown_measures_is_steady(spark):
    rows = rule_rows() * 3
    orders = {tuple(r.name for r, _, _ in quality_rules.order_rules(frame(spark, rows), paid=quality_rules.PAID)) for _ in range(4)}
    assert len(orders) == 1 and next(iter(orders))[-1] == "capitals"


def test_later_measures_only_inside_the_cascade(spark, capsys):
    quality_rules.judge(frame(spark, rule_rows())).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    letters = [line for line in plan.split("\n") if "[^A-Z]+" in line]
    assert len(letters) == 1 and letters[0].index("CASE WHEN") < letters[0].index("[^A-Z]+")


def bench_words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(rows, items):
    out = []
    for d, t in rows:
        w, hit, found = bench_words(t), set(), set()
        for item, text in items:
            iw = bench_words(text)
            if item is None or not iw:
                continue
            k = min(10, len(iw))
            for s in {tuple(iw[i : i + k]) for i in range(max(1, len(iw) - 9))}:
                for i in range(len(w) - k + 1):
                    if tuple(w[i : i + k]) == s:
                        hit |= set(range(i, i + k))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def test_decontamination(spark):
    items = [(1, prose(900, 30)), (2, "Short ITEM"), (2, prose(901, 14)), (30, "ÉCOLE naïve x"), (4, None), (5, "..."), (None, BASE), (7, "w w w w w w w w w w w w"), (8, prose(902, 10))]
    p = [bench_words(t) for _, t in items]
    rows = [
        *DOCS,
        (200, "start " + items[0][1].upper().replace("É", "É") + " end"),
        (201, items[0][1][:-1]),
        (202, " ".join(p[0][5:15]) + ", " + " ".join(p[0][5:15])),
        (203, "a short-item, and short item again; École naïve x"),
        (204, "école naïve x ÉCOLE naïve x"),
        (205, " ".join(p[2][:9] + ["other"] + p[2][10:])),
        (206, prose(902, 10) + " " + prose(901, 14) + " " + prose(901, 14)),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(frame(spark, rows), bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = contaminated(rows, items)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    clean = decontamination.clean_rows(frame(spark, rows), bench)
    assert clean.columns == frame(spark, rows).columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r, w in zip(rows, want, strict=True) if not w[-1])
    none = decontamination.decontaminate(frame(spark, rows[:3]), bench.limit(0)).collect()
    assert not any(r.contaminated for r in none) and len(none) == 3


def test_proximity(spark):
    item = prose(910, 10).split(" ")
    item = [f"{w}{i}" for i, w in enumerate(item)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(1, " ".join(item)), (2, " ".join(item[:5] + ["new", "words"] + item[5:])), (3, " ".join(item[:3])), (4, " ".join(item[:5]) + " x" * 300 + " ".join(item[5:]))]
    got = decontamination.proximity_matches(frame(spark, rows), bench)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1)]


def test_chat_digests(spark):
    control = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", control), (1, 1, "assistant", "a\\b <| c \\<| d\\"), (1, 2, "assistant", None), (1, 3, None, "no role"),
        (2, 0, "assistant", "x" * 5000), (2, 0, "assistant", "x" * 5000), (3, None, "system", "é😀\n\n"), (3, 1, "as<|im_sep|>s", "<"), (None, 0, "user", ""),
        (4, 7, "user", "|im_end|>"), (4, 1, "assistant", "\n"),
    ]
    table = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, conv string")
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.conversation_digests(table).collect()}
    esc = lambda x: x.replace("\\", "\\\\").replace("<|", "<\\|")
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), (role or ""), (text or "")) for c, t, role, text in rows if c == conv)
        told = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        size = sum(len(f"<|im_start|>{esc(r)}<|im_sep|>{esc(x)}<|im_end|>\n") for _, r, x in turns)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got[conv] == (len(turns), digest(told), len(loss), digest(loss), size)
    assert chat_format.conversation_digests(table.limit(0)).count() == 0


def test_event_log(spark):
    log = [
        ("c", 1, "m1", "open", "user", None), ("c", 2, "m1", "delta", None, "Hel"), ("c", 3, "m1", "delta", None, "lo"), ("c", 3, "m1", "delta", None, "lo"),
        ("c", 4, "m2", "open", "assistant", None), ("c", 5, "m2", "delta", None, "draft"), ("c", 6, "m2", "regenerate", None, None),
        ("c", 7, "m2", "delta", None, "final"), ("c", 9, "m1", "edit", None, "Bye"), ("c", 10, "m1", "delta", None, "!"),
        ("c", 8, "m3", "open", "user", None), ("c", 11, "m3", "retract", None, None),
    ]
    events = spark.createDataFrame(log, "conv string, seq long, message string, kind string, role string, text string").repartition(4)
    row = chat_format.format_events(events).first()
    assert row.formatted == "<|im_start|>user<|im_sep|>Bye!<|im_end|>\n<|im_start|>assistant<|im_sep|>final<|im_end|>\n"
    assert [p.text for p in row.pieces if p.loss] == ["final"]


def test_letters_whose_small_form_depends_on_what_follows(spark):
    items = spark.createDataFrame([(1, "ΟΔΟΣ"), (2, "οδος"), (3, "ΟΔΟΣ Α")], "item_id long, text string")
    texts = ["x ΟΔΟΣ.Α y", "ΟΔΟΣ", "ΟΔΟΣ:Α", "οδος", "ΟΔΟΣΑ", "Οδος"]
    got = decontamination.decontaminate(frame(spark, list(enumerate(texts))), items)
    assert {r.doc_id: r.n_items for r in got.collect()} == {0: 2, 1: 1, 2: 2, 3: 1, 4: 0, 5: 0}
