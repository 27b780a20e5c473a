"""WARC archives, HTML extraction and license scans."""

import hashlib
import itertools
import random

import pytest

from riskline.llm import html_extraction, license_scan, warc
from riskline.llm.html_extraction import main_text, minimum_cut
from tests.llm.samples import DOCS, empty, frame, prose

BIG = "<p>" + prose(1, 400) + "</p>"
TRAP = "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" + BIG
PAGES = [
    (1, "http://a.example/x?y#z", BIG), (2, "http://a.example/2", BIG), (9, "http://b.example", BIG), (9, "http://b.example", BIG), (3, "u\r\nWARC-Type: x", TRAP),
    (4, None, TRAP), (5, "", None), (6, "x", ""), (7, "y", "small"), (8, "y", "small"), (None, "n", BIG), (None, "n", "é😀" * 600), (10, "z", "é" * 500), (11, "z", "é" * 499 + "x"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, copy string").repartition(3)


def expected(rows):
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        same = [q for q, _, g in rows if (g or "").encode() == raw and q is not None]
        again = len(raw) >= 1000 and same and p != max(same)
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=str)


def test_archives(spark):
    got = warc.archive_digest(pages(spark))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(PAGES)
    assert warc.archive_digest(pages(spark).limit(0)).count() == 0


def test_captures_are_whole(spark):
    path = warc.write_archives(pages(spark).select("page_id", "url", "html"))
    rows = warc.captures(warc.read_records(spark, path)).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        assert r.request.kind == "request" and r.request.fields.startswith("GET ") and r.metadata.fields.startswith("page-id: ")
        if r.response.kind == "response":
            assert hashlib.sha1(r.response.payload or b"").hexdigest() == r.response.payload_digest
        else:
            assert r.response.refers_to and r.response.payload is None
    assert sum(r.response.kind == "revisit" for r in rows) == sum(x[3] == "revisit" for x in expected(PAGES))


def test_references_name_records(spark):
    path = warc.write_archives(pages(spark).select("page_id", "url", "html"))
    rows = warc.read_records(spark, path).collect()
    ids = [r.record_id for r in rows]
    assert len(ids) == len(set(ids)) == 3 * len(PAGES)
    by_id = {r.record_id: r for r in rows}
    revisits = [r for r in rows if r.kind == "revisit"]
    assert revisits
    for r in revisits:
        assert by_id[r.refers_to].kind == "response" and by_id[r.refers_to].payload_digest == r.payload_digest
    assert all(r.capture in by_id for r in rows)


def test_archives_of_uneven_pages(spark, tmp_path):
    rows = [(i, "u", str(i) + "x" * (60_000 if 300 <= i < 400 else 40)) for i in range(600)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartitionByRange(2, "page_id")
    path = warc.write_archives(table, str(tmp_path / "warc"), file_bytes=100_000)
    sizes = [f.stat().st_size for f in (tmp_path / "warc").glob("part-*")]
    assert 30 < len(sizes) < 300 and max(sizes) < 200_000
    assert warc.captures(warc.read_records(spark, path)).count() == 600


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.records_in(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.records_in(b"no record\r\n\r\n"))


def test_minimum_cut_against_all_cuts():
    r = random.Random(2)
    for _ in range(150):
        n = r.randint(1, 8)
        net = [r.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, r.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if r.random() < 0.5]
        cost = lambda s: sum(max(0, -x) if i else max(0, x) for x, i in zip(net, s, strict=True)) + sum(c for a, b, c in edges if s[a] != s[b])  # noqa: E731, B023
        assert cost(minimum_cut(net, edges)) == min(cost(s) for s in itertools.product([False, True], repeat=n))


HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>'


@pytest.mark.parametrize(
    "html, text",
    [
        (HEAD + "<nav><ul><li><a href=/a>Home</a></ul></nav><article><h1>Head</h1><p><b>One &amp; two.<br><p>Three\n\n four.</article><footer>&copy; x</footer>", "Head\nOne & two.\nThree four."),
        (HEAD + "<header>Site</header><main><p>Text of the page.</p><aside>See also</aside><div class='ad'>Buy!</div><form>Name <input></form><p>End.</main>", "Text of the page.\nEnd."),
        ("<article><p>First part.</p><section class=comments><p>I like this very much, it is great.</p></section></article>", "First part."),
        ("<article><p>Never closed, <i>cut off", "Never closed, cut off"),
        ("<article><p>Cookie recipes are fine.</p></article><div id='cookie-notice'>We use cookies.</div>", "Cookie recipes are fine."),
        ("<article>a &lt;b&gt; &#233; &nbsp; c</article>", "a <b> é c"),
        ("<div id=menu><a>Home</a> <a>News</a></div><div><h1>Title of it</h1><p>A paragraph of some length, with words.</p></div><div class=footer>x</div>", "Title of it\nA paragraph of some length, with words."),
        ("<article><!-- <p>no</p> --><p>yes it is.</p><script>if (a < b) { x = '<p>' }</script></article>", "yes it is."),
        ("", ""),
        ("<p></p>", ""),
        ("<", "<"),
    ],
)
def test_main_text(html, text):
    if html == "<":
        assert main_text(html) in ("", "<")
    else:
        assert main_text(html) == text


def test_wrappers_and_titles_with_boilerplate_words():
    body = [f"{prose(60 + i, 40)}." for i in range(4)]
    text = "".join(f"<p>{x}</p>" for x in body)
    aside = "<div class=sidebar><p>Popular posts of the week</p></div><div class='post-comments'><p>I like it.</p></div>"
    for inner, first in ((f"<article><h1>Title</h1>{text}</article>", "Title"), (f"<div><h1>Title</h1>{text}</div>", "Title")):
        for wrapper in ("page with-sidebar", "has-header", "layout menu-left"):
            for page in (f"<div class='{wrapper}'>{inner}{aside}</div>", f"<div id=menu-page><div class='{wrapper}'>{inner}</div>{aside}</div>"):
                assert main_text(f"<body>{page}</body>").split("\n") == [first, *body]
    titled = f"<article><div class='article-header'><h1>Title</h1></div>{text}</article>"
    assert main_text(titled).split("\n") == ["Title", *body]
    # sections that only look like a wrapper: teasers in article elements, comments longer than the article, a hidden copy
    teasers = "<div class=related>" + f"<article><p>{prose(70, 60)}.</p></article>" * 3 + "</div>"
    assert main_text(f"<article>{text}</article>{teasers}").split("\n") == body
    comments = f"<article>{text}</article><div class=comments>" + f"<article><p>{prose(71, 300)}.</p></article>" * 3 + "</div>"
    assert main_text(comments).split("\n") == body
    assert main_text(f"<div hidden class=menu><article>{text}</article></div><p>Visible text, a few words.</p>") == "Visible text, a few words."
    assert main_text("<div class=menu>" * 20000 + f"<article>{text}</article>").split("\n") == body


def test_text_outside_the_article():
    body = [f"{prose(30 + i, 40)}." for i in range(6)]
    page = "<article><p>A short lead of the text.</p></article><div>" + "".join(f"<p>{x}</p>" for x in body) + "</div><footer>Imprint of it all</footer>"
    assert main_text(page).split("\n") == ["A short lead of the text.", *body]
    whole = "<article>" + "".join(f"<p>{x}</p>" for x in body) + "</article><div><p>" + prose(50, 40) + ".</p></div>"
    assert main_text(whole).split("\n") == body


@pytest.mark.parametrize("tag", ["noscript", "svg", "math", "object", "canvas", "audio", "video", "template"])
def test_elements_that_are_never_closed(tag):
    assert main_text(f"<p><{tag} class=x></p><article><p>The text of the page.</p></article>") == "The text of the page."
    assert main_text(f"<article><p>The text.</p><{tag}>no</{tag}><{tag}><p>More of the text.</p></article>") == "The text.\nMore of the text."
    assert main_text("<article><p>The text.</p><script>var x = '<p>no, it is cut off") == "The text."
    assert main_text(f"<article><p>Much of it.</p>{f'<{tag}>' * 20000}</article>") == "Much of it."


def test_pages_table_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>{prose(i, 12)}.</p>" for i in range(6000)) + "</article>"
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<article><p>é text here</p></article>"), (2, "v", long), (3, "w", "<div>" * 3000 + "deep text of it." + "</div>" * 3000)]
    got = html_extraction.extract(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = {(r.page_id, r.url): r for r in got.collect()}
    assert got.count() == 5 and out[1, "u"].text == "" and out[1, "u"].n_chars == 0
    assert out[None, None].text == "é text here" and out[None, None].n_chars == 11
    assert out[2, "v"].text.count("\n") == 5999
    assert html_extraction.extract(pages(spark).limit(0)).count() == 0


def test_license_templates_find_themselves():
    scanner = license_scan.Scanner()
    for name, _, wording in license_scan.TEMPLATES:
        for text in (wording, prose(3, 40) + "\n" + " ".join(wording.split()) + "\n" + prose(4, 40)):
            found = scanner.scan(text)[1]
            assert name in {f[1] for f in found}, (name, text)
            assert all(f[3] + f[4] == 0 for f in found if f[1] == name), found


def test_license_wording_decides():
    scanner = license_scan.Scanner()
    names = lambda t: [f[1] for f in scanner.scan(t)[1]]
    assert names("Released under the MITX License.") == []
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0"]
    assert names("This project is released under the MIT licence") == ["MIT"]
    assert names("You need a driving license to drive a car in mit") == []
    assert scanner.scan(prose(5, 100)) == (0, [])
    long = " ".join([prose(6, 3000), "Licensed under the Apache License, Version 2.0.", prose(7, 3000)])
    assert names(long) in (["Apache-2.0"], [])


def test_license_notices_in_long_lines():
    scanner = license_scan.Scanner()
    names = lambda t: [f[1] for f in scanner.scan(t)[1]]
    long = " ".join([prose(6, 3000), "Licensed under the Apache License, Version 2.0.", prose(7, 3000)])
    assert names(long) == ["Apache-2.0"]
    for name, _, wording in license_scan.TEMPLATES:
        for before, after in ((200, 0), (1500, 0), (0, 1500), (9000, 300)):
            assert name in names(" ".join([prose(8, before), " ".join(wording.split()), prose(9, after)])), (name, before, after)


BOTH = "\n\n".join(" ".join(license_scan.TEMPLATES[i][2].split()) for i in (2, 4))


@pytest.mark.parametrize(
    "text, licenses",
    [
        ("SPDX-License-Identifier: MIT OR Apache-2.0", {"MIT", "Apache-2.0"}),
        ("// SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0 OR Zlib) AND BSD-3-Clause", {"GPL-2.0-or-later", "BSD-3-Clause"}),
        ("# SPDX-License-Identifier: GPL-3.0-only", {"GPL-3.0-only"}),
        ("SPDX-License-Identifier: LGPL-2.1-or-later\nSPDX-License-Identifier: MIT", {"LGPL-2.1-or-later", "MIT"}),
        ("Dual-licensed under the MIT license or the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        ("Licensed under the Apache License, Version 2.0, and the MIT license.", {"MIT", "Apache-2.0"}),
        ("Licensed under the MIT license, the ISC License or the BSD 2-Clause License.", {"MIT", "ISC", "BSD-2-Clause"}),
        ("Released under the MIT License. Apache License, Version 2.0 is another.", {"MIT"}),
        ("SPDX-License-Identifier: MIT\nor Apache-2.0, who knows", {"MIT"}),
        (BOTH, {"MIT", "ISC"}),
        (BOTH.replace("\n", " "), {"MIT", "ISC"}),
        (" ".join(f"Licensed under the {x} License." for x in ("MIT", "ISC", "BSD 2-Clause", "BSD 3-Clause")) + " Licensed under the Apache License, Version 2.0. Licensed under the Mozilla Public License, version 2.0. Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.",
         {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0"}),
    ],
)
def test_license_every_notice_of_a_block(text, licenses):
    scanner = license_scan.Scanner()
    assert {f[1] for f in scanner.scan(text)[1]} == licenses
    assert {f[1] for f in scanner.scan(prose(8, 200) + " " + text + " " + prose(9, 200))[1]} == licenses


def test_license_table(spark):
    got = license_scan.scan_licenses(frame(spark))
    rows = got.collect()
    assert len(rows) == len(DOCS)
    assert {r.doc_id: r.licenses for r in rows if r.n_findings} == {16: "MIT"}
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def test_license_notices_are_counted_once_at_their_lines():
    """A one-line notice stands in its line's block and in the run around it: one finding, at its own line."""
    scanner = license_scan.Scanner()
    notice = "Released under the MIT License."
    for before in range(6):
        lines = [f"a{i} b{i}" for i in range(before)] + [notice, "d"]
        n, found = scanner.scan("\n".join(lines))
        assert [(f[0], f[1]) for f in found] == [(before, "MIT")] and n == 2
    # two notices of one license in a run, of two licenses in a run, far apart, and after letters that grow when lowered
    two = ["İİİ", notice, "x y z", "w", notice, "v", "Licensed under the Apache License, Version 2.0.", *(["far away"] * 40), notice]
    assert [(f[0], f[1]) for f in scanner.scan("\n".join(two))[1]] == [(1, "MIT"), (4, "MIT"), (6, "Apache-2.0"), (47, "MIT")]
    # a notice over two lines is found by its run only
    assert [(f[0], f[1]) for f in scanner.scan("q r\nReleased under the\nMIT License.\ns t")[1]][:1] == [(1, "MIT")]
