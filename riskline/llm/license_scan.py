"""License scans by conditional compression (operator 1).

Candidate blocks are the lines of a text with a word that license notices use (found by Spark before any Python
runs), and runs of such lines with their neighbours. For each template, a block is cut into windows of ``WIDTH`` template lengths,
each half over the next, and every window that holds the words naming the license is compressed alone and with the template as a raw
zstandard dictionary, with equal parameters. Every template that saves at least ``LEAST_SHARE`` of the window or of the
template is looked at, and is found if its wording confirms it: the template's words are aligned with the window's, and the words
that differ are counted exactly. All words that name the license must be there, and the differences may be ``MOST_DIFFERENT`` of the
template's words at most. Of findings that overlap, the one that saves most bytes counts; its words are taken out, and the rest
of the block is scanned again until nothing is found.

Texts stay in their partitions; only texts with a candidate line are sent to Python. Null and empty texts have no
block. Repeated rows and ids each give their row. A text of any length is read whole; as windows are bounded, a notice is
found wherever it is in a line, and the work is linear in the text's length. What is compressed are the words as they are compared.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from difflib import SequenceMatcher
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_SHARE, MOST_DIFFERENT, LEVEL = 0.2, 0.25, 3
#: Words of a window: so many template lengths, and at least so many. Characters of a word that are compressed.
WIDTH, LEAST_WIDTH, LONGEST = 4, 16, 40
#: Words of a template whose lead may stand before several licenses.
SHORT = 14
#: Bytes for which the compression parameters are chosen, of a window and of a dictionary.
PARAMETERS_FOR = 4096
AROUND = 2
TAG = "spdx-license-identifier"

# What makes a line a candidate (lower case).
TRIGGERS = (
    "licen", "copyright", "spdx", "warrant", "redistribut", "public domain", "creative commons", "cc by", "cc-by", "cc0",
    "permission is hereby", "permission to use", "all rights reserved", "gnu ", "mozilla public",
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies."""
_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_BSD3 = _BSD2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software
Foundation, either version {version} of the License, or (at your option) any later version."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
You can obtain one at http://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell,
or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
_CC = "This work is licensed under a Creative Commons {name} {version} International License."

#: Fixed values: (license, words that name it, wording). The names must all be in a block.
TEMPLATES: list[tuple[str, str, str]] = [
    ("MIT", "mit", "Released under the MIT License."),
    ("MIT", "mit", "Licensed under the MIT license."),
    ("MIT", "permission hereby granted charge sublicense", _MIT),
    ("ISC", "isc", "Licensed under the ISC License."),
    ("ISC", "permission use copy modify distribute fee", _ISC),
    ("BSD-2-Clause", "bsd 2-clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "bsd 3-clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "redistribution source binary reproduce", _BSD2),
    ("BSD-3-Clause", "redistribution source binary endorse promote", _BSD3),
    ("Apache-2.0", "apache 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0", _APACHE),
    ("GPL-2.0", "gnu general 2", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "gnu general 3", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "gnu general 2", _GPL.format(name="General Public License", version=2)),
    ("GPL-3.0", "gnu general 3", _GPL.format(name="General Public License", version=3)),
    ("LGPL-2.1", "gnu lesser 2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "gnu lesser 3", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "gnu affero 3", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "gnu affero 3", _GPL.format(name="Affero General Public License", version=3)),
    ("MPL-2.0", "mozilla 2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "mozilla 2.0", _MPL),
    ("Unlicense", "unencumbered public domain", _UNLICENSE),
    ("CC0-1.0", "cc0", "Released under CC0 1.0."),
    ("CC0-1.0", "creative commons zero", "Dedicated to the public domain under Creative Commons Zero 1.0."),
    ("CC-BY-4.0", "cc by 4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by-sa 4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "cc by-nc 4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "cc by-nd 4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "cc by-nc-sa 4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "cc by-nc-nd 4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "creative commons attribution 4.0", _CC.format(name="Attribution", version="4.0")),
    ("CC-BY-SA-4.0", "creative commons attribution-sharealike 4.0", _CC.format(name="Attribution-ShareAlike", version="4.0")),
    ("CC-BY-NC-4.0", "creative commons attribution-noncommercial 4.0", _CC.format(name="Attribution-NonCommercial", version="4.0")),
]

TEMPLATES += [("All-Rights-Reserved", "all rights reserved", "All rights reserved.")]
_NAMES = sorted({t[0] for t in TEMPLATES} - {"All-Rights-Reserved"})
_NAMES += [f"{name}-{which}" for name in _NAMES if "GPL" in name for which in ("only", "or-later")]
TEMPLATES += [(name, f"{TAG} {name.lower()}", f"SPDX-License-Identifier: {name}") for name in _NAMES]

_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
#: What stands between the licenses of a list: signs between words, and words.
_LIST_SIGN = re.compile(r"[^.;:!?\n]*[,/|&+][^.;:!?\n]*")
_LIST_WORDS, _FILLERS = {"or", "and"}, {"the", "a", "an", "either", "both", "under"}


def lowered(text: str) -> str:
    return text.lower().replace("licence", "license")


def listed_words(text: str) -> tuple[list[str], list[bool], list[int]]:
    """The words of a text, whether a sign of a list (comma, slash) stands before each, and where in the lowered text each
    starts. The licenses of an SPDX expression each get the tag, without operators, exceptions and brackets."""
    low = lowered(text)
    out, signs, places, last, state = [], [], [], 0, ""
    for m in _WORD.finditer(low):
        word, gap, last = m[0], low[last : m.start()], m.end()
        if word == TAG:
            state = "tag"
        elif state == "tag":
            state = "license"
            word += "-or-later" if low[m.end() : m.end() + 1] == "+" else ""
        elif state and "\n" not in gap and word in ("or", "and", "with"):
            state = "exception" if word == "with" else "again"
            continue
        elif state == "exception":
            state = "license"
            continue
        elif state == "again":
            out.append(TAG)
            signs.append(False)
            places.append(m.start())
            state = "license"
            word += "-or-later" if low[m.end() : m.end() + 1] == "+" else ""
        else:
            state = ""
        out.append(word)
        signs.append(bool(_LIST_SIGN.fullmatch(gap)))
        places.append(m.start())
    return out, signs, places


def words(text: str) -> list[str]:
    return listed_words(text)[0]


def _bytes(block: list[str]) -> bytes:
    """What is compressed: the words, without more than ``LONGEST`` characters of any."""
    return " ".join(w[:LONGEST] for w in block).encode()


def is_candidate(text: Column) -> Column:
    low = F.lower(text)
    out = F.contains(low, F.lit(TRIGGERS[0]))
    for t in TRIGGERS[1:]:
        out |= F.contains(low, F.lit(t))
    return out


def blocks_of(text: str) -> list[tuple[int, str]]:
    """(first line, block): each candidate line, and each run of them with the ``AROUND`` lines before, between and after."""
    out, runs, lines = [], [], text.split("\n")
    for i, line in enumerate(lines):
        low = line.lower()
        if any(t in low for t in TRIGGERS):
            out.append((i, line))
            if runs and i - runs[-1][1] <= 2 * AROUND + 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
    for a, b in runs:
        first, last = max(0, a - AROUND), min(len(lines), b + AROUND + 1)
        if last - first > 1:
            out.append((first, "\n".join(lines[first:last])))
    return out


class Scanner:
    def __init__(self, templates: list[tuple[str, str, str]] = TEMPLATES):
        self.templates = []
        for name, keys, wording in templates:
            own = words(wording)
            raw = _bytes(own)
            # the same parameters with and without the dictionary, as zstandard would choose others by size; and a search
            # of every position, as this level's own search skips some and its noise is larger than what short notices save
            size = {"source_size": PARAMETERS_FOR, "dict_size": PARAMETERS_FOR}
            same = zstandard.ZstdCompressionParameters.from_level(LEVEL, strategy=zstandard.STRATEGY_BTOPT, min_match=4, **size)
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, set(keys.split()), own, len(raw), zstandard.ZstdCompressor(compression_params=same, dict_data=dictionary)))
            self.alone = zstandard.ZstdCompressor(compression_params=same)

    def windows(self, block: list[str], places: dict[str, list[int]], template: int) -> list[tuple[int, int]]:
        """The overlapping spans of a block, ``WIDTH`` template lengths wide, that hold all words naming the template."""
        keys, own = self.templates[template][1:3]
        if not keys <= places.keys():
            return []
        width = max(LEAST_WIDTH, WIDTH * len(own))
        step = width // 2
        rarest = min(keys, key=lambda k: len(places[k]))
        starts = {max(0, at // step - back) * step for at in places[rarest] for back in (0, 1)}
        spans = [(x, min(x + width, len(block))) for x in sorted(starts)]
        return [(x, y) for x, y in spans if keys <= set(block[x:y])]

    def ranked(self, block: list[str]) -> list[tuple[int, int, int, int]]:
        """(bytes saved, template, first word, end) of the windows in which a template saves enough, the best first."""
        places: dict[str, list[int]] = {}
        for at, word in enumerate(block):
            places.setdefault(word, []).append(at)
        out, sizes = [], {}
        for i, (_, _, _, length, with_it) in enumerate(self.templates):
            for x, y in self.windows(block, places, i):
                raw = _bytes(block[x:y])
                if (x, y) not in sizes:
                    sizes[x, y] = len(self.alone.compress(raw))
                saved = sizes[x, y] - len(with_it.compress(raw))
                if saved >= LEAST_SHARE * min(len(raw), length):
                    out.append((saved, i, x, y))
        return sorted(out, key=lambda x: (-x[0], *x[1:]))

    def wording(self, block: list[str], template: int) -> tuple[int, int, int, int] | None:
        """(missing, added) words of the template against its best place in the window, and that place; None if a naming word is missing."""
        _, keys, own, _, _ = self.templates[template]
        met = [m for m in SequenceMatcher(None, own, block, autojunk=False).get_matching_blocks() if m.size]
        best = None
        for i in range(len(met)):
            equal = 0
            for m in met[i:]:
                equal += m.size
                start, end = met[i].b, m.b + m.size
                found = (len(own) - equal, end - start - equal, start, end)
                if (best is None or found[0] + found[1] < best[0] + best[1]) and keys <= set(block[start:end]):
                    best = found
        return best

    def confirmed(self, block: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """(bytes saved, template, words missing, words added, first word, end) of every window whose wording confirms it, the best first."""
        out = []
        for saved, i, x, y in self.ranked(block):
            differs = self.wording(block[x:y], i)
            if differs and differs[0] + differs[1] <= MOST_DIFFERENT * len(self.templates[i][2]):
                out.append((saved, i, *differs[:2], x + differs[2], x + differs[3]))
        return out

    def lead(self, template: int, span: list[str]) -> list[str]:
        """The words of a short notice before those that name the license."""
        _, keys, own, _, _ = self.templates[template]
        at = min(span.index(k) for k in keys)
        return span[:at] if len(own) <= SHORT else []

    def notices(self, block: list[str], signs: list[bool], places: list[int]) -> list[tuple[str, int, int, int, int, int]]:
        """(license, bytes saved, words missing, words added, place of the first word, of the last) of all notices in a block:
        those confirmed that do not overlap a better one are taken out, until none is left. Where a list goes on after one ("...
        or the ..."), its lead stands before the rest (at no place of its own)."""
        out, open_parts = [], [(block, signs, places)]
        while open_parts:
            block, signs, places = open_parts.pop()
            taken: list[tuple[int, int, int]] = []
            for saved, i, missing, added, start, end in self.confirmed(block):
                if all(end <= x or start >= y for x, y, _ in taken):
                    taken.append((start, end, i))
                    at = [p for p in places[start:end] if p >= 0]
                    out.append((self.templates[i][0], saved, missing, added, at[0], at[-1]))
            lead, rest = [], 0
            for start, end, i in [*sorted(taken), (len(block), len(block), -1)] if taken else []:
                if start > rest:
                    none = len(lead)
                    open_parts.append((lead + block[rest:start], [False] * none + signs[rest:start], [-1] * none + places[rest:start]))
                if i < 0:
                    break
                own = self.lead(i, block[start:end])
                lead, rest = own or (lead if start == rest else []), end
                goes_on = rest < len(block) and signs[rest]
                while rest < len(block) and block[rest] in _LIST_WORDS | (_FILLERS if goes_on else set()):
                    rest, goes_on = rest + 1, True
                if not goes_on:
                    lead, rest = [], end
        return out

    def scan(self, text: str) -> tuple[int, list[tuple[int, str, int, int, int]]]:
        """Number of candidate blocks; (line, license, bytes saved, words missing, words added) of the findings. A notice
        stands in the block of its own line and in that of the run around it: of findings of one license whose words overlap,
        the one that saves most counts. Its line is that of its first word."""
        blocks, found = blocks_of(text), []
        if not blocks:
            return 0, []
        ends = list(accumulate(len(lowered(line)) + 1 for line in text.split("\n")))
        for line, block in blocks:
            base = ends[line - 1] if line else 0
            for name, saved, missing, added, first, last in self.notices(*listed_words(block)):
                found.append((saved, name, missing, added, base + first, base + last))
        spans: dict[str, list[tuple[int, int]]] = {}
        out = []
        for saved, name, missing, added, first, last in sorted(found, key=lambda x: (-x[0], *x[1:])):
            own = spans.setdefault(name, [])
            if all(last < a or first > b for a, b in own):
                own.append((first, last))
                out.append((bisect_right(ends, first), name, saved, missing, added))
        return len(blocks), sorted(out)


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_blocks, n_findings, licenses`` (sorted, joined by commas), ``bytes_saved``,
    ``words_differ`` (over all findings) and ``findings`` (line, license, bytes_saved, missing, added)."""
    text = F.col(f"`{text_col}`").cast("string")
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.when(is_candidate(text), text).alias("text"))
    finding = pa.struct([("line", pa.int32()), ("license", pa.string()), ("bytes_saved", pa.int32()), ("missing", pa.int32()), ("added", pa.int32())])

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            blocks, findings = [], []
            for t in batch.column(1):
                n, found = scanner.scan(t.as_py()) if t.is_valid else (0, [])
                blocks.append(n)
                findings.append(found)
            rows = [[dict(zip(("line", "license", "bytes_saved", "missing", "added"), x, strict=True)) for x in f] for f in findings]
            columns = [
                batch.column(0),
                pa.array(blocks, pa.int64()),
                pa.array([len(f) for f in findings], pa.int64()),
                pa.array([",".join(sorted({x[1] for x in f})) for f in findings], pa.string()),
                pa.array([sum(x[2] for x in f) for f in findings], pa.int64()),
                pa.array([sum(x[3] + x[4] for x in f) for f in findings], pa.int64()),
                pa.array(rows, pa.list_(finding)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_blocks", "n_findings", "licenses", "bytes_saved", "words_differ", "findings"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_blocks long, n_findings long, licenses string, bytes_saved long, words_differ long, "
    return docs.mapInArrow(run, schema + "findings array<struct<line:int,license:string,bytes_saved:int,missing:int,added:int>>")
