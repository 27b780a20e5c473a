"""Byte-pair encoding and decoding with a pair occurrence index (operator 7).

A tokenizer file (JSON, byte-level BPE) is a parameter; its tables, bounded by the
vocabulary, are broadcast. Texts stay in their partitions: nothing is shuffled.

In a task, texts are taken in blocks of about ``BLOCK_BYTES``. The block's distinct words
(pre-tokens) that are not known yet are laid out as one array of symbols with links to the
neighbours. An index maps each mergeable pair to all its positions. The active ranks are
applied in ascending order; each merge updates the lists of the pairs beside it. A pair that
a merge makes has a higher rank than that merge (checked when the file is read), so one
ascending pass gives what merging word by word gives. Words are recognised by a 64-bit hash;
every text is decoded from its ids and compared with the input, and a text that differed (two
words with one hash) would be encoded again word by word.

Null texts are empty and have no tokens. A text of any length is processed whole. Repeated rows
and ids each give their row. Special tokens in a text get their own id, as in the library's default.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm import textblocks as tb
from riskline.llm.textblocks import chunks, run_starts, text_buffers

BLOCK_BYTES = 16 << 20
CHUNK_BYTES = 1 << 20
#: Words that a task remembers between blocks; beyond it starts anew (the results are the same).
KNOWN_WORDS = 400_000

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
_U = np.uint64


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_tokenizer(path: str) -> dict:
    """Tables of a byte-level BPE file: per token its bytes, per byte its id, per rank left, right and merged id, special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = spec["pre_tokenizer"] or {}
    if spec["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: only byte-level BPE without prefix space and normalizer")
    letters = byte_letters()
    vocab = spec["model"]["vocab"]
    of_text = {t: i for t, i in vocab.items()}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = max([*vocab.values(), *special.values()]) + 1
    token = [b""] * size
    for t, i in vocab.items():
        token[i] = bytes(letters[c] for c in t)
    for t, i in special.items():
        token[i] = t.encode()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    left, right = (np.array([of_text[m[k]] for m in merges], np.int64) for k in (0, 1))
    made = np.array([of_text["".join(m)] for m in merges], np.int64)
    rank_of = np.full(size, -1, np.int64)
    rank_of[made] = np.arange(len(made))
    if (np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(made))).any():
        raise ValueError(f"{path}: a merge uses a token that a later merge makes")
    byte_id = np.array([of_text[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
    return {"token": token, "byte_id": byte_id, "left": left, "right": right, "made": made, "special": special}


# Letters (1) and numbers (2) of Unicode 16.0 that the character database of Python 3.13 (15.1) lacks.
UNICODE_16 = [
    (0x1C89, 0x1C8A, 1), (0xA7CB, 0xA7CD, 1), (0xA7DA, 0xA7DC, 1), (0x105C0, 0x105F3, 1), (0x10D40, 0x10D49, 2),
    (0x10D4A, 0x10D65, 1), (0x10D6F, 0x10D85, 1), (0x10EC2, 0x10EC4, 1), (0x11380, 0x11389, 1), (0x1138B, 0x1138B, 1),
    (0x1138E, 0x1138E, 1), (0x11390, 0x113B5, 1), (0x113B7, 0x113B7, 1), (0x113D1, 0x113D1, 1), (0x113D3, 0x113D3, 1),
    (0x116D0, 0x116E3, 2), (0x11BC0, 0x11BE0, 1), (0x11BF0, 0x11BF9, 2), (0x13460, 0x143FA, 1), (0x16100, 0x1611D, 1),
    (0x16130, 0x16139, 2), (0x16D40, 0x16D6C, 1), (0x16D70, 0x16D79, 2), (0x18CFF, 0x18CFF, 1), (0x1CCF0, 0x1CCF9, 2),
    (0x1E5D0, 0x1E5ED, 1), (0x1E5F0, 0x1E5F0, 1), (0x1E5F1, 0x1E5FA, 2),
]


def letter_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space, or other."""
    first = {"L": _LETTER, "N": _NUMBER, "Z": _SPACE}
    out = np.fromiter((first.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[[*range(0x09, 0x0E), 0x85]] = _SPACE
    for a, b, kind in UNICODE_16:
        out[a : b + 1] = kind
    return out


def word_starts(point: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the words (pre-tokens) of a run of code points begin. ``first``: the starts of the texts.

    A word is one contraction, or letters, numbers or other signs with one space before them if
    there is one; of other white space before a word the last character stands alone.
    """
    n = len(point)
    begin = np.zeros(n + 1, bool)
    begin[first] = True
    begin[n] = True
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[begin[:n]] = 255
    follows = np.empty(n, np.uint8)
    follows[:-1] = kind[1:]
    follows[begin[1:]] = 255
    space = kind == _SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = point[:-1] == 0x20
    after_blank &= before != 255
    start = np.where(space, (before != _SPACE) | ((follows != _SPACE) & (follows != 255)), (before != kind) & ~after_blank)
    quote = np.flatnonzero((point == 0x27) & start & (follows == _LETTER))
    if len(quote):
        end = np.append(first, n)[np.searchsorted(first, quote, "right")]  # of the quote's text
        one = point[quote + 1]
        two = np.where(quote + 2 < end, point[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        length = np.where(short, 1, np.where(long, 2, 0))
        quote, end, length = quote[length > 0], end[length > 0], length[length > 0]
        start[quote + 1] = False
        rest = quote + 1 + length
        rest = rest[rest < end]
        start[rest[kind[rest] == _LETTER]] = True
    return np.flatnonzero(start)


def laid_out(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte strings end to end, with the start and length of each."""
    count = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(count) - count, count


def gathered(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices of runs that begin at ``first`` and are ``count`` long, one after the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - count), count) + np.arange(total)


class Encoder:
    """Encodes blocks of texts; remembers the words it has met."""

    def __init__(self, tables: dict, known_words: int = KNOWN_WORDS):
        self.t, self.limit = tables, known_words
        size = len(tables["token"])
        self.size = size
        code = tables["left"] * size + tables["right"]
        self.pair_code = np.append(code, -1)
        self.by_code = np.argsort(code, kind="stable")
        self.codes = code[self.by_code]
        self.slots = np.full(1 << max(16, (8 * len(code)).bit_length()), -1, np.int64)
        slot = (code * 0x9E3779B1 >> 7) & (len(self.slots) - 1)
        self.slots[slot] = np.arange(len(code))
        self.full = np.zeros(len(self.slots), bool)
        self.full[slot[self.slots[slot] != np.arange(len(code))]] = True
        self.token_bytes, self.token_first, self.token_count = laid_out(tables["token"])
        self.digits, self.digit_first, self.digit_count = laid_out([b"%d," % i for i in range(size)])
        self.kind = letter_classes()
        self.special = sorted(tables["special"].items())
        self.forget()

    def forget(self) -> None:
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.first, self.count = (np.zeros(0, np.int64) for _ in range(3))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it has none (a hash table; the rare pairs of full slots are searched)."""
        code = left * self.size + right
        slot = (code * 0x9E3779B1 >> 7) & (len(self.slots) - 1)
        i = self.slots[slot]
        rank = np.where((i >= 0) & (self.pair_code[i] == code), i, -1)
        rest = np.flatnonzero((rank < 0) & self.full[slot])
        if len(rest):
            j = np.minimum(np.searchsorted(self.codes, code[rest]), len(self.codes) - 1)
            rank[rest] = np.where(self.codes[j] == code[rest], self.by_code[j], -1)
        return rank

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words laid end to end in ``data``, and how many each word has."""
        sym = self.t["byte_id"][data]
        n, ends = len(sym), np.cumsum(lengths)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        index: dict[int, list[np.ndarray]] = {}
        few = len(self.codes) <= 1 << 16  # ranks of 16 bits sort faster

        def note(at: np.ndarray) -> list[int]:
            """Add the pairs that begin at these places to the index; the ranks that are new in it."""
            rank = self.ranks(sym[at], sym[after[at]])
            some = rank >= 0
            at, rank = at[some], rank[some]
            if not len(at):
                return []
            order = np.argsort(rank.astype(np.uint16) if few else rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = run_starts(rank)
            fresh = []
            for r, part in zip(rank[cuts].tolist(), np.split(at, cuts[1:]) if len(cuts) > 1 else (at,), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    fresh.append(r)
            return fresh

        active = note(np.flatnonzero(after >= 0))
        heapq.heapify(active)
        left, right, made = self.t["left"].tolist(), self.t["right"].tolist(), self.t["made"].tolist()
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            to = after[at]
            live = (sym[at] == left[r]) & (to >= 0) & (sym[to] == right[r])
            at, to = at[live], to[live]
            if not len(at):
                continue
            if left[r] == right[r]:  # of a chain of equal symbols every second pair, from the left
                at = np.unique(at)
                linked = np.zeros(len(at), bool)
                linked[1:] = at[1:] == after[at[:-1]]
                head = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - head) % 2 == 0]
                to = after[at]
            sym[at] = made[r]
            sym[to] = -2
            far = after[to]
            after[at] = far
            inner = far >= 0
            before[far[inner]] = at[inner]
            back = before[at]
            for x in note(np.concatenate([at[inner], back[back >= 0]])):
                heapq.heappush(active, x)
        kept = sym >= 0
        total = np.append(0, np.cumsum(kept))
        return sym[kept], total[ends] - total[ends - lengths]

    def learn(self, hashes: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
        """Encode words (laid end to end in ``data``) and remember them under their hashes."""
        ids, count = self.merge(data, lengths)
        self.remember(hashes, ids, count)

    def remember(self, hashes: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        place = np.append(self.place, len(self.count) + np.arange(len(count)))
        self.first = np.append(self.first, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.ids = np.append(self.ids, ids)
        every = np.append(self.hashes, hashes)
        order = np.argsort(every, kind="stable")
        self.hashes, self.place = every[order], place[order]

    def special_parts(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, id) of the special tokens in the bytes, the earliest first."""
        out, at = [], 0
        while True:
            found = [(text.find(s.encode(), at), -len(s), i, s) for s, i in self.special]
            found = [f for f in found if f[0] >= 0]
            if not found:
                return out
            start, _, i, s = min(found)
            at = start + len(s.encode())
            out.append((start, at, i))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, int]]:
        """Byte starts, ends and hashes of the words of a chunk, and the id of each word that is a special token."""
        raw = data.tobytes()
        cuts, own = offsets[:-1], {}
        if any(s.encode() in raw for s, _ in self.special):
            extra = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for s, e, i in self.special_parts(raw[a:b]):
                    extra += [a + s, a + e]
                    own[a + s] = (a + e, i)
            cuts = np.unique(np.concatenate([cuts, np.array(extra, np.int64)]))
        point = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # where each code point begins
        if len(at) != len(point):
            raise ValueError("a text is not valid UTF-8")
        cuts = np.unique(cuts[cuts < len(data)])
        start = at[word_starts(point, self.kind[point], np.searchsorted(at, cuts))]
        for a, (b, _) in own.items():  # a special token is one word
            start = start[(start <= a) | (start >= b)]
        end = np.append(start[1:], len(data))
        power, inverse = tb._grow(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(tb._BYTE[data] * power[: len(data)], out=total[1:])
        h = tb.mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
        special = {int(np.searchsorted(start, a)): i for a, (_, i) in own.items()}
        for w, i in special.items():
            h[w] = tb.mix(np.array([i], np.uint64) ^ _U(0xA5A5A5A5A5A5A5A5))[0]
        return start, end, h, special

    def block(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        """(ids, the same as decimal text joined by commas, decoded bytes) of each text of a block."""
        if len(self.count) > self.limit:
            self.forget()
        pieces, news = [], []
        for a, b in chunks(offsets, CHUNK_BYTES):
            part, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            if not len(part):
                pieces.append((o, *(np.zeros(0, np.int64) for _ in range(3)), part))
                continue
            start, end, h, special = self.words(part, o)
            if special:
                ids, at = np.unique(np.array(list(special.values())), return_index=True)
                at = np.array(list(special))[at]
                fresh = ~self.knows(h[at])
                self.remember(h[at][fresh], ids[fresh], np.ones(int(fresh.sum()), np.int64))
            distinct, where, which = np.unique(h, return_index=True, return_inverse=True)
            pieces.append((o, start, distinct, which, part))
            where = where[~self.knows(distinct)]
            news.append((h[where], start[where] + offsets[a], (end - start)[where]))
        if news:
            h, start, length = (np.concatenate(x) for x in zip(*news, strict=True))
            h, at = np.unique(h, return_index=True)
            if len(h):
                start, length = start[at], length[at]
                self.learn(h, data[gathered(start, length)], length)
        for o, start, distinct, which, part in pieces:
            place = self.place[np.searchsorted(self.hashes, distinct)][which] if len(distinct) else which
            n_ids = self.count[place]
            ids = self.ids[gathered(self.first[place], n_ids)]
            decoded = self.token_bytes[gathered(self.token_first[ids], self.token_count[ids])].tobytes()
            digit_count = self.digit_count[ids]
            written = self.digits[gathered(self.digit_first[ids], digit_count)].tobytes()
            of_text = np.append(0, np.cumsum(n_ids))[np.searchsorted(start, o)]
            digit_at = np.append(0, np.cumsum(digit_count))[of_text].tolist()
            decode_at = np.append(0, np.cumsum(self.token_count[ids]))[of_text].tolist()
            raw, of_text, o = part.tobytes(), of_text.tolist(), o.tolist()
            for d in range(len(o) - 1):
                own, text = ids[of_text[d] : of_text[d + 1]], decoded[decode_at[d] : decode_at[d + 1]]
                numbers = written[digit_at[d] : max(digit_at[d], digit_at[d + 1] - 1)]
                if text != raw[o[d] : o[d + 1]]:
                    own = self.one(raw[o[d] : o[d + 1]])
                    text, numbers = b"".join(self.t["token"][i] for i in own), b",".join(b"%d" % i for i in own)
                yield own, numbers, text

    def one(self, text: bytes) -> np.ndarray:
        """A text's ids, each word merged on its own (no hashes)."""
        data = np.frombuffer(text, np.uint8)
        start, end, _, special = self.words(data, np.array([0, len(data)]))
        ids, count = self.merge(data, end - start)
        own, at = [], np.cumsum(count) - count
        for w, (a, c) in enumerate(zip(at.tolist(), count.tolist(), strict=True)):
            own += [special[w]] if w in special else ids[a : a + c].tolist()
        return np.array(own, np.int64)

    def knows(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)] == h


def _tasks(df: DataFrame, tables, columns, schema: str) -> DataFrame:
    def run(batches):
        encoder = Encoder(tables.value)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for a, b in chunks(offsets, BLOCK_BYTES):
                done = encoder.block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns(done)], names=names)

    names = [c.split(" ")[0] for c in schema.split(", ")]
    return df.mapInArrow(run, schema)


def _source(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    df = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return df, df.schema["doc_id"].dataType.simpleString()


def encode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) and the decoded text of each row."""
    df, kind = _source(df, id_col, text_col)
    tables = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def columns(done):
        ids, decoded = [], []
        for i, _, d in done:
            ids.append(i)
            decoded.append(d.decode("utf-8", "replace"))
        return pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())

    return _tasks(df, tables, columns, f"doc_id {kind}, ids array<int>, decoded string")


def digests(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids joined by commas, and of the decoded text."""
    df, kind = _source(df, id_col, text_col)
    tables = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def columns(done):
        n, ids, text = [], [], []
        for own, numbers, decoded in done:
            n.append(len(own))
            ids.append(hashlib.sha256(numbers).hexdigest())
            text.append(hashlib.sha256(decoded).hexdigest())
        return pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())

    return _tasks(df, tables, columns, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """The rows with the text of their ids (null ids: an empty text)."""
    token = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path)["token"])
    column = df.schema.fieldNames().index(ids_col)

    def run(batches):
        for batch in batches:
            texts = [b"".join(token.value[i] for i in ids or ()).decode("utf-8", "replace") for ids in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{to}` string")
