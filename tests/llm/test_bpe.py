import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskline.llm import bpe
from tests.llm.samples import DOCS, empty, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def block(encoder, texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    return list(encoder.block(data, np.append(0, np.cumsum([len(r) for r in raw]))))


def compare(encoder, library, texts):
    for t, (ids, digits, decoded), e in zip(texts, block(encoder, texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids, t
        assert digits == ",".join(map(str, e.ids)).encode()
        assert decoded.decode() == library.decode(e.ids, skip_special_tokens=False) == t


def test_random_texts(library):
    encoder = bpe.Encoder(bpe.read_tokenizer(PATH))
    r = random.Random(3)
    parts = ["'s", "'t", "'re", "'ll", "'", "a", " ", "  ", "\n", "\t", "é", "1", "23", "!", "...", "<|endoftext|>", "<|endof", "漢字", "😀", "S", "\x85", "'d", "x", "re"]
    compare(encoder, library, ["".join(r.choices(parts, k=r.randint(0, 15))) for _ in range(4000)])
    compare(encoder, library, ["", "a" * 5000, " " * 700, "'s" * 60, "\n\n x", "ab" * 40_000])


def test_character_classes(library):
    encoder = bpe.Encoder(bpe.read_tokenizer(PATH))
    points = [*range(0x80, 0x3000), *range(0x10D00, 0x11400), *range(0x16000, 0x17000), *range(0x1E500, 0x1E700)]
    compare(encoder, library, [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}'s" for c in points])


def test_words_with_one_hash_are_encoded_alone(library):
    encoder = bpe.Encoder(bpe.read_tokenizer(PATH))
    original = encoder.words

    def collide(data, offsets):
        start, end, h, special = original(data, offsets)
        return start, end, np.zeros_like(h), special

    encoder.words = collide
    compare(encoder, library, ["the cat sat", "on a mat", "the cat sat"])


def test_forgetting_changes_nothing(library):
    encoder = bpe.Encoder(bpe.read_tokenizer(PATH), known_words=3)
    for texts in (["the cat sat on the mat", "a b c"], ["the dog", "<|endoftext|>the cat"], ["cat"]):
        compare(encoder, library, texts)


def test_table(spark, library):
    def expected(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    out = bpe.digests(frame(spark), PATH)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, out.collect())) == Counter((i, *expected(t)) for i, t in DOCS)
    assert bpe.digests(empty(spark), PATH).count() == 0


def test_encode_then_decode(spark):
    rows = bpe.decode(bpe.encode(frame(spark), PATH), PATH).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t or "") for i, t in DOCS)
    assert all(r.decoded == r.text for r in rows)
