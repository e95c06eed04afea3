import random
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import documents, prose

from paylode.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.build(bpe.read_ranks(PATH)), public_tokenizers.PATTERN)


def texts():
    rng = random.Random(5)
    kinds = ["abcXYZ  \t\n'", "0123456789 .,;:!?", "äöüßéèñ ", "日本語漢字かな", "🙂👩‍👩‍👧‍👦🇩🇪", "\u00a0\u2003\u3000\x85\x1c\x1f\u200b ", "'s't're'll"]
    out = ["", " ", "<|endoftext|> is text", "I'll we've DON'T", "x" * 5000, "\n" * 700, " " * 50 + "a", prose(1, 3000), "a\r\n\r\n b  "]
    out += ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 200))) for _ in range(300)]
    out += ["".join(chr(c) for c in (rng.randrange(0x20, sys.maxunicode) for _ in range(60)) if not 0xD800 <= c < 0xE000)
            for _ in range(200)]
    return out


def test_ids_are_those_of_the_library_of_ranks(encoder, reference):
    some = texts()
    for text, ids in zip(some, encoder.encode(some)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text[:80])


def test_every_character_alone_and_between_letters(encoder, reference):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    some = ["".join(f"a{c} {c}{c}1" for c in chars[k:k + 64]) for k in range(0, len(chars), 64)]
    bad = [t for t, ids in zip(some, encoder.encode(some)) if np.frombuffer(ids, "<u4").tolist() != reference.encode_ordinary(t)]
    assert not bad


def test_round_trip_in_spark(spark, encoder):
    some = [*texts(), None]
    df = documents(spark, list(enumerate(some)), extra=True)
    coded = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    expected = dict(enumerate(encoder.encode(["" if t is None else t for t in some])))
    rows = bpe.decode(coded, PATH).collect()
    assert len(rows) == len(some)
    for r in rows:
        assert bytes(r.ids) == expected[r.doc_id] and bytes(r.decoded).decode() == (some[r.doc_id] or "")
    assert bpe.decode(bpe.encode(documents(spark, []), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_offsets_cover_the_characters(spark):
    text = "naïve 日本🙂 x"
    coded = bpe.encode(documents(spark, [(1, text), (2, None)]), PATH, public_tokenizers.PATTERN)
    rows = sorted(bpe.token_offsets(coded, PATH).collect(), key=lambda r: r.position)
    table = bpe.token_bytes(bpe.read_ranks(PATH))
    at, starts, ends = 0, [], []
    byte_char = [i for i, c in enumerate(text) for _ in c.encode()]
    for r in rows:
        starts.append(byte_char[at])
        at += len(table[r.id])
        ends.append(byte_char[at - 1] + 1)
    assert [r.start_char for r in rows] == starts and [r.end_char for r in rows] == ends
    assert any(a.end_char > b.start_char for a, b in zip(rows, rows[1:]))  # a character of several tokens


def test_the_cache_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 10)
    before = encoder.encode(["some words that fill it", prose(3, 200)])
    assert encoder.encode(["some words that fill it", prose(3, 200)]) == before
    assert len(encoder.cache) < 500
