import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from platewise.llm.common import pack, unpack, word_hashes
from platewise.llm.tokens import FastTokenizer


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_equal_the_library(own, docs):
    texts = [r.text for r in docs.collect()]
    fast = FastTokenizer()
    for got, text in zip(fast.ids(texts), texts):
        assert got.tolist() == own.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_strings(own):
    random.seed(5)
    alphabet = "aAbB ZzıİßΣςσ́̈é<|endoftext|>'s'll\n\t\r\x0b\x1c\x85\xa0 　\x00\x01\x02漢🙂٣½﻿​12.,;-_"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randrange(60))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "the<|startoftext|> x", " ", "a" * 3000]
    fast = FastTokenizer(remembered=500)
    for part in (texts[:1000], texts[1000:], []):
        for got, text in zip(fast.ids(part), part):
            assert got.tolist() == own.encode(text, add_special_tokens=False).ids, ascii(text)


def test_plain_chunks_are_encoded_at_once(own, monkeypatch):
    """Chunks of ASCII and Latin-1 letters take one call a batch and no entry each in the table of remembered ones."""
    fast = FastTokenizer()
    calls, encode = [], fast._encode
    monkeypatch.setattr(fast, "_encode", lambda marked: calls.append(marked) or encode(marked))
    texts = ["The d\u00f6g's  <tail>, 1234\nTHE \u00c9t\u00e9 x\u00b2", "", " ", "we'll a<|b \u0130x", "plain words only"]
    for _ in range(2):
        for got, text in zip(fast.ids(texts), texts):
            assert got.tolist() == own.encode(text, add_special_tokens=False).ids, ascii(text)
    assert sorted(fast.known) == ["a<|b", "x\u00b2", "\u0130x"] and len(calls) == 3  # twice the plain, once the others


def test_null_texts_have_no_ids():
    ids, at = FastTokenizer().flat(pa.array([None, "the dog", None]))
    assert at.tolist() == [0, 0, 2, 2] and len(ids) == 2


def test_word_hashes_follow_the_words():
    random.seed(1)
    texts = ["".join(random.choice("aB cé\t\n\x0b.") for _ in range(random.randrange(120))).encode() for _ in range(300)]
    texts += [b"", b" ", b"x" * 1000, b"x" * 1001]
    h, n, joined, starts, ends = word_hashes(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert n.tolist() == [len(t.split()) for t in texts]
    assert [joined[a:b] for a, b in zip(starts, ends)] == words
    assert len(set(h.tolist())) == len(set(words)) == len(set(zip(h.tolist(), words)))


def test_pack_round_trip():
    for a in (np.arange(1000, dtype=np.uint64), np.zeros(0, np.int64), np.array([3, 1], np.uint32)):
        assert unpack(pack(a), a.dtype).tolist() == a.tolist()
