"""Encoding and decoding against the tokenizers library, with its own file."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textweft.llm import bpe
from textweft.llm.bpe import Codec, Memory, decode_tokens, encode_texts

FILE = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["'s", "'LL", " ", "Σ", "ΑΣ ", "İ", "é", "é", "\xa0", "\x1c", "\x85", "​", "123", "Ⅷ", "<|endoftext|>", "<|", "\n", "ß", "가", "\U00018d82"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def own():
    return Codec(open(FILE, encoding="utf-8").read())


def both(own, text):
    entries = own.entries(text)
    return " ".join(e[0] for e in entries), " ".join(e[1] for e in entries)


def test_random_texts(own, library):
    rng = random.Random(3)
    for _ in range(4000):
        odd = [chr(rng.choice([rng.randrange(32, 127), rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(6)]
        text = "".join(rng.choices(PARTS + odd + ["abc", "Don't", "running"], k=rng.randint(0, 15)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert both(own, text) == (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))


def test_every_letter_below_the_plain_limit(own, library):
    for code in [c for c in range(1, 0x400)]:
        text = f"a{chr(code)}b1{chr(code)}"
        ids = library.encode(text, add_special_tokens=False).ids
        assert both(own, text)[0] == " ".join(map(str, ids))


def test_table(hard_docs, library):
    got = encode_texts(hard_docs, FILE, ("n_tokens", "token_ids", "decoded", "ids_sha256", "decoded_sha256"))
    rows = decode_tokens(got.withColumnRenamed("decoded", "first"), FILE).collect()
    assert len(rows) == hard_docs.count() and rows[0].fp == "own"
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.token_ids, r.first, r.decoded) == (len(ids), ids, text, text)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_unfit_file(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert encode_texts(empty, FILE).collect() == []
    with pytest.raises(ValueError):
        encode_texts(empty, public_tokenizers.path("byte_bpe_50k.json"))


def test_memory_forgets_but_never_errs():
    memory = Memory(lambda k: k * 2, 5)
    assert all(memory[k] == k * 2 for k in ["a", "b", "c", "d", "e", "f", "a", "g", "h", "i", "j", "k", "a"])
    assert len(memory) <= 5 and len(memory.older) <= 5


def test_byte_symbols_are_distinct():
    assert len(set(bpe.byte_symbols())) == 256
