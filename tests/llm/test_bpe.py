from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmart.llm.bpe import Encoder, Vocabulary, merge_piece, token_digests, tokenized
from tripmart.llm.queries import vocabulary_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def published():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def texts(n):
    draw = random.Random(6)
    pool = [chr(c) for c in (*range(0, 0x250), *range(0x370, 0x400), *range(0x2000, 0x2070), *range(0x4E00, 0x4E20), 0x1F600, 0x3000, 0xFEFF)]
    pool += ["'s", "'ll", " ", "  ", "\n", " \n", "<|endoftext|>", "<|endof", "aaaa", " the ", "123"]
    return ["".join(draw.choices(pool, k=draw.randrange(14))) for _ in range(n)]


def test_encodes_and_decodes_as_published(published):
    encoder = Encoder(Vocabulary.read(PATH))
    for batch in (texts(4000), ["a" * 3000, "ab" * 2000, " " * 500, "x y" * 900, "word " * 400]):
        for text, ids in zip(batch, encoder.encode_all(batch)):
            expected = published.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == expected
            assert encoder.decode(ids) == published.decode(expected, skip_special_tokens=False)


def test_small_memory_gives_the_same(published):
    encoder = Encoder(Vocabulary.read(PATH), kept=3)
    batch = [f"some{k} words{k % 3} {k}" for k in range(50)]
    for part in (batch[:20], batch[10:], batch):
        for text, ids in zip(part, encoder.encode_all(part)):
            assert ids.tolist() == published.encode(text, add_special_tokens=False).ids


def test_one_tree_and_many_trees_agree():
    vocabulary = Vocabulary.read(PATH)
    draw = random.Random(2)
    pieces = [bytes(draw.choices(b"abcdethin \xc3\xa9", k=draw.randrange(1, 64))) for _ in range(400)]
    from tripmart.llm.bpe import PieceMerger

    import numpy as np

    for piece, ids in zip(pieces, PieceMerger(vocabulary).merge(pieces)):
        assert np.frombuffer(ids, np.int32).tolist() == merge_piece(piece, vocabulary)


def test_query_digests(docs_of, odd_rows, published):
    rows = {r.doc_id: r for r in token_digests(docs_of(odd_rows), vocabulary_path()).collect()}
    for doc, text in odd_rows:
        ids = published.encode(text or "", add_special_tokens=False).ids
        decoded = published.decode(ids, skip_special_tokens=False)
        assert rows[doc].n_tokens == len(ids)
        assert rows[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert tokenized(docs_of([]), PATH).collect() == []
