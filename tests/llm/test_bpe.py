import base64
import random
from hashlib import sha256

import numpy as np
import pytest
import tiktoken

from tidelog.llm import bpe, queries
from tests.llm.conftest import EDGES, SMALL, documents

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    return queries.vocabulary_path()


@pytest.fixture(scope="module")
def reference(path):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(reference, text):
    return np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()


def test_random_texts(path, reference):
    rnd = random.Random(1)
    letters = "  \n\t'''strevelldm  aZé 　\u0085ñ1234½²!!,.#中\U0001f600\x1c\x1d\x1f́ǅ\r"
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["a" * 5000, "'" * 999, " " * 3000, "\n" * 2001 + "x", "ab" * 20_000, "x's'll 've'"]
    got = bpe.encode(texts, path)
    assert got == [packed(reference, t) for t in texts]
    assert [bpe.decode(g, path).decode() for g in got] == texts


def test_chunks_of_long_texts(path, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    text = "It's a long  text,\n\n with 'll things " * 40 + "z" * 300 + " don't" * 20
    assert bpe.encode([text, "", None], path) == [packed(reference, text), b"", b""]


def test_offsets(path):
    ids = bpe.encode(["héllo wörld"], path)[0]
    assert bpe.token_ends(ids, path)[-1] == len("héllo wörld".encode())


def test_cache_generations(path, reference, monkeypatch):
    vocab = bpe.Vocabulary(path)
    monkeypatch.setattr(bpe, "CACHE_PIECES", len(vocab.packed) + 5)
    words = [f"qz{i}x".encode() for i in range(40)]
    for _ in range(3):
        for at in range(0, 40, 4):
            part = words[at:at + 4]
            assert vocab.packed_ids(part) == [packed(reference, w.decode()) for w in part]


def test_edges(edges, path, reference):
    got = bpe.encode_texts(edges, path).collect()
    want = sorted(((i, packed(reference, t)) for i, t in EDGES), key=repr)
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=repr) == want


def test_empty(nothing, path):
    assert bpe.round_trip(nothing, path).collect() == []


def test_query(spark, path, reference):
    texts = {r.doc_id: r.text or "" for r in documents(spark).collect()}
    rows = queries.QUERIES["op2_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = packed(reference, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, sha256(ids).hexdigest())
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()


def test_spans_are_decoded_by_offsets(spark, edges):
    """Any span of a text's bytes, from the tokens that hold it alone."""
    rnd, path = random.Random(0), queries.vocabulary_path()
    rows = bpe.encode_texts(edges, path, offsets=True).collect()
    texts = [(t or "").encode("utf-8", "replace") for _, t in EDGES]
    decoded = sorted(bpe.decode(r.ids, path) for r in rows)
    assert decoded == sorted(texts) and all(len(r.ends) == 8 * r.n_tokens for r in rows)
    for r in rows:
        whole = bpe.decode(bytes(r.ids), path)
        for _ in range(20):
            a, b = sorted(rnd.randint(0, len(whole)) for _ in range(2))
            assert bpe.decode_span(bytes(r.ids), bytes(r.ends), a, b, path) == whole[a:b]
