import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridsmith.llm import token_binary as B
from gridsmith.session import shared_dir
from tests.llm.conftest import ODD_TEXTS, SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=80), st.data())
def test_packing_round_trip(width, ids, data):
    ids = np.array(ids, dtype=np.uint64) % (1 << width)
    packed = B.pack(ids.astype(np.uint32), width)
    assert len(packed) == -(-len(ids) * width // 8)
    a = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - a))
    assert B.unpack(packed, width, a, n).tolist() == ids[a:a + n].tolist()


def test_width():
    assert [B.bits_for(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


def test_pieces_are_the_tokenizers_ids(tokenizer, documents):
    texts = [t or "" for t in ODD_TEXTS] + documents.text.tolist() + [
        "<|endoftext|> don't we'll a.b ... x.. y., Ünï İstanbul ǅ ﬁ ½ ² é ​\xa0z\x1cq 'S 'LL ON.\r\n\x0b", "a b\x85c", "ªº. µ,"]
    pieces = B.Pieces(PATH, 2)
    for _ in range(2):
        assert [x.tolist() for x in pieces(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_pieces_on_any_text(text):
    SHARED.reset()
    assert SHARED([text, text + "<|endoftext|>"])[0].tolist() == SHARED.tokenizer.encode(text, add_special_tokens=False).ids + [2]


SHARED = B.Pieces(PATH, 2)


def test_query_against_the_tokenizer(spark, documents, tokenizer):
    from gridsmith.llm.queries import op8_token_binary
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op8_token_binary(spark, SF_SMALL).collect()}
    at, want = 0, {}
    for d, t in zip(documents.doc_id, documents.text):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want


def test_odd_rows_files_and_random_access(spark, odd_docs, no_docs, tokenizer, monkeypatch):
    monkeypatch.setattr(B, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(B, "BLOCK_IDS", 3)
    path = shared_dir(spark, "test_ids")
    B.write_ids(odd_docs, path, PATH, 2, 16)
    rows = sorted(B.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == 11 and rows[0].doc_id is None
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)]).tolist()[:-1]
    assert [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    assert {r.doc_id: r.n_tokens for r in rows}[0] == 1
    got = B.read_ids(spark, path, 5)
    assert [x.tolist() for x in got] == [tokenizer.encode(ODD_TEXTS[5], add_special_tokens=False).ids + [2]]
    empty = shared_dir(spark, "test_ids")
    B.write_ids(no_docs, empty, PATH, 2, 16)
    assert B.read_documents(spark, empty).count() == 0
