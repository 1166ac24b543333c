import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm import tokenbin as B
from pulsegrid.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=500))
def test_block_round_trip(values):
    ids = np.array(values, np.uint32)
    got, end = B.unpack_block(B.pack_block(ids))
    assert got.tolist() == values and end == len(B.pack_block(ids))


def test_outliers_are_exceptions_not_wide_blocks():
    ids = np.r_[np.arange(1000) % 16, [2**31]].astype(np.uint32)
    assert len(B.pack_block(ids)) < 16 + 520 + 7


def test_file_ranges(tokenizer):
    rng, out = random.Random(1), io.BytesIO()
    docs = [np.array(rng.choices(range(50257), k=rng.choice((1, 5, 3000))), np.uint32) for _ in range(40)]
    w = B.TokenFileWriter(out, block=256)
    for k, d in enumerate(docs):
        w.add([None if k == 3 else k], np.array([len(d)]), d)
    w.close()
    f = B.TokenFile(pa.BufferReader(out.getvalue()))
    flat = np.concatenate(docs)
    assert f.ids == len(flat) and f.doc_ids[3] is None and f.doc_ids[4] == 4
    assert (f.read_blocks(2, 5) == flat[512:1280]).all()
    assert f.checksums() == [zlib.crc32(d.astype("<u4").tobytes()) for d in docs]


def test_pieces_equal_whole_texts(tokenizer):
    rng = random.Random(4)
    texts = ["", None, " ", "a  b", " a", "a \n b ", "x <|endoftext|> y", "it's a ' s"]
    texts += ["".join(rng.choice(" \n\tab'sé1.　\x85\x1c漢") for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    for limit in (10, 10_000):
        e = B.PieceEncoder(tokenizer, limit)
        for k in range(0, len(texts), 100):
            ids, sizes = e.encode(texts[k : k + 100])
            for t, got in zip(texts[k : k + 100], np.split(ids, np.cumsum(sizes)[:-1])):
                assert got.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids + [0]


def test_table_equals_brute_force(spark, odd_docs, no_docs, tokenizer):
    rows = B.token_table(odd_docs, tokenizer_path()).collect()
    docs = odd_docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    docs.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    start, want = 0, []
    for d in docs:
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((d.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert B.token_table(no_docs, tokenizer_path()).count() == 0
