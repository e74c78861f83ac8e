"""Op 1: exact ids against whole-text encoding, Elias-Fano structures, odd rows."""

import random
import zlib

import numpy as np
import public_tokenizers
from llm_fixtures import SF, long_text, no_docs, odd_docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as E
from ratecraft.llm.op01_token_store import EliasFano, Segment, pack_segment, token_store, write_store
from ratecraft.llm.pieces import PieceEncoder

LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def whole(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_text():
    enc, rng = PieceEncoder(), random.Random(1)
    alphabet = list("ab' \n\t.,1é<|s \x1c\x85") + ["'s", "'re", " ", "  ", "<|endoftext|>", " the"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(3000)]
    for text in [*texts, None, "", " ", "a ", " a", "x\n\n\ny", "日本 語"]:
        assert enc.ids(text).tolist() == whole(text), repr(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), max_size=600))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    ef, _ = EliasFano.from_buffer(EliasFano.encode(values).to_bytes())
    assert ef.values().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(0).integers(100, 2000, 10_000))
    assert len(EliasFano.encode(bounds).to_bytes()) * 8 < 10_000 * (2 + np.log2(bounds[-1] / 10_000) + 1)


def test_segment_documents():
    ids = [b"\x01\x00\x02\x00", b"\x00\x00", b""]
    seg = Segment(pack_segment([None, 4, 4], [2, 1, 0], ids, 2))
    assert seg.doc_ids() == [None, 4, 4]
    assert [seg.document(i).tolist() for i in range(3)] == [[1, 2], [0], []]


def test_query_is_exact(spark):
    rows = {r.doc_id: r for r in E.queries()["op1_token_store"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for d in docs:
        ids = [*whole(d.text), 0]
        r = rows[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == len(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = token_store(odd_docs).orderBy("start").collect()
    assert len(rows) == odd_docs.count()
    want = {}
    for r in odd_docs.collect():
        want.setdefault(r.doc_id, []).append(zlib.crc32(np.array([*whole(r.text), 0], "<u4").tobytes()))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r.ids_crc32)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    ids = [r.doc_id for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    assert token_store(no_docs).count() == 0


def test_many_segments(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a b c " * i) for i in range(60)], "doc_id long, text string")
    write_store(docs, str(tmp_path / "s"), shards=3, segment_ids=50)
    from ratecraft.llm.op01_token_store import read_index
    rows = read_index(spark, str(tmp_path / "s")).orderBy("doc_id").collect()
    sizes = [len(whole("a b c " * i)) + 1 for i in range(60)]
    assert [r.n_tokens for r in rows] == sizes
    assert [r.start for r in rows] == [0, *np.cumsum(sizes)[:-1]]
