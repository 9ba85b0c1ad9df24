import zlib

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import odd
from tickloom.llm import wavelet, words

VOCABULARY = tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=1500))
def test_file_round_trip_access_rank_select(ids):
    x = np.array(ids, np.uint32)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(x, np.array([len(x)])).to_bytes())
    assert (matrix.tokens() == x).all()
    for i in range(0, len(x), max(1, len(x) // 20)):
        token, before = int(x[i]), int((x[:i] == x[i]).sum())
        assert matrix.access(i) == token and matrix.rank(token, i) == before and matrix.select(token, before) == i
    assert matrix.rank(99_999) == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aÉéJ̌ \t\n'st12!२日<|>endoftextΣİ😀\x85\x00"), max_size=60))
def test_words_have_the_librarys_ids(library, text):
    ids, counts = wavelet._word_ids(VOCABULARY)(*words.text_bytes(pa.array([text, None, text])))
    want = library.encode(text, add_special_tokens=False).ids
    assert counts.tolist() == [len(want), 0, len(want)] and ids.tolist() == want * 2


@pytest.mark.parametrize("shard_tokens", [wavelet.SHARD_TOKENS, 100])
def test_documents_come_back_in_order(spark, library, tmp_path, shard_tokens):
    docs = odd.with_clashes(odd.documents(spark, *(odd.prose(i, 40) for i in range(30))))
    path = str(tmp_path / "files")
    wavelet.write(docs, path, VOCABULARY, shard_tokens=shard_tokens)
    got = sorted(((r.start, r.doc_id, list(r.tokens)) for r in wavelet.read(spark, path).collect()), key=lambda x: x[0])
    rows = [(r[0], r[1]) for r in docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).select("c0", "c1").collect()]
    assert [x[1] for x in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert [x[0] for x in got] == np.cumsum([0] + [len(x[2]) for x in got])[:-1].tolist()
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows)
    assert sorted((str(i), ids) for _, i, ids in got) == want
    token = want[0][1][0]
    places = sorted((str(r.doc_id), r.offset) for r in wavelet.occurrences(spark.read.parquet(path), token).collect())
    assert places == sorted((str(i), k) for _, i, ids in got for k, x in enumerate(ids) if x == token)
    digest = {r.start: r.ids_crc32 for r in wavelet.digests(spark.read.parquet(path)).collect()}
    assert all(digest[s] == zlib.crc32(np.array(ids, "<u4").tobytes()) for s, _, ids in got)


def test_empty_table(spark):
    docs = odd.documents(spark)
    assert wavelet.documents(wavelet.shards(odd.empty(docs), VOCABULARY)).collect() == []


def test_added_tokens_have_the_unchanged_librarys_ids(spark):
    plain = Tokenizer.from_file(VOCABULARY)
    added = sorted(x.content for x in plain.get_added_tokens_decoder().values())
    texts = ["hello <|endoftext|> you", "no such token", None, "<|startoftext|>a<|endoftext|>", "<|ENDOFTEXT|> x", "", *(f"a {x}b\n{x}{x}" for x in added), "last one"]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    ids, counts = wavelet._word_ids(VOCABULARY)(*words.text_bytes(pa.array(texts)))
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, list(r.tokens)) for r in wavelet.documents(wavelet.shards(docs, VOCABULARY)).collect())
    assert got == [(i, [*x, 1]) for i, x in enumerate(want)]
