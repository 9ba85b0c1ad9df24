import hashlib
import random

import public_tokenizers as tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import odd
from tickloom.llm import bpe

RANKS, PATTERN = tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN
PARTS = st.sampled_from(["a", "b", "'", "s", "r", "e", "v", "l", " ", "\n", "\t", "1", "2", ".", "!", "é", "日", "́", "　", "don't", " world", "\r\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=40), st.integers(1, 9), st.sampled_from([1, 2, 256]))
def test_joined_pieces_have_the_librarys_ids(parts, size, window):
    text = "".join(parts)
    nodes = [bpe.Encoded.of(text[i : i + size], RANKS, PATTERN) for i in range(0, len(text), size)] or [bpe.Encoded.of("", RANKS, PATTERN)]
    left = nodes[0]
    for node in nodes[1:]:  # any bracketing gives the same
        left = left.join(node, RANKS, PATTERN, window)
    want = bpe.vocabulary(RANKS, PATTERN)[0].encode_ordinary(text)
    assert left.ids.tolist() == want and bpe.reduced(nodes, RANKS, PATTERN).ids.tolist() == want


@pytest.mark.parametrize("leaf", [50, 1000, bpe.LEAF_CHARS])
def test_encode_and_decode_whole_texts(spark, leaf):
    docs = odd.with_clashes(odd.documents(spark, odd.prose(1, 700), " " * 500 + "end", "'" * 333 + "re"))
    out = bpe.decode(bpe.encode(docs, RANKS, PATTERN, leaf), RANKS, PATTERN)
    assert out.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    library = bpe.vocabulary(RANKS, PATTERN)[0]
    rows = out.toDF(*(f"c{i}" for i in range(len(out.columns)))).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row[-2] == library.encode_ordinary(row[1] or "") and bytes(row[-1]) == (row[1] or "").encode()


def test_digests(spark):
    docs = odd.documents(spark, "Hello world")
    row = {r.doc_id: r for r in bpe.digests(docs, RANKS, PATTERN).collect()}[0]
    ids = bpe.vocabulary(RANKS, PATTERN)[0].encode_ordinary("Hello world")
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest() and row.n_tokens == len(ids)
    assert bpe.digests(odd.empty(docs), RANKS, PATTERN).collect() == []


def test_long_runs_join_in_reasonable_windows():
    pick = random.Random(4)
    text = "".join(pick.choice(["word", " ", "aaaa", "1"]) * pick.randrange(1, 400) for _ in range(60))
    nodes = [bpe.Encoded.of(text[i : i + 777], RANKS, PATTERN) for i in range(0, len(text), 777)]
    assert bpe.reduced(nodes, RANKS, PATTERN).ids.tolist() == bpe.vocabulary(RANKS, PATTERN)[0].encode_ordinary(text)


CERTAIN = st.text(st.characters(codec="utf-8") | PARTS.filter(lambda x: len(x) == 1) | st.sampled_from("\x1c\x1f\x85\xa0 　'.,"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(CERTAIN, st.integers(1, 30))
def test_tokens_outside_certain_places_are_stable(text, size):
    nodes = [bpe.Encoded.of(text[i : i + size], RANKS, PATTERN) for i in range(0, len(text), size)] or [bpe.Encoded.of("", RANKS, PATTERN)]
    assert bpe.reduced(nodes, RANKS, PATTERN).ids.tolist() == bpe.vocabulary(RANKS, PATTERN)[0].encode_ordinary(text)


def test_joins_encode_only_what_lies_between_certain_places(monkeypatch):
    left, right = (bpe.Encoded.of(odd.prose(i, 3000), RANKS, PATTERN) for i in (1, 2))
    seen = []
    plain = bpe.encoded
    monkeypatch.setattr(bpe, "encoded", lambda encoder, text: seen.append(text) or plain(encoder, text))
    joined = left.join(right, RANKS, PATTERN)
    assert len(seen) == 1 and len(seen[0]) < 40
    assert joined.ids.tolist() == bpe.vocabulary(RANKS, PATTERN)[0].encode_ordinary(left.text + right.text)


def test_null_and_nested_ids_decode(spark):
    table = spark.createDataFrame([(1, [31373, 995]), (2, None), (3, [])], "doc_id int, ids array<int>")
    spelled = bpe.vocabulary(RANKS, PATTERN)[1]
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(table, RANKS, PATTERN).collect()}
    assert got == {1: spelled[31373] + spelled[995], 2: b"", 3: b""}
    many = list(range(5000))
    got = bpe.decode(spark.createDataFrame([(1, many)], "doc_id int, ids array<int>"), RANKS, PATTERN).collect()[0]
    assert bytes(got.decoded) == b"".join(spelled[:5000])
