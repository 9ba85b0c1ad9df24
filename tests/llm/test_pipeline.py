import hashlib
import re

import public_tokenizers as tokenizers

import corpus_pipeline
import odd
from tickloom.llm import bpe


def test_stages_take_effect(spark, tmp_path):
    clean = [odd.prose(i, 80) for i in range(200)]
    toxic = [odd.prose(1000 + i, 60).replace(" ", " horrid ", 3) for i in range(60)]
    passage = odd.prose(7000, 60)
    item = " ".join(odd.prose(8000, 25).split())
    near = clean[5].split()
    near[40] = "other"
    near = " ".join(near)
    special = [odd.prose(3000, 24) + "\n" + passage, odd.prose(3001, 24) + "\n" + passage, clean[3], near, odd.prose(3002, 30) + " " + item + " " + odd.prose(3003, 5)]
    texts = clean + toxic + special
    docs = odd.documents(spark, *texts)
    labels = spark.createDataFrame([(i, 1, int(len(clean) <= i < len(clean) + len(toxic))) for i in range(len(clean) + len(toxic))], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {r.doc_id: r for r in rows}
    first = len(clean) + len(toxic)
    gone = {*range(len(clean), first), first + 2, first + 3, first + 4}
    n = len(texts)
    assert set(got) == {i for i in range(n) if i not in gone} | {*range(n, n + 8), None}
    library = bpe.vocabulary(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)[0]
    for i in (*range(len(clean)), first):
        ids = library.encode_ordinary(texts[i])
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and got[i].n_tokens == len(ids)
    left = odd.prose(3001, 24)
    assert got[first + 1].decoded_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert re.match("toxic", corpus_pipeline.STAGES[0][1].__name__)


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    docs = odd.empty(odd.documents(spark, "x"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
