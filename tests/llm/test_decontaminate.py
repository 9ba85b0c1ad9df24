import re

import pytest

import odd
from tickloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    words, hit, found, longest = split(text), set(), set(), 0
    for name, item in items:
        own = split(item)
        size = min(window, len(own))
        for q in range(len(own) - size + 1 if own else 0):
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[q : q + size]:
                    n = size
                    while p + n < len(words) and q + n < len(own) and words[p + n] == own[q + n]:
                        n += 1
                    hit |= set(range(p, p + size))
                    found.add(name)
                    longest = max(longest, n)
    return len(words), len(hit), sorted(found), longest


BASE = odd.prose(5, 60)
ITEMS = [(1, BASE), (2, "Alpha1, beta2 GAMMA3"), (3, None), (4, ""), (5, "same same same same same same same same same same same same"), (None, odd.prose(9, 15)), (1, BASE)]


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 200])
def test_every_window_is_found(spark, block_bytes):
    quote = " ".join(BASE.split()[7:30]).upper()
    texts = [odd.prose(2, 40) + " " + quote + "\n" + odd.prose(3, 20), BASE, "so alpha1 beta2 gamma3 it is", "same " * 40, odd.prose(9, 15), odd.prose(11, 300), quote + " x " + quote]
    docs = odd.with_clashes(odd.documents(spark, *texts))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.search(docs, bench, 10, block_bytes)
    items = [("null" if i is None else str(i), t) for i, t in ITEMS]
    rows = out.select("doc_id", *(out.columns.index(c) and c for c in ("n_words", "spans", "matches"))).collect()
    whole = {r[0]: r[1] for r in docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).select("c0", "c1").collect() if r[0] is not None and r[0] < len(texts)}
    assert len(rows) == docs.count()
    for row in rows:
        if row.doc_id in whole:
            n, hit, found, longest = brute(whole[row.doc_id], items, 10)
            assert (row.n_words, sum(s["last"] - s["first"] for s in row.spans), sorted(m["item"] for m in row.matches)) == (n, hit, found)
            assert max((m["words"] for m in row.matches), default=0) == longest


def test_removed_keeps_clean_rows_and_columns(spark):
    docs = odd.with_clashes(odd.documents(spark, BASE, odd.prose(12, 50)))
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    left = decontaminate.removed(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - 1
    assert decontaminate.removed(docs, odd.empty(bench)).count() == docs.count()
    assert decontaminate.report(odd.empty(docs), bench).collect() == []
