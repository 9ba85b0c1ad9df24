import hashlib
import random
import re

import odd
from tickloom.llm import pii


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]


PARTS = ["a", "b@c.d", "@", ".", "1", "23", "+1", "+", "(555) ", "4111111111111111", "4111 1111-1111 1111", "-", " ", "é", "\n", "192.168.0.1", "256.1.1.1", "x.y", "_", "日", "😀", "0001.2.3.4"]


def test_base_spans_match_plain_patterns(spark):
    pick = random.Random(2)
    texts = ["".join(pick.choice(PARTS) for _ in range(pick.randrange(25))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.report(docs).collect():
        want = base_spans(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join("{}:{}:{}".format(*s) for s in want).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in want) for k in ("email", "ip", "card", "phone")]


def test_long_runs_context_and_redaction(spark):
    texts = ["1" * 200_000, "1 " * 100_000, "a." * 20_000, "a@" + "b." * 30_000 + "c", "IBAN DE89 3704 0044 0532 0130 00 ok", "DE88370400440532013000", "SSN 123-45-6789", "no 123-45-6789", "server 10.0.0.1, write to x@y.org"]
    docs = odd.with_clashes(odd.documents(spark, *texts))
    found = pii.find(docs)
    assert found.columns == [c for c in docs.columns if c != "pii"] + ["pii"] and found.count() == docs.count()
    kinds = {r.doc_id: [(s.kind, round(s.score, 2)) for s in r.pii] for r in found.select("doc_id", "pii").collect()}
    assert kinds[3] == [("email", 0.8)] and kinds[4] == [("iban", 0.9)] and kinds[5] == [] and kinds[6] == [("ssn", 0.6)] and kinds[7] == []
    assert kinds[8] == [("email", 1.0), ("ip", 0.8)]
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns
    left = {r[0]: r[1] for r in clean.toDF(*(f"c{i}" for i in range(len(clean.columns)))).select("c0", "c1").collect()}
    assert left[8] == "server <ip>, write to <email>" and left[7] == texts[7]
    assert pii.report(odd.empty(docs)).collect() == []


def test_many_spans_in_one_text(spark):
    pick = random.Random(3)
    parts = [pick.choice(["mail ", "x ", "日 ", "😀 "]) + f"a{i}@b.org" + pick.choice([" ", "\n", ", "]) for i in range(200_000)]
    text = "".join(parts)
    spans = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().pii
    found = [m for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert [(s.start, s.end) for s in spans] == [m.span() for m in found]
    near = [bool(re.search("mail|contact|write", text[max(0, m.start() - 40) : m.start()])) for m in found]
    assert [s.score > 0.9 for s in spans] == near
