import odd
from tickloom.llm import linededup


def lines_of(text):
    return [(i, " ".join(x.split())) for i, x in enumerate((text or "").split("\n")) if x.strip(" \t\x0b\f\r")]


def test_passages_go_at_later_places_only(spark):
    passage = odd.prose(1, 60)  # five lines of twelve words
    one_line = " ".join(odd.prose(2, 30, 30).split())
    short = "a short line that many share"
    texts = [
        odd.prose(3, 24) + "\n" + passage + "\n" + odd.prose(4, 24),
        short + "\n" + odd.prose(5, 24) + "\n\n" + passage.replace("\n", "  \n \n") + "\n" + odd.prose(6, 24),
        short + "\n" + one_line + "\nend",
        "begin\n " + one_line + "\n" + short + "\n" + one_line,
        odd.prose(7, 24),
        passage,
    ]
    docs = odd.with_clashes(odd.documents(spark, *texts))
    out = linededup.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    left = {r[0]: r[1] for r in out.toDF(*(f"c{i}" for i in range(len(out.columns)))).select("c0", "c1").collect()}
    assert left[0] == texts[0] and left[2] == texts[2] and left[4] == texts[4]
    assert [x for _, x in lines_of(left[1])] == [short, *(x for _, x in lines_of(odd.prose(5, 24))), *(x for _, x in lines_of(odd.prose(6, 24)))]
    assert left[3] == "begin" and left[5] == ""  # short and one_line stand in a row in text 2, too
    dropped = linededup.deduplicated(docs, keep_emptied=False)
    assert dropped.count() == docs.count() - 1


def test_repeated_rows_and_unions_of_runs(spark):
    text = odd.prose(8, 120)
    docs = spark.createDataFrame([(1, text), (1, text), (2, "x\n" + text), (None, text), (3, text + "\n" + text)], "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in linededup.deduplicated(docs).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [(None, text), (1, ""), (1, ""), (2, "x"), (3, "")]))
    assert linededup.deduplicated(odd.empty(docs)).collect() == []


def test_long_document_of_many_lines(spark):
    text = "\n".join(f"line {i} of a long one" for i in range(5000))
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in linededup.deduplicated(docs).collect()} == {1: text, 2: ""}


def repeated_runs(docs):
    """By brute force: all maximal runs of lines, as (document, first line, last line), that equal an earlier place."""
    places = [(d, i) for d, lines in enumerate(docs) for i in range(len(lines))]
    for e, j in places:
        for d, i in places:
            if (e, j) < (d, i) and docs[d][i] == docs[e][j] and not (i and j and docs[d][i - 1] == docs[e][j - 1]):
                n = 1
                while i + n < len(docs[d]) and j + n < len(docs[e]) and docs[d][i + n] == docs[e][j + n]:
                    n += 1
                yield d, i, i + n - 1


def units_in(lines, least=25):
    """How many lines of a run begin a unit that ends inside it, and whether one line is a unit."""
    sizes = [len(x.split()) for x in lines]
    return sum(sum(sizes[i:]) >= least for i in range(len(sizes))), max(sizes) >= least


def test_nothing_long_stays_of_a_repeated_run(spark):
    import random

    pick = random.Random(5)
    lines = [" ".join(odd.prose(100 + i, n, n).split()) for i, n in enumerate([30, 26, 25, 24, 24, 24, 24, 13, 12, 12, 11, 8, 5, 3])]
    texts = [[pick.choice(lines) for _ in range(pick.randrange(1, 9))] for _ in range(40)]
    texts += [[lines[0]], [lines[0], lines[3], lines[4]], [lines[7], lines[0], lines[3], lines[4], lines[9]]]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    removed = {r.doc_id: {i for x in r.removed for i in range(x["from"], x["to"] + 1)} for r in linededup.marked(docs).collect()}
    for d, gone in removed.items():  # what goes stands earlier
        before = {x for t in texts[:d] for x in t}
        assert all(texts[d][i] in before or texts[d][i] in texts[d][:i] for i in gone)
    for d, first, last in repeated_runs(texts):
        units, single = units_in(texts[d][first : last + 1])
        if units < 2 and not single:
            continue
        left = 0
        for i in range(first, last + 1):
            left = 0 if i in removed[d] else left + len(texts[d][i].split())
            assert left < 25, (d, first, last)


def test_many_equal_lines_and_many_ranges(spark):
    line = " ".join(odd.prose(9, 26, 26).split())
    unique = [f"line {i} of a long one" for i in range(10_000)]
    texts = ["\n".join([line] * 100_000), "\n".join(x for u in unique for x in (u, line)), "\n".join([line] * 50_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r.text for r in linededup.deduplicated(docs).collect()}
    assert left == {0: line, 1: "\n".join(unique), 2: ""}
