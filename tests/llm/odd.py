"""Tables with everything that should do no harm: nulls, empty and long texts, ties, repeated rows, further columns."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, words, line=12):
    pick = random.Random(seed)
    made = [pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(words)]
    return "\n".join(" ".join(made[i : i + line]) for i in range(0, words, line))


def documents(spark, *texts):
    """The texts as rows 0, 1, ...; odd rows: null, empty, blank, one word, long, non-Latin, repeated, null id."""
    rows = [(i, t) for i, t in enumerate(texts)]
    n = len(rows)
    odd = [None, "", " \n\t \n", "word", "x" * 30_000, "ab " * 20_000, "Ärger über Größe 日本語 😀", "'s 's\r\n"]
    rows += [(n + i, t) for i, t in enumerate(odd)]
    rows += [(n + 3, "word"), (n + 3, "word"), (n + 6, "another text of the same id"), (None, "no id at all"), (None, None)]
    return spark.createDataFrame([(i, t, "en", "src", len(t or ""), "mine", 7, 0.5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, ids long, TEXT2 double")


def with_clashes(table):
    """Further columns under names that operators use, and one that differs from text in case only."""
    from pyspark.sql import functions as F

    names = ("uid", "id", "node", "component_id", "kept", "spans", "matches", "removed", "pii", "n_words", "_0", "_1", "label", "key", "lines", "size")
    wide = table.withColumns({name: F.lit(name) for name in names})
    return wide.select("*", F.lit("other").alias("extra")).toDF(*wide.columns, "Text")


def empty(table):
    return table.where("1 = 0")
