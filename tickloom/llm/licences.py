"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance down the directories.

DataFrame functions only. The statements of a file are its lines that hold a licence word,
wherever they stand; a licence file (by its name) is one statement as a whole. Statements
and templates are sparse vectors of term counts times inverse document frequencies over all
files; a join on the terms gives the cosines. Headers and licence texts run over lines, so
that windows of words, laid where a template's first licence word stands, are held against
those templates, and what a file states in a header or as its title goes before its lines.
A file without a licence of its own takes that of the nearest directory above it whose
licence files have one: directories join all their ancestors by path, and files join their
directory.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import Held, written

THRESHOLD = 0.6
#: Notices and their licences (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("ISC", "Licensed under the ISC License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("Proprietary", "All rights reserved"),
)
_FREE = "is free software; you can redistribute it and/or modify it under the terms of the GNU {} License"
_FSF = "as published by the Free Software Foundation"
_LATER = _FREE + " " + _FSF + "; either version {} of the License, or (at your option) any later version."
_ONLY = "This program " + _FREE + " version {} " + _FSF
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. {}"
    "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed."
)
#: Standard headers and licence texts of several lines, and their licences (fixed values).
HEADERS = (
    ("GPL-1.0", "This program " + _LATER.format("General Public", "1")),
    ("GPL-2.0", "This program " + _LATER.format("General Public", "2")),
    ("GPL-3.0", "This program " + _LATER.format("General Public", "3")),
    ("LGPL-2.0", "This library " + _LATER.format("Library General Public", "2")),
    ("LGPL-2.1", "This library " + _LATER.format("Lesser General Public", "2.1")),
    ("LGPL-3.0", "This library " + _LATER.format("Lesser General Public", "3")),
    ("AGPL-3.0", "This program " + _LATER.format("Affero General Public", "3")),
    ("GPL-2.0", _ONLY.format("General Public", "2")),
    ("GPL-3.0", _ONLY.format("General Public", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", _BSD.format("")),
    ("BSD-3-Clause", _BSD.format("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ")),
)
#: What licence files open with (fixed values). The words are those of the file's first terms.
TITLES = (
    *((name, f"GNU General Public License Version {v}") for name, v in (("GPL-1.0", 1), ("GPL-2.0", 2), ("GPL-3.0", 3))),
    ("LGPL-2.0", "GNU Library General Public License Version 2"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("ISC", "ISC License"),
    ("ISC", "The ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    *((name, f"{lead}{kind} 4.0 International") for lead in ("", "Creative Commons ") for name, kind in (
        ("CC-BY-4.0", "Attribution"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives"),
    )),
)
#: A line with one of these words is a statement.
LICENCE_WORDS = r"(?i)licen[cs]|copyright|copyleft|spdx|rights reserved|redistribut|permission|public domain|\bgnu\b|\bcc[ -]|\bcc0\b"
LICENCE_FILES = r"(?i)^(un)?licen[cs]e|^copying|^notice"
_TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: A header's window is laid by the first of these words in it.
_ANCHOR = re.compile(r"licen[cs]e|redistribut|permission|mozilla")


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def _template_terms(spark: SparkSession, notices: tuple = TEMPLATES) -> DataFrame:
    """``(template, licence, term, tf)``: a few hundred rows, fixed by the notices."""
    rows = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(licence).alias("licence"), F.lit(text).alias("text")) for i, (licence, text) in enumerate(notices)))
    templates = spark.range(1).select(F.explode(rows).alias("t")).select("t.*")
    return templates.select("template", "licence", F.explode(_terms(F.col("text"))).alias("term")).groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))


def _statements(path: str, text: str) -> Column:
    """(place, terms) of the file's statements; place -1 is a licence file as a whole."""
    lines = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("place"), x.alias("line")))
    lines = F.filter(lines, lambda x: x["line"].rlike(LICENCE_WORDS))
    made = F.transform(lines, lambda x: F.struct(x["place"].alias("place"), _terms(x["line"]).alias("terms")))
    whole = F.array(F.struct(F.lit(-1).alias("place"), _terms(F.col(text)).alias("terms")))
    return F.when(_is_licence_file(path), F.concat(whole, made)).otherwise(made)


def _windows(terms: str) -> Column:
    """(template, place, terms): for each header and each place of its first licence word, as many of the file's terms as the header has."""
    laid = []
    for i, (_, header) in enumerate(HEADERS):
        own = _notice_terms(header)
        offset = next(k for k, term in enumerate(own) if _ANCHOR.match(term))
        laid.append((i, own[offset], offset, len(own)))
    anchors = F.transform(F.col(terms), lambda x, i: F.struct(i.alias("at"), x.alias("term")))
    anchors = F.filter(anchors, lambda x: x["term"].isin(*sorted({term for _, term, _, _ in laid})))
    shapes = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(term).alias("term"), F.lit(offset).alias("offset"), F.lit(size).alias("size")) for i, term, offset, size in laid))

    def around(anchor: Column) -> Column:
        start = lambda shape: F.greatest(anchor["at"] - shape["offset"], F.lit(0))
        matching = F.filter(shapes, lambda shape: shape["term"] == anchor["term"])
        return F.transform(matching, lambda shape: F.struct(shape["template"].alias("template"), start(shape).alias("place"), F.slice(F.col(terms), start(shape) + 1, shape["size"]).alias("terms")))

    return F.flatten(F.transform(anchors, around))


def _title(terms: str) -> Column:
    """The licence of the longest title that the terms begin with."""
    titles = sorted(((_notice_terms(title), licence) for licence, title in TITLES), key=lambda x: -len(x[0]))
    return F.coalesce(*(F.when(F.slice(F.col(terms), 1, len(own)) == F.array(*map(F.lit, own)), F.lit(licence)) for own, licence in titles))


def _is_licence_file(path: str) -> Column:
    return F.coalesce(F.element_at(F.split(F.col(path), "/"), -1).rlike(LICENCE_FILES), F.lit(False))


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _own(files: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """``(uid, score, licence)``: each file's statements that reach the threshold."""
    total = files.count()
    counted = files.select(F.explode("present").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = counted.select("term", (F.log(F.lit(1.0 + total) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    vectors = templates.join(weights, "term", "left").select("*", (F.col("tf") * F.coalesce("idf", F.lit(1.0))).alias("tw")).drop("tf", "idf")
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("norm"))
    vectors = vectors.join(norms, "template").select("licence", "template", "term", (F.col("tw") / F.col("norm")).alias("tw"))
    words = files.select("uid", F.explode("statements").alias("s")).select("uid", "s.place", F.explode("s.terms").alias("term"))
    words = words.groupBy("uid", "place", "term").agg(F.count(F.lit(1)).alias("tf"))
    words = words.join(F.broadcast(weights), "term", "left")  # the templates' terms
    words = words.select("uid", "place", "term", (F.col("tf") * F.coalesce("idf", F.lit(1.0))).alias("w"))
    lengths = words.groupBy("uid", "place").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    cosines = words.join(F.broadcast(vectors), "term").groupBy("uid", "place", "template", "licence").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))  # the templates' terms
    cosines = cosines.join(lengths, ["uid", "place"]).select("uid", "licence", F.round(F.col("dot") / F.col("length"), 6).alias("score"))
    return cosines.where(F.col("score") >= threshold)


def _headers(table: DataFrame, terms: DataFrame, total: int, threshold: float) -> DataFrame:
    """``(uid, score, licence)``: the best header of each file's windows. ``terms``: the distinct terms of all files.

    Document frequencies are those of all terms of the windows and headers, 0 where no file has one.
    """
    said = table.select("uid", F.explode("windows").alias("s")).select("uid", "s.template", "s.place", F.explode("s.terms").alias("term"))
    said = said.groupBy("uid", "template", "place", "term").agg(F.count(F.lit(1)).alias("tf"))
    headers = _template_terms(table.sparkSession, HEADERS)
    asked = said.select("term").union(headers.select("term")).distinct()
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0
    weights = written(asked.join(counted, "term", "left").select("term", idf.alias("idf")), "header-weights")
    words = said.join(weights, "term").select("uid", "template", "place", "term", (F.col("tf") * F.col("idf")).alias("w"))
    vectors = headers.join(weights, "term").select("template", "licence", "term", (F.col("tf") * F.col("idf")).alias("tw"))
    norms = vectors.groupBy("template", "licence").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("norm"))
    both = words.join(F.broadcast(vectors.drop("licence")), ["template", "term"], "left")  # the headers' terms
    cosines = both.groupBy("uid", "template", "place").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    cosines = cosines.join(F.broadcast(norms), "template").select("uid", "licence", F.round(F.col("dot") / (F.col("length") * F.col("norm")), 6).alias("score"))  # a row per header
    return _best(cosines.where(F.col("score") >= threshold))


def _best(scores: DataFrame) -> DataFrame:
    return scores.groupBy("uid").agg(F.max("score").alias("score"), F.min_by("licence", F.struct(-F.col("score"), F.col("licence"))).alias("licence"))


def scan(files: DataFrame, threshold: float = THRESHOLD, path: str = "path", text: str = "text") -> DataFrame:
    """The files without their text, with ``licence``, ``licence_score`` and ``licence_from``.

    ``licence_from`` is "self" for a licence of the file's own statements (best cosine; the
    first name at ties), the directory's path for an inherited one, and null without any. A
    directory with several licence files has the best one's licence. Null and empty texts
    state nothing; a null path is in no directory; repeated rows stay. Columns of those
    names are replaced. A licence file that opens with a licence's title has that licence,
    with score 1; otherwise a file with a header of HEADERS has the best header's, with the
    best score of that header and of lines that name the same licence, and any other file
    the best line's. For lines, terms that no template holds or no file has weigh
    1; for headers all terms weigh by their document frequency.
    """
    held = Held(files)
    where, what = held[path], held[text]
    templates = _template_terms(files.sparkSession)
    vocabulary = sorted({t for _, notice in TEMPLATES for t in _notice_terms(notice)})
    words = F.array(*(F.lit(t) for t in vocabulary))
    others = [c for c in held.columns() if c != what]
    read = held.frame.withColumn(what, F.coalesce(F.col(what), F.lit("")))
    read = read.withColumn("terms", _terms(F.col(what)))
    said = F.when(F.col(what).rlike(LICENCE_WORDS), F.col("terms"))
    title = F.when(_is_licence_file(where), F.slice("terms", 1, max(len(_notice_terms(title)) for _, title in TITLES)))
    table = written(
        read.select(
            *others, F.monotonically_increasing_id().alias("uid"), F.array_intersect(words, F.col("terms")).alias("present"), _statements(where, what).alias("statements"),
            said.alias("said"), title.alias("opening"),
        ),
        "statements",
    )
    windows = table.where(F.col("said").isNotNull()).select("uid", _windows("said").alias("windows")).where(F.size("windows") > 0)
    every = read.select(F.explode(F.array_distinct("terms")).alias("term"))
    headers = _headers(windows, every, table.count(), threshold)
    titles = table.select("uid", _title("opening").alias("licence")).where(F.col("licence").isNotNull())
    headers = written(headers, "header-licences")
    lines = _own(table, templates, threshold).join(headers.select("uid", F.col("licence").alias("header")), "uid", "left")
    lines = lines.where(F.col("header").isNull() | (F.col("header") == F.col("licence"))).select("uid", "score", "licence")
    stated = _best(lines.unionByName(headers)).join(titles, "uid", "left_anti")
    own = written(stated.unionByName(titles.withColumn("score", F.lit(1.0))), "own-licences")
    named = table.select("uid", F.col(where).alias("path"))
    placed = named.where(F.col("path").isNotNull()).select("uid", "path", _directory(F.col("path")).alias("directory"))
    granted = placed.where(_is_licence_file("path")).join(own, "uid").groupBy("directory").agg(
        F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence"))).alias("grant")
    )
    directories = placed.select("directory").distinct()
    depth = F.size(F.split("directory", "/"))
    ancestors = directories.select("directory", F.explode(F.sequence(F.lit(0), depth)).alias("depth"))
    ancestors = ancestors.select("directory", "depth", F.array_join(F.slice(F.split("directory", "/"), 1, F.col("depth")), "/").alias("ancestor"))
    nearest = ancestors.join(granted.withColumnRenamed("directory", "ancestor"), "ancestor")
    nearest = nearest.groupBy("directory").agg(F.max_by(F.struct("ancestor", "grant"), "depth").alias("up"))
    inherited = placed.join(own.select("uid"), "uid", "left_anti").join(nearest, "directory").select(
        "uid", F.col("up.grant.licence").alias("licence"), F.col("up.grant.score").alias("score"), F.col("up.ancestor").alias("origin")
    )
    result = own.select("uid", "licence", "score", F.lit("self").alias("origin")).unionByName(inherited)
    joined = table.drop("present", "statements", "said", "opening").join(result, "uid", "left")
    return held.restored(joined, {"licence": F.col("licence"), "licence_score": F.col("score"), "licence_from": F.col("origin")}, without=what)


def _notice_terms(notice: str) -> list[str]:
    return re.findall(_TERM, notice.lower())


def as_files(documents: DataFrame) -> DataFrame:
    """The documents as a tree of files: source / language / thousand of ids; every 20th id is a licence file, every 500th that of its source."""
    i = F.col("doc_id")
    name = F.when(i % 20 == 0, F.lit("LICENSE")).otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    inner = F.concat_ws("/", "source", "lang", F.floor(i / 1000).cast("string"), name)
    return documents.select("doc_id", F.when(i % 500 == 0, F.concat_ws("/", "source", F.lit("LICENSE"))).otherwise(inner).alias("path"), "text")


def report(documents: DataFrame) -> DataFrame:
    return scan(as_files(documents)).select("doc_id", "path", "licence", "licence_score", "licence_from")
