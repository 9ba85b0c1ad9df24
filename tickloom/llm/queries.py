"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers

from tickloom.llm import bpe, decontaminate, fim, lexical, licences, linededup, oddsketch, pii, polytope, quality, rules, toxicity, wavelet
from tickloom.llm.common import written
from tickloom.llm.tables import read

QUERIES = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


@registered
def op2_decontaminate(spark, folder):
    return decontaminate.report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@registered
def op7_byte_bpe(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@registered
def op10_odd_sketches(spark, folder):
    return oddsketch.near_duplicates(read(spark, folder, "documents"), length=3, percent=85)


@registered
def op6_toxicity(spark, folder):
    return toxicity.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@registered
def op5_quality(spark, folder):
    return quality.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@registered
def op9_line_dedup(spark, folder):
    return linededup.report(read(spark, folder, "documents"))


@registered
def op4_pii(spark, folder):
    return pii.report(read(spark, folder, "documents"))


@registered
def op3_cross_polytope(spark, folder):
    return polytope.near_duplicates(read(spark, folder, "embeddings"), threshold=0.98)


@registered
def op8_wavelet_files(spark, folder):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return wavelet.digests(written(wavelet.shards(read(spark, folder, "documents"), vocabulary), "token-files"))


@registered
def op1_licences(spark, folder):
    return licences.report(read(spark, folder, "documents"))


@registered
def op11_fill_in_middle(spark, folder):
    return fim.report(read(spark, folder, "documents"))


@registered
def op12_boosted_rules(spark, folder):
    return rules.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@registered
def op13_bag_search(spark, folder):
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
