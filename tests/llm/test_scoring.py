"""Toxicity, quality and license scan."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm.license_scan import (
    APACHE_NOTICE, BASE, BSD_TEXT, GPL_NOTICE, MIT_TEXT, TEMPLATES, gram_positions, scan_licenses,
)
from fieldlens.llm.quality import (
    LABELLERS, fit_labellers, fit_scorer, keep_good, score_quality, shape, slots, train_quality, votes,
)
from fieldlens.llm.toxicity import (
    DIM, NoisyOr, fit_noisy_or, held_out, score_toxicity, sentence_words, train_toxicity, word_slots,
)
from fieldlens.session import Scratch

SF = "/root/testdata/sf0.1"
DOCS = "doc_id bigint, text string"


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_held_out_accuracy_and_place(spark, tables):
    docs, labels = tables
    model = train_toxicity(docs, labels)
    rows = score_toxicity(docs.join(labels, "doc_id").filter(held_out()), model).select(
        "text", "toxic", "toxicity").collect()
    y = np.array([r.toxic for r in rows])
    s = np.array([r.toxicity.score for r in rows])
    assert auc(s, y) > 0.95
    assert ((s >= 0.3) == (y == 1)).mean() > 0.95
    for r in rows:  # the noisy-or of the sentences, and spans that hold them
        ps = [model.sentence(w) for w in sentence_words(r.text.encode())]
        assert r.toxicity.sentences == len(ps)
        assert abs(r.toxicity.score - (1 - np.prod([1 - p for p in ps]))) < 1e-9
        want = [w for w, p in zip(sentence_words(r.text.encode()), ps) if p >= 0.3]
        got = [sentence_words(r.text.encode()[o.first_byte:o.end_byte]) for o in r.toxicity.offending]
        assert got == [[w] for w in want]


def test_toxicity_learns_only_from_the_training_part(spark):
    """Flipping the labels of the held-out part changes no weight."""
    rows = [(i, f"plain words here number{i}. " + ("vile insult. " if i % 3 == 0 else "kind remark. "), int(i % 3 == 0))
            for i in range(300)]
    df = spark.createDataFrame(rows, DOCS + ", toxic int")
    flipped = df.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (train_toxicity(df.drop("toxic"), x) for x in (df, flipped))
    assert a.weights == b.weights and a.bias == b.bias
    out = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(300)]
    assert [r[0] for r in df.orderBy("doc_id").select(held_out()).collect()] == out
    assert a.score(b"some vile insult")[0] > 0.3 > a.score(b"some kind remark")[0]


def test_toxicity_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "vile insult"), (2, ""), (3, " .!? "), (4, "word. " * 30000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("toxicity", F.lit(1)).withColumn("t", F.lit("x")) \
        .withColumn("a.b`c", F.lit(3)).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, None)], "doc_id bigint, toxic int")
    model = train_toxicity(df, labels)
    got = {(r.doc_id, r.text): r.toxicity for r in score_toxicity(df, model).collect()}
    assert score_toxicity(df, model).count() == len(rows)
    assert got[(1, None)].score == 0 and got[(3, " .!? ")].sentences == 0
    assert all(0 <= v.score <= 1 for v in got.values())
    assert score_toxicity(df.limit(0), model).count() == 0
    assert fit_noisy_or([]).score(b"anything at all")[0] < 1e-6
    w = np.zeros(DIM)
    w[word_slots(b"vile")[0]] = 30
    assert NoisyOr(w, -5.0).score("Ä. vile. ok".encode())[0] > 0.99


def test_quality_held_out_accuracy(spark, tables):
    docs, labels = tables
    with Scratch(spark, "t") as sc:
        posterior, scorer = train_quality(docs, sc)
    rows = score_quality(docs, scorer, posterior, out="judged").join(labels, "doc_id").select(
        "judged.score", F.col("quality").alias("y")).collect()
    keep = np.array([r.score >= 0.5 for r in rows])
    y = np.array([r.y for r in rows])
    assert keep[y == 1].mean() > 0.995
    assert (~keep[y == 0]).mean() > 0.95


def test_labeller_accuracies_are_recovered():
    """Synthetic votes: the posterior agrees with the hidden class."""
    rng = np.random.default_rng(0)
    counts, truth = {}, {}
    for _ in range(20000):
        good = rng.random() < 0.8
        v = tuple([0 if good or rng.random() > 0.5 else -1 for _ in range(len(LABELLERS) - 2)]
                  + [int(rng.choice([1, -1, 0], p=[.8, .1, .1] if good else [.2, .7, .1])) for _ in range(2)])
        counts[v] = counts.get(v, 0) + 1
        truth.setdefault(v, []).append(good)
    post = fit_labellers(counts)
    right = sum(sum(g == (post[v] >= 0.5) for g in gs) for v, gs in truth.items())
    assert right / 20000 > 0.97
    assert fit_labellers({}) == {}


def test_quality_odd_rows(spark):
    good = "The house of the old man is on the hill and it was built for the town. "
    rows = [(i, good * (1 + i % 4) + f"word{i}") for i in range(60)] + [
        (100 + i, "BUY!! NOW!! %s!! " % ("X" * i) * 30) for i in range(12)] + [
        (200, None), (200, None), (None, ""), (201, "a" * 60000), (202, "| " * 20000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("quality", F.lit("q")).withColumn("key", F.lit(1))
    with Scratch(spark, "t") as sc:
        kept = keep_good(df, sc)
        assert kept.columns == df.columns
        ids = [r.doc_id for r in kept.collect()]
        assert set(range(60)) <= set(ids) and not set(range(100, 112)) & set(ids) and 202 not in ids
        assert keep_good(df.limit(0), sc).count() == 0
    assert votes(None) == votes(b" \n") == (0,) * len(LABELLERS)
    assert shape(b"THE!!x42") == b"A!!a0"
    assert slots(None) == [] and len(slots(b"a a b")) == 8
    assert 0 < fit_scorer([]).score(b"x") < 1


def slow_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    found = set(labels)
    best = 0.0
    for t, (phrase, label) in enumerate((*BASE, *TEMPLATES)):
        p = re.findall(r"[0-9a-z]+", phrase.lower())
        grams = [p[i:i + 3] for i in range(len(p) - 2)]
        hits = {}
        for i in range(len(w) - 2):
            for j, g in enumerate(grams):
                if w[i:i + 3] == g:
                    hits.setdefault(i - j, set()).add(j)
        for d in hits:
            chain = [(-1, -1)]
            for at_doc, j in sorted((d + k + j, j) for k in range(-2, 3) for j in hits.get(d + k, ())):
                if at_doc > chain[-1][0] and j > chain[-1][1]:
                    chain.append((at_doc, j))
            cover = (len(chain) - 1) / len(grams)
            best = max(best, cover)
            if t >= len(BASE) and cover >= 0.6:
                found.add(label)
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
            ",".join(sorted(found)), best)


def test_pieces_out_of_order_do_not_count(spark):
    """Neighbouring diagonals that hold the template's pieces swapped or twice."""
    template = (("a b c d e f g h", "x"),)
    texts = ["a b c d e f g h", "a b c d x e f g h", "a b c d f g h", "d e f g b c d e", "c d e f c d e f"]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: round(r.score * 6) for r in scan_licenses(df, base=(), templates=template).collect()}
    assert got == {0: 6, 1: 4, 2: 3, 3: 2, 4: 2}


def test_license_scan_brute_force(spark):
    texts = ["Under the MIT License under the mit-license", "Apache License, Version 2.0", "cc by-nc", "CC BY", None, "",
             "Permission is hereby granted, totally free of charge, to any person obtaining a copy of this software",
             "redistribution and use in source or binary forms with or without any modification are permitted",
             "under the mit é license", "ünder the mit license under the mit license", "all rights reserved " * 3000,
             "x " * 20000 + "licensed under cc by nc 4 0", "Copyright A. Body\n" + MIT_TEXT + "end",
             BSD_TEXT.replace("warranties", "guarantees").replace("provided that", "as long as"),
             " ".join(MIT_TEXT.split()[:70]), " ".join(reversed(APACHE_NOTICE.split())),
             GPL_NOTICE.replace("along with this program", "with it") + APACHE_NOTICE]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (0, texts[0]), (0, texts[1]), (None, texts[2]), (None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("h", F.lit(1)).withColumn("mask", F.lit(2)).repartition(3)
    got = sorted((tuple(r)[:8] for r in scan_licenses(df).collect()), key=str)
    assert got == sorted(((i, *slow_scan(t)) for i, t in rows), key=str)
    assert scan_licenses(df.limit(0)).count() == 0
    odd = df.toDF("a.id", "a.b`c", "h", "mask").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    again = scan_licenses(odd, "a.id", "a.b`c").collect()
    assert sorted((tuple(r)[:8] for r in again), key=str) == got
    labels = {r.doc_id: r.labels for r in scan_licenses(df.filter("doc_id >= 12")).collect()}
    assert labels == {12: "mit", 13: "bsd", 14: "mit", 15: "", 16: "apache-2,gpl-3"}
    with pytest.raises(ValueError):
        gram_positions(base=(("two words", "x"),))
