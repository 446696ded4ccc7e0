"""Merkle manifest, fill-in-the-middle and nearest neighbours."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import ann, fim, merkle
from fieldlens.session import Scratch
from tests.conftest import SF_SMALL

H = lambda *p: hashlib.sha256("".join(p).encode()).hexdigest()
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# ---- Merkle manifest

def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, add=0):
    n = None if r["n_chars"] is None else r["n_chars"] + add
    return H(*[framed(x) for x in (r["doc_id"], r["source"], r["lang"], n, r["text"])])


def tree(nodes, fanout):
    """(root, siblings left and right of each node level by level), by hand."""
    paths, level = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, members = [], []
        for lo in range(0, len(nodes), fanout):
            run = nodes[lo:lo + fanout]
            for j in range(len(run)):
                for i in level[lo + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(H(*run))
            members.append(sum(level[lo:lo + fanout], []))
        nodes, level = up, members
    return nodes[0], paths


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    parts = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        parts[g] = tree([leaf_of(r) for r in groups[g]], fanout)
    root, crown = tree([parts[g][0] for g in names], fanout) if names else (None, [])
    out = []
    for g, up in zip(names, crown):
        for r, path in zip(groups[g], parts[g][1]):
            full = path + up
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf_of(r, 1 if tampered else 0)
            for left, right in full:
                folded = H(left, folded, right)
            out.append((r["doc_id"], leaf_of(r), parts[g][0], root, H(*[a + b for a, b in full]), folded, folded == root))
    return sorted(out, key=str)


def odd_docs(n, seed):
    rng = random.Random(seed)
    rows = [dict(doc_id=rng.choice([None, rng.randrange(n), 10**15 + rng.randrange(5)]), text=rng.choice([None, "", "é" * 3, "x"]),
                 lang=rng.choice([None, "", "en", "en", "en", "é", "zz"]), source=rng.choice([None, "s", ""]),
                 n_chars=rng.choice([None, 0, 7, -1])) for _ in range(n)]
    return rows + rows[:n // 3] + [dict(doc_id=3, text="long " * 200_000, lang="solo", source="s", n_chars=5)]


def digests(m):
    return m.select("doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("p"),
                    merkle.fold(F.col("seen"), F.col("path")).alias("f"),
                    (merkle.fold(F.col("seen"), F.col("path")) == F.col("root")).alias("ok"))


def seen():
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.leaf_hash([n if c == "n_chars" else F.col(c) for c in merkle.FIELDS])


@pytest.mark.parametrize("n, fanout, block", [(1, 2, 4), (90, 2, 4), (90, 3, 9), (41, 5, 1024)])
def test_manifest_equals_a_tree_built_by_hand(spark, n, fanout, block):
    rows = odd_docs(n, n + fanout)
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOC)
    df = df.select("*", F.lit(1).alias("g"), F.lit(2).alias("pos"), F.lit("h").alias("h"), F.lit(3).alias("_fl_blk"),
                   F.lit(4).alias("leaf"), F.lit(5).alias("a.b"), F.create_map(F.lit(1), F.lit(2)).alias("row"))
    with Scratch(spark, "t") as scratch:
        got = digests(merkle.merkle_manifest(df, scratch, fanout=fanout, block_rows=block, extra={"seen": seen()})).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, fanout)
    assert any(not r["ok"] for r in got) or n == 1


def test_manifest_of_an_empty_table(spark):
    with Scratch(spark, "t") as scratch:
        assert merkle.merkle_manifest(spark.createDataFrame([], DOC), scratch).collect() == []


def test_manifest_of_a_group_that_holds_most_rows_in_many_blocks(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                  F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("n_chars"))
    rows = [r.asDict() for r in df.collect()]
    with Scratch(spark, "t") as scratch:
        got = digests(merkle.merkle_manifest(df, scratch, block_rows=16, extra={"seen": seen()})).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


# ---- fill in the middle

def test_rotation_and_inverse():
    rng = random.Random(3)
    for _ in range(300):
        t = "".join(rng.choice("ab<>PSM é𝄞\n") for _ in range(rng.randrange(40)))
        if any(s.decode() in t for s in fim.SENTINELS):
            continue
        a, b = sorted(rng.randrange(len(t) + 1) for _ in range(2))
        off, data = fim.code_points(t.encode()), t.encode()
        pre, mid, suf = t[:a], t[a:b], t[b:]
        want = {fim.PLAIN: t, fim.PSM: f"<P>{pre}<S>{suf}<M>{mid}", fim.SPM: f"<S>{suf}<P>{pre}<M>{mid}"}
        for form, text in want.items():
            out = fim.transform(data, form, int(off[a]), int(off[b]))
            assert out.decode() == text
            assert fim.invert(out, form) == data


def by_hand(i, t):
    t = t or ""
    d = hashlib.sha256(("1:" + ("" if i is None else str(i))).encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted(x % (len(t) + 1) for x in h[:2])
    form = "plain" if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90 else \
        "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": t, "psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}[form]
    return (i, len(t), form, None if form == "plain" else a, None if form == "plain" else b - a, out)


def test_operator_on_odd_rows(spark):
    rng = random.Random(5)
    docs = [(rng.choice([None, rng.randrange(200)]), rng.choice([None, "", "a", "é𝄞" * rng.randrange(9), "x <P> y", "q" * 30]))
            for _ in range(120)] + [(7, "wörd " * 300_000)] * 2
    df = spark.createDataFrame(docs, "doc_id bigint, text string").select(
        "*", F.lit(9).alias("form"), F.lit(8).alias("N"), F.lit("k").alias("a.b"), F.lit("r").alias("restored"),
        F.create_map(F.lit("x"), F.col("doc_id")).alias("m"))
    out = fim.restore(fim.fill_in_middle(df), out_col="back")
    assert out.columns == ["doc_id", "text", "a.b", "restored", "m", "n", "form", "prefix_chars", "middle_chars", "back"]
    rows = out.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"]) for r in rows), key=str) \
        == sorted((by_hand(*d) for d in docs), key=str)
    assert sorted(((r["doc_id"], r["back"]) for r in rows), key=str) == sorted(((i, t or "") for i, t in docs), key=str)
    assert fim.fill_in_middle(df.limit(0)).collect() == []


def test_some_documents_take_each_form(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n = {r[0]: r[1] for r in fim.fill_in_middle(docs).groupBy("form").count().collect()}
    assert set(n) == {"plain", "psm", "spm"} and n["psm"] > n["spm"]


# ---- nearest neighbours

def truth(ids, a, queries, k):
    """k largest inner products of each query row, itself left out."""
    out = {}
    for i in queries:
        s = ann.exact_scores(np.repeat(a[i:i + 1], len(a), 0), a)
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df, spark, every=20, k=20, **kw):
    with Scratch(spark, "t") as scratch:
        rows = ann.nearest(df, F.col("vec_id") % every == 0, scratch, k=k, **kw).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert all(len({x for x, _ in v}) == len(v) for v in out.values())
    return out


def recall(got, want):
    return np.mean([len({x for x, _ in got.get(q, [])} & {x for x, _ in w}) / len(w) for q, w in want.items()])


def frame(spark, ids, a):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, a)], "vec_id bigint, embedding array<float>")


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    ids, a = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    want = truth(ids, a, np.flatnonzero(ids % 20 == 0), 20)
    got = found(df, spark)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    for q, v in got.items():
        assert v == sorted(v, key=lambda x: (-x[1], x[0]))
        exact = dict(truth(ids, a, [int(np.flatnonzero(ids == q)[0])], len(ids))[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in v)
        break


@pytest.mark.parametrize("scale, bucket_rows", [(1.0, 4096), (30.0, 4096), (1.0, 2)])
def test_recall_with_other_norms_finer_buckets_and_small_blocks(spark, monkeypatch, scale, bucket_rows):
    monkeypatch.setattr(ann, "ROW_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(int(scale) + bucket_rows)
    n = 1500
    centre = rng.normal(size=(30, 24))
    a = centre[rng.integers(0, 30, n)] + 0.4 * rng.normal(size=(n, 24))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    a *= rng.uniform(1, scale, (n, 1))
    a = a.astype(np.float32).astype(float)
    ids = np.arange(n)
    got = found(frame(spark, ids, a), spark, every=30, k=10, bucket_rows=bucket_rows)
    assert recall(got, truth(ids, a, np.flatnonzero(ids % 30 == 0), 10)) >= 0.9


def test_equal_vectors_odd_vectors_and_ties(spark):
    bad = [(500, None), (520, [0.0, 0.0]), (540, [1.0, None]), (560, [float("nan"), 1.0]), (580, [float("inf"), 1.0]),
           (None, [1.0, 0.0]), (600, [])]
    same = [(i, [1.0, 0.0]) for i in range(200)]  # one vector, many ids: ties to the smaller id
    other = [(200, [0.6, 0.8]), (201, [0.0, 1.0]), (220, [5.0]), (221, [2.0])]
    df = spark.createDataFrame(bad + same + other + same[:50], "vec_id bigint, embedding array<double>").select(
        "*", F.lit(1).alias("id"), F.lit(2).alias("v"), F.lit(3).alias("vid"), F.lit(4).alias("a.b"),
        F.create_map(F.lit(1), F.lit(1)).alias("dim"))
    got = found(df, spark, k=5)
    assert set(got) == {*range(0, 201, 20), 220}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and {s for _, s in got[0]} == {1.0}
    assert [i for i, _ in got[40]] == [0, 1, 2, 3, 4]
    assert got[220] == [(221, 10.0)]
    assert found(df.limit(0), spark) == {}
    assert found(df.where("vec_id = 200"), spark) == {}


def test_a_row_that_repeats_an_id_with_another_vector_is_a_row_of_its_own(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.8, 0.6]), (1, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    with Scratch(spark, "t") as scratch:
        rows = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") == 0, scratch, k=3).collect())
    assert [(r[0], r[1], r[2], round(r[3], 9)) for r in rows] == [
        (0, 1, 0, 0.8), (0, 1, 0, 0.8), (0, 2, 1, 0.0), (0, 2, 1, 0.6)]
