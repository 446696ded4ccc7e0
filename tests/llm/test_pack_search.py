"""Packing, sharding, top-k and decontamination."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm import decontaminate as dec
from fieldlens.llm.packing import (
    bin_patterns, default_tokenizer, encode_bytes, nnls, pack_documents, plan_packing,
)
from fieldlens.llm.sharding import document_digest, draw_matrix, shuffle_shards
from fieldlens.llm.topk import _blocks, top_k
from fieldlens.session import Scratch
from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string"


def small_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


# ---- packing

def test_word_ids_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = [t for _, t in small_docs(spark)] + [
        "a\tb\x1cc d <|endoftext|>x <|STARTOFTEXT|> don't É ́q  12ab", "", None, "İstanbul ǅ ß ẞ ﬁ ñ.", "x.,y..", "É. ,", "…a。b"]
    tok = Tokenizer.from_file(default_tokenizer())
    for t, b in zip(texts, encode_bytes(texts)):
        assert np.frombuffer(b, "<u4").tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_nnls_and_patterns():
    rng = np.random.default_rng(1)
    a = rng.random((30, 12))
    x = np.where(rng.random(12) < 0.5, 0, rng.random(12))
    assert np.allclose(nnls(a, a @ x), x, atol=1e-6)
    y = rng.normal(size=30)
    z = nnls(a, y)
    grad = a.T @ (y - a @ z)  # optimal: no gain left, and none for free columns
    assert (z >= 0).all() and (grad < 1e-6).all() and np.allclose(grad[z > 0], 0, atol=1e-6)
    pats = bin_patterns(8, 3)
    assert all(sum(p) == 8 and list(p) == sorted(p, reverse=True) for p in pats)
    assert len(pats) == len(set(pats)) == 1 + 4 + 5


def test_nnls_on_overlapping_patterns_equals_brute_force():
    """Bins stand in many patterns, so the columns depend on each other; the
    least residual over every set of columns is the one nnls finds."""
    pats = bin_patterns(6, 3)
    a = np.array([[p.count(b) for p in pats] for b in range(1, 7)], dtype=float)
    assert np.abs(a.T @ a - np.diag(np.diag(a.T @ a))).max() > 0
    rng = np.random.default_rng(3)
    for y in [rng.integers(0, 50, 6).astype(float) for _ in range(20)] + [np.zeros(6)]:
        best = float(y @ y)
        for r in range(1, 7):
            for cols in combinations(range(len(pats)), r):
                x = np.linalg.lstsq(a[:, cols], y, rcond=None)[0]
                if (x >= -1e-9).all():
                    best = min(best, float(((a[:, cols] @ x - y) ** 2).sum()))
        z = nnls(a, y)
        assert (z >= 0).all() and abs(float(((a @ z - y) ** 2).sum()) - best) < 1e-6


def test_patterns_save_sequences_where_best_fit_does_not():
    rng = np.random.default_rng(1)
    for low, high in ((400, 1100), (513, 1000)):
        hist = Counter(rng.integers(low, high, 20000).tolist())
        plan, alone = plan_packing(hist), plan_packing(hist, grids=((1, 0, 0),))
        assert alone.fitted == 0 and plan.fitted > sum(hist.values()) / 2
        assert plan.sequences < 0.97 * alone.sequences


@pytest.mark.parametrize("n", [0, 1, 7, 300, 60000])
def test_plan_places_every_piece_once(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(6, 1.2, n).astype(int), 1, 2048)
    hist = Counter(lengths.tolist())
    plan = plan_packing(hist)
    ranks, seqs = {}, {}
    for length, rank, count, seq, at in plan.slots:
        assert ranks.get(length, 0) == rank
        ranks[length] = rank + count
        for s in range(seq, seq + count):
            seqs.setdefault(s, []).append((at, length))
    assert ranks == dict(hist) and sorted(seqs) == list(range(plan.sequences))
    for parts in seqs.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= 2048
    if n >= 300:
        assert plan.sequences <= 1.02 * lengths.sum() / 2048 + 1


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    rows = small_docs(spark) + [(None, None), (None, ""), (900, None), (901, "tic " * 9000), (901, "tic " * 9000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("piece", F.lit("x")).withColumn("length", F.lit(1)).repartition(4)
    with Scratch(spark, "t") as sc:
        got = pack_documents(df, sc).collect()
        assert pack_documents(df.limit(0), sc).count() == 0
    want = []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want.append((i, k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 2048
    assert len(by) <= 1.05 * sum(w[3] for w in want) / 2048 + 2


def test_copies_of_a_piece_spread_over_the_slices(spark, monkeypatch):
    from fieldlens.llm import packing
    from fieldlens.llm.common import unit_hash

    seen = []

    def spy(df, group, order, out, **kw):
        seen.append([r[0] for r in df.groupBy(F.floor(unit_hash(*order, seed=11) * 8)).agg(F.count("*")).select("count(1)").collect()])
        return rank_in_groups(df, group, order, out, **kw)

    rank_in_groups = packing.rank_in_groups
    monkeypatch.setattr(packing, "rank_in_groups", spy)
    df = spark.createDataFrame([(1, "one two three")] * 400 + [(2, "four")] * 3, DOCS).repartition(4)
    with Scratch(spark, "t") as sc:
        got = pack_documents(df, sc).collect()
    assert len(got) == 403 and len({(r.sequence_id, r.offset) for r in got}) == 403
    assert sum(seen[0]) == 403 and max(seen[0]) < 120


def test_token_ids_pass_no_worker_after_they_are_cut(spark):
    """Only row numbers and lengths are ranked and looked up; ids come by a join."""
    df = spark.createDataFrame(small_docs(spark)[:50], DOCS).repartition(3)
    with Scratch(spark, "t") as sc:
        out = pack_documents(df, sc, with_ids=True)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        arrow = [x for x in plan.split("\n") if "MapInArrow" in x]
        below = [x for x in plan[plan.index("MapInArrow"):].split("\n") if "Relation" not in x]
        assert len(arrow) == 1 and any("Window" in x for x in below) and not any(re.search(r"\bids#", x) for x in below)
        rows = out.collect()
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    text = {i: b + bytes(4) for i, b in zip([i for i, _ in small_docs(spark)[:50]], encode_bytes([t for _, t in small_docs(spark)[:50]]))}
    assert all(r.ids == text[r.doc_id][4 * r.start:4 * (r.start + r.length)] for r in rows)


# ---- sharding

def test_matrix_has_exact_margins_and_the_right_spread():
    m = draw_matrix([10, 0, 33, 7], 24, 3)
    assert m.sum(1).tolist() == [10, 0, 33, 7] and set(m.sum(0).tolist()) == {2, 3}
    cell = [draw_matrix([50, 50], 4, s)[0, 0] for s in range(3000)]
    assert abs(np.mean(cell) - 12.5) < 0.2  # hypergeometric: 50 of 100 rows, 25 places
    assert abs(np.var(cell) - 50 * .25 * .75 * 50 / 99) < 0.5


def test_shards_are_exact_and_keep_every_row(spark):
    rows = small_docs(spark) + [(None, None)] * 3 + [(5, "")] * 90 + [(6, "copy")] * 200
    df = spark.createDataFrame(rows, DOCS).withColumn("SLOT", F.lit("x")).repartition(6)
    digest = document_digest(df)
    with Scratch(spark, "t") as sc:
        got = shuffle_shards(digest, sc).collect()
        wide = shuffle_shards(df, sc, n_shards=5, rows_per_block=10)
        assert wide.columns == ["doc_id", "text", "shard", "slot"]
        sizes5 = Counter(r.shard for r in wide.collect())
        assert shuffle_shards(digest.limit(0), sc).count() == 0
        odd = df.select("doc_id", F.lit(1).alias("__row"), F.lit(2).alias("__block"), F.lit(3).alias("__r"),
                        F.lit(4).alias("__ends"), F.lit(5).alias("__slice"), F.lit(6).alias("__first"),
                        F.lit(7).alias("a.b`c"), F.create_map(F.lit("k"), F.lit(8)).alias("m"))
        placed = shuffle_shards(odd, sc)
        assert placed.columns == [*odd.columns, "shard", "slot"]
        assert {tuple(r)[1:8] for r in placed.drop("m").collect()} == {(1, 2, 3, 4, 5, 6, 7)}
        few = Counter(r.shard for r in shuffle_shards(digest.limit(3), sc).collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(24))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes5.values()) - min(sizes5.values()) <= 1 and sorted(few.values()) == [1, 1, 1]


def test_shuffle_is_uniform(spark):
    """Over seeds, a row's shard and order do not depend on where it lies."""
    df = spark.range(200).selectExpr("id as doc_id").repartition(3)
    first = Counter()
    for seed in range(20, 80):
        with Scratch(spark, "t") as sc:
            for r in shuffle_shards(df, sc, n_shards=2, seed=seed).collect():
                if r.shard == 0 and r.slot < 50:
                    first[r.doc_id] += 1
        if seed == 31:
            break
    hits = np.array([first[i] for i in range(200)])  # 12 draws with probability 1/4 each
    assert abs(hits.mean() - 3) < 0.01 and hits.var() < 6 and hits[:100].sum() / hits.sum() < 0.62


# ---- top-k

def slow_top(rows, k=5):
    def ints(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(256 * float(np.float32(x)))) for x in v]

    vs = [(i, ints(v)) for i, v in rows if i is not None and ints(v) is not None]
    out, seen = [], set()
    for q, v in vs:
        if q % 50 or (q, tuple(v)) in seen:
            continue
        seen.add((q, tuple(v)))
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vs if i != q and len(w) == len(v))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=12).astype("f4").tolist()) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a group of copies, ties to the smaller id
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * 10), (2100, [float("nan")] + [0.0] * 11),
             (2150, [float("inf")] * 12), (2200, []), (2201, []), (2250, [1.0, 2.0]), (2251, [3.0, -1.0]),
             (2300, [3e30] + [0.0] * 11), (None, rows[3][1]), (33, rows[9][1])]
    rows = [r for r in rows if r[0] != 2300] + [(2300, [3e6] + [1e6] * 11)]  # beyond exact float products
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("x")).repartition(5)
    with Scratch(spark, "t") as sc:
        got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, sc).collect())
        assert top_k(df.limit(0), F.col("vec_id") % 50 == 0, sc).count() == 0
    assert got == slow_top(rows)


def test_rows_that_repeat_an_id_spread_over_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [(77, rng.normal(size=4).astype("f4").tolist()) for _ in range(2000)]
    rows += [(i, rng.normal(size=4).astype("f4").tolist()) for i in range(1000, 1400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    dealt = df.selectExpr("vec_id AS id", "transform(embedding, x -> bigint(256 * x)) AS v",
                          "monotonically_increasing_id() AS row")
    with Scratch(spark, "t") as sc:
        sizes = [r[0] for r in _blocks(sc.table(dealt, "dealt"), 100, 1).select(F.size("rows")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 200
    with Scratch(spark, "t") as sc:
        got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, sc).collect())
    assert got == slow_top(rows)


def test_pivots_exclude_blocks_of_clustered_vectors(spark):
    """On 40 tight clusters most pairs are never evaluated, on one hot cluster
    that holds a third of the rows too; the result is exact."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 10
    at = np.where(rng.random(6000) < 1 / 3, 0, rng.integers(0, 40, 6000))
    x = (centres[at] + rng.normal(size=(6000, 8)) * 0.05).astype("f4")
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    count = spark.sparkContext.accumulator(0)
    with Scratch(spark, "t") as sc:
        got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, sc, evaluated=count).collect())
    whole = np.floor(256 * x.astype(float)).astype(np.int64)
    want = []
    for q in range(0, 6000, 50):
        s = whole @ whole[q]
        s[q] = -2**62
        best = np.lexsort((np.arange(6000), -s))[:5]
        want += [(q, r + 1, int(c), int(s[c])) for r, c in enumerate(best)]
    assert got == sorted(want)
    assert count.value < 0.5 * 120 * 6000


# ---- decontamination

def slow_marks(docs, items, window=10):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    wins = []
    for i, t in items:
        w = words(t)
        wins += [(i, w[a:a + window]) for a in range(max(1, len(w) - window + 1))] if w else []
    out = []
    for d, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for i, x in wins:
            for a in range(len(w) - len(x) + 1):
                if w[a:a + len(x)] == x:
                    hit.update(range(a, a + len(x)))
                    ids |= {str(i)} if i is not None else set()
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [dec.BLOCK_BYTES, 200])
def test_decontamination_brute_force(spark, monkeypatch, block):
    rng = random.Random(1)
    vocab = ["alpha", "Beta", "gamma", "straße", "x1", "né", "the", "of"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(8, 25)))) for i in range(12)]
    items += [(50, "one two three"), (51, "- , -"), (52, None), (None, "four five"), (50, "one two three"), (53, "x1")]
    docs = []
    for i in range(40):
        w = rng.choices(vocab[:4], k=30)
        src = items[rng.randrange(12)][1].split()
        w[10:10] = src[rng.randrange(3):][:rng.randrange(5, 20)]
        docs.append((i, (" ", ", ", "\n")[i % 3].join(w).upper() if i % 2 else " ".join(w)))
    docs += [(60, None), (61, ""), (62, "ONE two; three one two"), (None, "four-five"), (62, "ONE two; three one two"),
             (63, "z " * 50000 + items[0][1]), (64, "one twothree"), (65, "x1x1 x1")]
    df = spark.createDataFrame(docs, DOCS).withColumn("hits", F.lit(1)).withColumn("n_words", F.lit(2)).repartition(3)
    its = spark.createDataFrame(items, "item_id bigint, text string").withColumn("id", F.lit(1))
    monkeypatch.setattr(dec, "BLOCK_BYTES", block)
    monkeypatch.setattr(dec.mark_contamination, "__defaults__", tuple(
        block if x == 8 << 20 else x for x in dec.mark_contamination.__defaults__))
    assert sorted((tuple(r) for r in dec.contamination_report(df, its).collect()), key=str) == slow_marks(docs, items)
    kept = dec.drop_contaminated(df, its)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (r[0] for r in slow_marks(docs, items) if not r[5]), key=str)
    marked = dec.mark_contamination(df.filter("doc_id = 62").limit(1), its).head()
    spans = [marked.text.encode()[s.first_byte:s.end_byte] for s in marked.hits.spans]
    assert spans == [b"ONE two; three"] and marked.hits["items"] == ["50"]
    assert dec.contamination_report(df, its.limit(0)).filter("contaminated").count() == 0
    assert dec.contamination_report(df.limit(0), its).count() == 0
