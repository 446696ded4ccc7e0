"""Near duplicates, line dedup and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldlens.llm import suffix_dedup
from fieldlens.llm.components import connected_components
from fieldlens.llm.line_dedup import drop_boilerplate
from fieldlens.llm.simhash import (
    BKTree, drop_near_duplicates, fingerprint_links, near_duplicates, simhash,
)
from fieldlens.llm.suffix_dedup import pack, repeated_spans, unpack
from fieldlens.session import Scratch
from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string"


def small_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def slow_simhash(text, k=3):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_components(rows):
    """(id, fingerprint, smallest reachable id) of every row."""
    fps = [slow_simhash(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    part = groups_of(range(len(rows)), near)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[part[i]] = min(d, low.get(part[i], d))
    return sorted(((d, f"{fps[i]:016x}", low.get(part[i])) for i, (d, _) in enumerate(rows)), key=str)


def test_bk_tree_finds_all_within_radius():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1)
                   for b in base for _ in range(20)})
    tree = BKTree(values)
    for q in values[:50] + [rng.getrandbits(64)]:
        got = sorted(tree.nodes[i] for i in tree.within(q, 3))
        assert got == sorted(v for v in values if (v ^ q).bit_count() <= 3)


def test_simhash_matches_the_rule():
    texts = ["", None, " \t\n", "One", "one TWO", "a b c", "A b  c\nd e f g", "é É ß\x85x y z", "w " * 9000]
    for t in texts:
        assert int.from_bytes(simhash(None if t is None else t.encode()), "big") == slow_simhash(t)


def test_links_across_shards_connect_like_brute_force(spark):
    """Tiny shards force the many-tree path; dense balls and far points."""
    rng = random.Random(5)
    values = set()
    for _ in range(4):
        c = rng.getrandbits(64)
        for _ in range(60):
            v = c
            for _ in range(rng.randrange(5)):
                v ^= 1 << rng.randrange(12)
            values.add(v)
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    with Scratch(spark, "t") as sc:
        fps = sc.table(spark.createDataFrame(signed, "fp bigint"), "fps")
        links = sc.table(fingerprint_links(fps, sc, 3, shard=7), "links")
        got = {tuple(r) for r in connected_components(links, sc).collect()}
    want = groups_of([s for s, in signed], [
        (a, b) for a, in signed for b, in signed if a < b and (a ^ b).bit_count() % 65 <= 3 and ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    linked = {n: c for n, c in want.items() if list(want.values()).count(c) > 1}
    assert got == set(linked.items())


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    with Scratch(spark, "t") as sc:
        df = spark.createDataFrame(chain + star + [(7, 7), (None, 3)], "a bigint, b bigint")
        got = {tuple(r) for r in connected_components(df, sc).collect()}
        none = connected_components(df.filter("a = 7 and b = 7"), sc).count()
    assert got == {(i, 0) for i in range(41)} | {(1000 + i, 1000) for i in range(300)}
    assert none == 0


@pytest.fixture(scope="module")
def odd_rows(spark):
    rows = small_docs(spark)
    return rows + [(None, rows[3][1]), (None, None), (None, "only here with no id at all"), (3, rows[5][1]),
                   (5, rows[5][1]), (5, rows[5][1]), (7000, ""), (7001, None), (-8, rows[11][1] + " end"),
                   (7002, "x" * 30000), (7003, "word " * 20000)]


def test_near_duplicates_brute_force(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, DOCS).withColumn("fp", F.lit(1)).withColumn("id", F.lit("x")).repartition(3)
    with Scratch(spark, "t") as sc:
        got = sorted((tuple(r) for r in near_duplicates(df, sc).collect()), key=str)
        empty = near_duplicates(df.limit(0), sc).count()
    assert got == slow_components(odd_rows)
    assert empty == 0


def test_one_document_of_each_group_stays(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, DOCS).withColumn("keep", F.lit(2)).withColumn("n", F.col("text")) \
        .withColumn("a.b`c", F.lit(3)).withColumn("m", F.create_map(F.lit("k"), F.col("text"))).withColumn("__row", F.lit(1))
    with Scratch(spark, "t") as sc:
        kept = drop_near_duplicates(df, sc)
        assert kept.columns == df.columns
        ids = sorted((r.doc_id for r in kept.collect()), key=str)
    fps = [slow_simhash(t) for _, t in odd_rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    part = groups_of(range(len(fps)), near)
    names = {}
    for i, (d, _) in enumerate(odd_rows):
        names.setdefault(part[i], []).append(d)
    assert ids == sorted((min((d for d in g if d is not None), default=None) for g in names.values()), key=str)


def slow_boilerplate(rows, least=8, words=4):
    """(boilerplate lines, first holder of every line) of (id, text, site)."""
    sites, held, first = {}, Counter(), {}
    size = Counter(s for _, _, s in rows if s is not None)
    bins = {}
    for n in size.values():
        bins.setdefault(n.bit_length(), []).append(n)
    for d, t, s in rows:
        for x in {y.strip(" ") for y in (t or "").split("\n")} - {""}:
            if s is not None:
                sites.setdefault(x, set()).add(s)
                held[x] += 1
            if d is not None:
                first[x] = min(d, first.get(x, d))
    bad = set()
    for x, on in sites.items():
        miss = [(len(b), (1 - sum(b) / len(b) / sum(size.values())) ** held[x]) for b in bins.values()]
        mean, var = sum(k * (1 - q) for k, q in miss), sum(k * q * (1 - q) for k, q in miss)
        if len(on) >= max(least, round(mean - 2 * var ** 0.5, 6)) and len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= words:
            bad.add(x)
    return bad, first


def test_line_dedup_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        lines = [f"own line {i}", "", " Subscribe now to our\tletter "]
        if i % 5 == 0:
            lines.append("And so it.")  # prose: too short to be boilerplate
        if i % 23 < 9:
            lines.append("nine of all the sites")  # 9 sites, far fewer than chance
        if i % 3 == 0:
            lines.append("spread over some sites %d" % (i % 14))
        if i % 2:
            lines.append("two sites only")
        rng.shuffle(lines)
        src = None if i % 50 == 0 else f"s{i % 2 if 'two sites only' in lines and i % 2 else i % 23}"
        rows.append((i if i % 97 else None, "\n".join(lines), src))
    rows += [(900, None, "s1"), (901, "", "s2"), (902, "\n\n", "s3"), rows[5], rows[5], (903, "y" * 50000, "s1")]
    bad, first = slow_boilerplate(rows)
    assert "Subscribe now to our\tletter" in bad and not {"And so it.", "nine of all the sites"} & bad
    want = []
    for d, t, s in rows:
        cut = [x for x in (t or "").split("\n") if not (
            x.strip(" ") in bad and d != first.get(x.strip(" ")))]
        n = len((t or "").split("\n")) - len(cut)
        want.append((d, t if t is None or not n else "\n".join(cut), s, n))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    clash = df.withColumn("bad", F.lit(1)).withColumn("TX", F.lit("q")).withColumn("first", F.lit(0)) \
        .withColumn("a.b`c", F.lit(3)).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    with Scratch(spark, "t") as sc:
        got = drop_boilerplate(df, sc, removed="cut").collect()
        same = drop_boilerplate(clash, sc)
        assert same.columns == clash.columns and same.count() == len(rows)
        assert drop_boilerplate(df.limit(0), sc).count() == 0
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r[3] for r in want) > 300


def slow_spans(rows, depth=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - depth + 1 if i is not None else 0):
            w = b[k:k + depth]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - depth + 1 if i is not None else 0):
            if first[b[k:k + depth]] < i:
                gone[k:k + depth] = b"\1" * depth
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup_brute_force(spark, hot):
    rows = small_docs(spark)[:120]
    rows += [(None, rows[3][1]), (3, rows[5][1]), (5, rows[5][1]), (1000, "a" * 3000), (1001, "a" * 70),
             (1002, "ab" * 400), (1003, None), (1004, ""), (1005, "x" * 49), (1006, rows[0][1][40:120] * 3),
             (1007, "a" * 60000 + "b"), (-4, rows[9][1][100:400]), (1008, "é" * 90), (1009, "é" * 60)]
    df = spark.createDataFrame(rows, DOCS).withColumn("block", F.lit(0)).repartition(5)
    with Scratch(spark, "t") as sc:
        got = [(r.doc_id, r.n_bytes, sum(s.end_byte - s.first_byte for s in r.spans), len(r.spans), r.kept_sha256,
                bytes(r.kept)) for r in repeated_spans(df, sc, with_kept=True, hot=hot).collect()]
        assert repeated_spans(df.limit(0), sc, hot=hot).count() == 0
    assert sorted(got, key=str) == slow_spans(rows)


def phrase_docs(n):
    """A phrase in differing surroundings, of which a few repeat."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=60))
    ends = [word() for _ in range(5)]
    rows = [(i, word() + "the phrase that stands in every document, whatever" + (ends[i % 5] if i % 3 else word()))
            for i in range(n)]
    return rows + [(n + i, rows[i][1]) for i in range(20)]


def test_anchor_larger_than_a_part_is_dealt_by_window():
    """One block already holds more regions of an anchor than a part may."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    texts = [t.encode() for _, t in phrase_docs(2000)]
    cols = (pack(np.arange(len(texts), dtype="<i8")), pack(np.ones(len(texts), "u1")),
            pack(np.cumsum([len(t) for t in texts]).astype("<i8")), zstandard.compress(b"".join(texts)))
    h, low, high, regions = suffix_dedup._block_anchors(suffix_dedup.Block(*cols))
    assert 1500 < regions.max() <= 2000
    rows = pa.table({"block": [0], "packed": [pack(h, low, high - low, regions.astype("<u4"))]})
    most = []
    for limit in (10**6, 100):
        shared = suffix_dedup._shared_anchors(rows, 4096, limit)
        got = suffix_dedup._regions(pa.table({"block": [0], **{k: [v] for k, v in zip(
            ("ids", "known", "ends", "texts"), cols)}}), shared, 64).to_pylist()
        most.append(max(len(unpack(r["packed"], "<u4", "<i8", "<u4")[0]) for r in got if r["kind"] == "R"))
    assert most[0] > 1500
    windows = sum(len(unpack(r["packed"], "<u4", "<i8", "<u4")[0]) for r in got if r["kind"] == "R")
    assert most[1] < 2 * windows / 64


def test_large_anchors_give_the_same_spans(spark):
    rows = phrase_docs(300)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    with Scratch(spark, "t") as sc:
        got = [(r.doc_id, r.n_bytes, sum(s.end_byte - s.first_byte for s in r.spans), len(r.spans), r.kept_sha256,
                bytes(r.kept)) for r in repeated_spans(df, sc, with_kept=True, part_bytes=4000).collect()]
    assert sorted(got, key=str) == slow_spans(rows)


def test_packed_arrays_round_trip():
    import numpy as np

    a, b = np.array([1, 2**40, 5], "<i8"), np.zeros(0, "<u4")
    x, y = unpack(pack(a, b), "<i8", "<u4")
    assert x.tolist() == a.tolist() and y.tolist() == []
