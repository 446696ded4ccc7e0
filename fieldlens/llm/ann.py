"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by a fast pseudo-rotation (three rounds of random signs
and a Hadamard transform) and hashed to the nearest signed axis of the turned
space.  ``tables`` independent rotations give as many tables; a query probes the
``probes`` axes nearest to it in each, and the rows found there are ranked by
their exact inner products.  Vectors need not be unit vectors: where norms differ
a row is scaled by the largest norm and gets one more component that makes it
one, a query is normalised, so the order by inner product is the order by
distance.

The number of probes is fitted: a bounded sample of the queries is searched
exactly in one pass over all rows, and the smallest power of two that finds
``target`` of those true neighbours is taken (all axes, if need be).  Every row
is indexed.

Scale: tables meet by an equi join on (table, bucket, block).  Buckets are cut
into blocks of bounded size, and where rows are many a second turn into fewer
dimensions refines the axes so that a bucket holds about ``bucket_rows``.  Equal
vectors are one entry with its smallest ids, enough for every query's answer, so
a vector that a third of the rows share costs one entry.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import table
from fieldlens.session import Scratch

TABLES = 8
TARGET = 0.95  # share of the sample's true neighbours that the probes must find
SAMPLE = 256  # queries searched exactly for the fit
BUCKET_ROWS = 4096
QUERY_BLOCK, ROW_BLOCK = 512, 4096


def usable(c: Column) -> Column:
    """Neither null nor zero, no null or non-finite component."""
    good = ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & good & F.exists(c, lambda x: x != 0)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Hadamard transform of every row (length a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class CrossPolytope:
    """The hash tables of vectors of one length."""

    def __init__(self, dim: int, low: float, top: float, rows: int, tables: int = TABLES,
                 bucket_rows: int = BUCKET_ROWS, seed: int = 13):
        self.dim, self.top, self.tables = dim, top, tables
        self.lifted = top - low > 1e-6 * top  # norms differ: one more component
        self.width = 1 << (dim - 1 + self.lifted).bit_length()
        axes, self.second = 2 * self.width, 0  # second turn: kept dimensions
        while rows > bucket_rows * axes * max(1, 2 * self.second) and self.second < self.width:
            self.second = max(1, 2 * self.second)
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice([-1.0, 1.0], (tables, 2, 3, self.width))
        self.buckets = axes * max(1, 2 * self.second)

    def units(self, v: np.ndarray, queries: bool) -> np.ndarray:
        out = np.zeros((len(v), self.width))
        big = np.abs(v).max(axis=1, keepdims=True)
        norm = np.linalg.norm(v / big, axis=1, keepdims=True) * big
        out[:, :self.dim] = v / self.top if self.lifted and not queries else v / norm
        if self.lifted and not queries:
            out[:, self.dim] = np.sqrt(np.maximum(0.0, 1 - (norm[:, 0] / self.top) ** 2))
        return out

    def axes(self, u: np.ndarray, t: int, part: int, keep: int) -> np.ndarray:
        """Distance-like cost of each signed axis (0 for the nearest)."""
        for signs in self.signs[t, part]:
            u = hadamard(u * signs)
        y = np.concatenate([u[:, :keep], -u[:, :keep]], axis=1)
        return (y.max(axis=1, keepdims=True) - y) ** 2

    def costs(self, u: np.ndarray, t: int) -> np.ndarray:
        """Cost of every bucket of table ``t``; the nearest bucket costs 0."""
        c = self.axes(u, t, 0, self.width)
        if self.second:
            c2 = self.axes(u, t, 1, self.second)
            c = (c[:, :, None] + c2[:, None, :]).reshape(len(u), -1)
        return c

    def home(self, u: np.ndarray, t: int) -> np.ndarray:
        h = self.axes(u, t, 0, self.width).argmin(axis=1)
        return h * 2 * self.second + self.axes(u, t, 1, self.second).argmin(axis=1) if self.second else h

    def probe(self, u: np.ndarray, t: int, probes: int) -> np.ndarray:
        """The ``probes`` nearest buckets of each row, ties to the lower number."""
        return np.argsort(self.costs(u, t), axis=1, kind="stable")[:, :probes]


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``, pair by pair."""
    return np.einsum("ij,ij->i", np.ascontiguousarray(a), np.ascontiguousarray(b))


def leaders(i: np.ndarray, tie: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest ``s`` of each ``i``, ties to the smaller ``tie``."""
    order = np.lexsort((tie, -s, i))
    i = i[order]
    starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
    rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)]))
    return order[rank < k]


def best_of(q: np.ndarray, c: np.ndarray, tie: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of c, score): the ``k`` largest inner products of each
    row of ``q``, the scores in double precision pair by pair."""
    s = q @ c.T
    if s.shape[1] > k:
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        last = np.take_along_axis(s, near, 1).min(axis=1, keepdims=True)
        # with the rows that tie with the last one within rounding
        i, j = np.nonzero(s >= last - 1e-12 * (np.abs(last) + np.abs(s).max()))
    else:
        i, j = (x.ravel() for x in np.indices(s.shape))
    exact = exact_scores(q[i], c[j])
    keep = leaders(i, tie[j], exact, k)
    return i[keep], j[keep], exact[keep]


def _rows(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, dim)


def sample_neighbours(entries: DataFrame, asked: DataFrame, dim: int, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, neighbours): of ``size`` queries (those whose vectors hash
    lowest) the ``k`` best entries but themselves, by one pass over all entries;
    both as vectors, the neighbours with their query's row as first column."""
    some = asked.orderBy(F.xxhash64(F.lit(5), "v"), "vid").limit(size).select("vid", "v").collect()
    if not some:
        return np.zeros((0, dim)), np.zeros((0, dim + 1))
    q = np.array([r["v"] for r in some], dtype=float).reshape(-1, dim)
    own = np.array([r["vid"] for r in some], dtype=np.int64)
    sent = entries.sparkSession.sparkContext.broadcast((q, own))

    def run(batches):
        q, own = sent.value
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for batch in batches:
            vid = batch.column(0).to_numpy()
            i, j, s = best_of(q, _rows(batch.column(1), dim), vid, k + 1)
            other = own[i] != vid[j]
            best = [np.concatenate(x) for x in zip(best, (i[other], vid[j[other]], s[other]))]
            keep = leaders(best[0], best[1], best[2], k)
            best = [x[keep] for x in best]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["q", "vid", "score"])

    near = entries.select("vid", "v").mapInArrow(run, "q bigint, vid bigint, score double")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
    top = near.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("q", "vid")
    rows = entries.select("vid", "v").join(top, "vid").select("q", "v").collect()
    sent.unpersist()
    return q, np.array([[r["q"], *r["v"]] for r in rows], dtype=float).reshape(-1, dim + 1)


def fit_probes(index: CrossPolytope, q: np.ndarray, neighbours: np.ndarray, target: float) -> int:
    """The smallest power of two of probes that finds ``target`` of the
    neighbours in some table; all buckets where no less will do."""
    if not len(neighbours):
        return 1
    who, rows = neighbours[:, 0].astype(int), index.units(neighbours[:, 1:], False)
    rank = np.full(len(who), index.buckets)
    for t in range(index.tables):
        cost = index.costs(index.units(q, True), t)[who]
        mine = np.take_along_axis(cost, index.home(rows, t)[:, None], 1)
        rank = np.minimum(rank, (cost < mine).sum(axis=1))
    probes = 1
    while probes < index.buckets and (rank < probes).mean() < target:
        probes *= 2
    return min(probes, index.buckets)


def _hashed(vectors: DataFrame, index: CrossPolytope, probes: int) -> DataFrame:
    """(tab, bucket, vid, first, v): each vector in its home bucket of every
    table, or as a query in its ``probes`` nearest ones (``probes`` > 0)."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(lo, QUERY_BLOCK)
                u = index.units(_rows(part.column(2), index.dim), probes > 0)
                for t in range(index.tables):
                    b = index.probe(u, t, probes) if probes else index.home(u, t)[:, None]
                    take = pa.array(np.repeat(np.arange(len(u)), b.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b.size, t), pa.int32()), pa.array(b.ravel(), pa.int64()),
                         *[c.take(take) for c in part.columns]], names=["tab", "bucket", "vid", "first", "v"])

    v = vectors.schema["v"].dataType.simpleString()
    return vectors.select("vid", "first", "v").mapInArrow(
        run, f"tab int, bucket bigint, vid bigint, first bigint, v {v}")


def _block_counts(hashed: DataFrame, size: int) -> DataFrame:
    return hashed.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / size).alias("parts"))


def _blocks(hashed: DataFrame, counts: DataFrame, prefix: str) -> DataFrame:
    """(tab, bucket, part, vids, firsts, vs): a bucket's rows in its blocks, dealt
    by a hash of the entry; the blocks of one bucket lie in many tasks."""
    part = F.pmod(F.xxhash64(F.lit(17), "vid"), F.col("parts")).alias("part")
    dealt = hashed.join(counts, ["tab", "bucket"]).select("tab", "bucket", part, F.struct("vid", "first", "v").alias("x"))
    return dealt.repartition("tab", "bucket", "part").groupBy("tab", "bucket", "part").agg(
        F.collect_list("x").alias("x")).select("tab", "bucket", "part", *[
            F.col(f"x.{c}").alias(f"{prefix}_{c}") for c in ("vid", "first", "v")])


def _search(entries: DataFrame, asked: DataFrame, index: CrossPolytope, probes: int, k: int,
            scratch: Scratch) -> DataFrame:
    """(query, vid, score): the ``k`` best entries of each asked vector among
    those in its probed buckets; an entry found in several tables once."""
    dim = index.dim
    rows = scratch.table(_hashed(entries, index, 0), f"rows{dim}")
    queries = scratch.table(_hashed(asked, index, probes), f"queries{dim}")
    parts = _block_counts(rows, ROW_BLOCK)
    q = _blocks(queries, _block_counts(queries, QUERY_BLOCK), "q").drop("part").join(parts, ["tab", "bucket"])
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    pairs = q.join(_blocks(rows, parts, "c"), ["tab", "bucket", "part"]).select(
        "q_vid", "q_v", "c_vid", "c_first", "c_v")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                q_vid, q_v, c_vid, c_first, c_v = (c.flatten() for c in batch.slice(r, 1).columns)
                i, j, s = best_of(_rows(q_v, dim), _rows(c_v, dim), c_first.to_numpy(), k)
                yield pa.RecordBatch.from_arrays(
                    [q_vid.take(pa.array(i)), c_vid.take(pa.array(j)), c_first.take(pa.array(j)), pa.array(s)],
                    names=["query", "vid", "first", "score"])

    found = pairs.mapInArrow(run, "query bigint, vid bigint, first bigint, score double")
    # one exchange by query serves the removal of repeats and the ranking
    once = found.repartition("query").groupBy("query", "vid", "first").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "first", "vid")
    return once.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).select("query", "vid", "score")


def nearest(df: DataFrame, is_query: Column, scratch: Scratch, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 20, tables: int = TABLES, target: float = TARGET, sample: int = SAMPLE,
            bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` picks, the
    nearest ``k`` rows found, by inner product, ties to the smaller id.

    Null or zero vectors, vectors with null or non-finite components and null
    ids take no part.  Rows that repeat an id and its vector count as one row;
    rows that repeat an id with other vectors are rows of their own, each a
    candidate for the other and with a list of its own.  Vectors are compared
    with vectors of their own length.  A query with fewer than ``k`` candidates
    gets those found.  An empty table gives no row.  Other columns are not
    read, whatever their names.
    """
    v = F.col(f"`{vec_col}`")
    if df.schema[vec_col].dataType.simpleString() != "array<float>":  # floats are exact as they are
        v = v.cast("array<double>")
    rows = scratch.table(
        df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v"),
                  F.coalesce(is_query, F.lit(False)).alias("asked"))
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .groupBy("id", "v").agg(F.max("asked").alias("asked")), "rows")
    # one entry a vector, with as many of its smallest ids as an answer can hold
    w = Window.partitionBy("v").orderBy("id")
    entries = scratch.table(
        rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select("v", "ids", F.col("ids")[0].alias("first"), F.size("v").alias("dim"),
                F.monotonically_increasing_id().alias("vid")), "entries")
    wanted = scratch.table(rows.where("asked").join(entries.select("v", "vid"), "v").select("id", "vid"), "wanted")
    asked = scratch.table(entries.join(wanted.select("vid").distinct(), "vid", "left_semi"), "asked")
    big = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    norm = F.sqrt(F.aggregate(F.transform("v", lambda x: x / F.col("big")), F.lit(0.0), lambda a, x: a + x * x)) * F.col("big")
    sizes = entries.withColumn("big", big).groupBy("dim").agg(
        F.min(norm).alias("low"), F.max(norm).alias("top"), F.count("*").alias("rows")).sort("dim").collect()
    found = []
    for dim, low, top, n in sizes:
        mine, ask = entries.where(F.col("dim") == dim), asked.where(F.col("dim") == dim)
        index = CrossPolytope(dim, low, top, n, tables, bucket_rows)
        probes = fit_probes(index, *sample_neighbours(mine, ask, dim, k, sample), target)
        # k + 1 entries, as a query's own entry may hold no other id
        found.append(scratch.table(_search(mine, ask, index, probes, k + 1, scratch), f"found{dim}"))
    if not found:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    # the best k + 1 rows of a vector's query, then each query row without its own
    each = hits.join(entries.select("vid", F.explode("ids").alias("id")), "vid")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "vid")
    lists = each.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("r", "id", "vid", "score"))).alias("near"))
    others = F.filter("near", lambda x: (x["id"] != F.col("query_id")) | (x["vid"] != F.col("query")))
    return wanted.select(F.col("id").alias("query_id"), F.col("vid").alias("query")).join(lists, "query").select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "x")).select(
            "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
            F.col("x.score").alias("score"))


def op13_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for every id divisible by 20."""
    with Scratch(spark, "op13") as scratch:
        out = scratch.table(nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, scratch), "out")
        scratch.keep("out")
        return out
