"""Exact top-k inner products with a pivot table.

The inner product follows from the distance, q.x = (|q|^2 + |x|^2 - d^2) / 2,
and distances to pivots bound d from below: d >= max over pivots of
|d(q, p) - d(x, p)|.  Each candidate's distances to all pivots are computed
once (the pivot table).  A query takes candidates in the order of the upper
bound on its score that the largest lower bound gives, and stops when the next
bound is below its k-th best score; ties at the bound are still evaluated, so
the answer is exact.

Scale: candidates and queries are dealt by their nearest pivot, and a pivot's
rows by a hash of the id and a stored row number into blocks of bounded size, so
a hot pivot or an id on many rows spreads.  A block keeps its smallest and
largest distance to every pivot and its largest norm, which bound every score
in it.  Each query first searches one block of its own pivot, whose k-th best
score it has to beat; query blocks then meet the blocks' summaries only, and a
query goes to those candidate blocks whose bound still reaches that score.  A
pair of blocks gives at most k rows a query, and the best k of those are merged
per query.  Only the pivots (a fixed number) are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import table
from fieldlens.session import Scratch

PIVOTS = 32
QUERY_BLOCK = 256
BLOCK = 2048
SUMMARIES = 512  # block summaries that a query block meets at once
_PIVOT = 1 << 32
STEP = 64  # candidates evaluated between two looks at the bounds


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component as a bigint; vectors that
    are null or hold null or non-finite components are left out."""
    x = F.col(vec_col)
    good = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("bigint"))
    return df.filter(good).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b."""
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def best_of_block(queries, q_ids, q_piv, cands, c_ids, c_piv, k: int, floors=None,
                  evaluated=None) -> list[tuple[int, int, int, int]]:
    """(query number, query id, candidate id, score): the k best candidates of
    one block for each query, ties to the smaller id, by elimination on the
    pivot table.  Candidates that cannot reach a query's score in ``floors``
    may be left out; ``evaluated`` (an accumulator) counts the others."""
    big = float(np.abs(queries).max(initial=0)) * float(np.abs(cands).max(initial=0)) * max(1, queries.shape[1])
    exact = big < 2**52  # float products are then whole numbers without rounding
    qf, cf = queries.astype(float), cands.astype(float)
    q2, c2 = (qf * qf).sum(1), (cf * cf).sum(1)
    out = []
    for i in range(len(q_ids)):
        low = np.abs(c_piv - q_piv[i]).max(axis=1) if c_piv.size else np.zeros(len(c_ids))
        low = np.maximum(low * (1 - 1e-9) - 1e-6 * (1 + low), 0.0)  # below any rounding of the distances
        bound = (q2[i] + c2 - low * low) / 2
        bound += 1e-9 * (q2[i] + c2) + 1e-6
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[int, int]] = []
        for lo in range(0, len(order), STEP):
            part = order[lo:lo + STEP]
            if len(best) == k and bound[part[0]] < -best[-1][0] or floors is not None and bound[part[0]] < floors[i]:
                break
            part = part[c_ids[part] != q_ids[i]]
            if evaluated is not None:
                evaluated.add(len(part))
            if exact:
                score = (cf[part] @ qf[i]).astype(np.int64)
            else:
                score = np.array([sum(int(x) * int(y) for x, y in zip(cands[j], queries[i])) for j in part], dtype=object)
            best = sorted(best + [(-int(s), int(c)) for s, c in zip(score, c_ids[part])])[:k]
        out += [(i, int(q_ids[i]), c, -s) for s, c in best]
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a row number; write the table before it is read twice."""
    return rows.withColumn("row", F.monotonically_increasing_id())


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """For each vector length, ``n`` stored vectors as pivots: those whose id
    hashes lowest (bounded, the same for any layout)."""
    w = Window.partitionBy("dim").orderBy(F.xxhash64(F.lit(3), "id"), "id")
    rows = vectors.withColumn("dim", F.size("v")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n)
    out: dict[int, list] = {}
    for r in rows.select("dim", "v").collect():
        out.setdefault(r[0], []).append(r[1])
    return {d: np.array(v, dtype=float).reshape(len(v), d) for d, v in out.items()}


def nearest_pivot(rows: DataFrame, pivots) -> DataFrame:
    """``rows`` (id, v, row) with the number of the pivot nearest to each."""
    def run(batches):
        known = pivots.value
        for batch in batches:
            v = batch.column(1)
            size = v.value_lengths().to_numpy(zero_copy_only=False)
            near = np.zeros(len(size), np.int32)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                x = np.asarray(v.take(pa.array(at)).flatten(), dtype=float).reshape(len(at), dim)
                near[at] = distances(x, known[int(dim)]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=["id", "v", "row", "pivot"])

    return rows.select("id", "v", "row").mapInArrow(run, "id bigint, v array<bigint>, row bigint, pivot int")


def _blocks(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """(dim, block, rows): rows (id, v, row, pivot; one pivot if none is named)
    of one pivot gathered in blocks of about ``size`` by a hash of the id and the
    stored row number, however many rows repeat an id.  A block's number is the
    pivot's, shifted, and its own."""
    if "pivot" not in rows.columns:
        rows = rows.withColumn("pivot", F.lit(0))
    rows = rows.withColumn("dim", F.size("v"))
    n = rows.groupBy("dim", "pivot").count()
    part = F.pmod(F.xxhash64(F.lit(seed), "id", "row"), F.ceil(F.col("count") / size))
    spread = rows.join(n, ["dim", "pivot"]).withColumn("block", F.col("pivot") * F.lit(_PIVOT) + part)
    return spread.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("rows"))


def _with_pivots(blocks: DataFrame, pivots) -> DataFrame:
    """The pivot table: each block with its distances to all pivots, as bytes,
    and its summary: smallest and largest distance to each pivot, largest
    squared norm."""
    def run(batches):
        known = pivots.value
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for dim, rows in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                v = np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), dim)
                x = v.astype(float)
                d = distances(x, known[dim])
                for store, b in zip(cols, (np.array([r["id"] for r in rows], np.int64), v, d,
                                           np.stack([d.min(axis=0), d.max(axis=0)]))):
                    store.append(b.tobytes())
                cols[4].append(float((x * x).sum(axis=1).max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.binary()) for c in cols[:4]),
                 pa.array(cols[4], pa.float64())], names=["dim", "block", "ids", "vs", "piv", "rim", "top"])

    return blocks.mapInArrow(run, "dim int, block bigint, ids binary, vs binary, piv binary, rim binary, top double")


def _arrays(ids: bytes, vs: bytes, piv: bytes, dim: int, m: int):
    n = len(ids) // 8
    return (np.frombuffer(vs, np.int64).reshape(n, dim), np.frombuffer(ids, np.int64),
            np.frombuffer(piv).reshape(n, m))


def _seeded(asks: DataFrame, cands: DataFrame, pivots, k: int) -> DataFrame:
    """``asks`` with the score that each query has to reach: its k-th best in
    one block of its own pivot (none, if that holds fewer than k others)."""
    own = F.col("block") - F.pmod(F.col("block"), F.lit(_PIVOT))
    seed = cands.select("dim", F.col("block").alias("own"), F.col("ids").alias("c_ids"), F.col("vs").alias("c_vs"),
                        F.col("piv").alias("c_piv"))
    met = asks.withColumn("own", own).join(seed, ["dim", "own"], "left").select(
        "dim", "block", "ids", "vs", "piv", "c_ids", "c_vs", "c_piv")

    def run(batches):
        known = pivots.value
        for batch in batches:
            floors = []
            for dim, ids, vs, piv, c_ids, c_vs, c_piv in zip(*(batch.column(c).to_pylist() for c in (
                    "dim", "ids", "vs", "piv", "c_ids", "c_vs", "c_piv"))):
                m = len(known[dim])
                q, q_ids, q_piv = _arrays(ids, vs, piv, dim, m)
                found: list[list[int]] = [[] for _ in q_ids]
                if c_ids is not None:
                    for i, _, _, score in best_of_block(q, q_ids, q_piv, *_arrays(c_ids, c_vs, c_piv, dim, m), k):
                        found[i].append(score)
                floors.append(np.array([np.nextafter(float(min(f)), -np.inf) if len(f) == k else -np.inf
                                        for f in found]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("dim", "block", "ids", "vs", "piv")), pa.array(floors, pa.binary())],
                names=["dim", "block", "ids", "vs", "piv", "floors"])

    return met.mapInArrow(run, "dim int, block bigint, ids binary, vs binary, piv binary, floors binary")


def _bounded_pairs(asks: DataFrame, cands: DataFrame, pivots) -> DataFrame:
    """(dim, block, q_ids, q_vs, q_piv, floors): the queries of a query block
    whose floor the bound of a candidate block reaches."""
    n = cands.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SUMMARIES).alias("chunks"))
    chunk = F.pmod(F.xxhash64(F.lit(5), "block"), F.col("chunks"))
    chunks = cands.join(n, "dim").withColumn("chunk", chunk).groupBy("dim", "chunk").agg(
        F.collect_list(F.struct("block", "rim", "top")).alias("blocks"))
    to = asks.join(n, "dim").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    met = to.join(chunks, ["dim", "chunk"]).select("dim", "ids", "vs", "piv", "floors", "blocks")

    def run(batches):
        known = pivots.value
        for batch in batches:
            for dim, ids, vs, piv, floors, blocks in zip(*(batch.column(c).to_pylist() for c in (
                    "dim", "ids", "vs", "piv", "floors", "blocks"))):
                m = len(known[dim])
                q, q_ids, q_piv = _arrays(ids, vs, piv, dim, m)
                floor = np.frombuffer(floors)
                q2 = (q.astype(float) ** 2).sum(axis=1)
                for b in blocks:
                    near, far = np.frombuffer(b["rim"]).reshape(2, m)
                    low = np.maximum(q_piv - far, near - q_piv).max(axis=1, initial=0)
                    low = np.maximum(low * (1 - 1e-9) - 1e-6 * (1 + low), 0.0)
                    bound = (q2 + b["top"] - low * low) / 2 + 1e-9 * (q2 + b["top"]) + 1e-6
                    go = np.flatnonzero(bound >= floor)
                    if len(go):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([dim], pa.int32()), pa.array([b["block"]], pa.int64()),
                             *(pa.array([x[go].tobytes()], pa.binary()) for x in (q_ids, q, q_piv, floor))],
                            names=["dim", "block", "q_ids", "q_vs", "q_piv", "floors"])

    return met.mapInArrow(run, "dim int, block bigint, q_ids binary, q_vs binary, q_piv binary, floors binary")


def top_k(df: DataFrame, is_query: Column, scratch: Scratch, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = 5, pivots: int = PIVOTS, evaluated=None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` picks, the
    ``k`` rows with the highest integer inner products, ties to the smaller
    id; all of them if fewer.  ``evaluated`` is an accumulator that counts the
    products taken (without those of the first blocks).

    Null vectors and vectors with null or non-finite components take no part;
    vectors are compared with vectors of their own length (an empty one scores
    0).  Rows that repeat an id are candidates each, and never for a query of
    their own id.  Null ids take no part.  An empty table gives no row.  Other
    columns are not read, whatever their names.
    """
    vectors = scratch.table(_numbered(integer_vectors(df, id_col, vec_col).filter("id IS NOT NULL")), "vectors")
    asked = scratch.table(_numbered(integer_vectors(df.filter(is_query), id_col, vec_col).filter("id IS NOT NULL")
                                    .dropDuplicates(["id", "v"])), "asked")
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(choose_pivots(vectors, pivots))
    dealt = scratch.table(nearest_pivot(vectors, sent), "dealt")
    cands = scratch.table(_with_pivots(_blocks(dealt, BLOCK, 1), sent), "pivot_table")
    near_asked = scratch.table(nearest_pivot(asked, sent), "dealt_queries")
    asks = _with_pivots(_blocks(near_asked, QUERY_BLOCK, 2), sent).drop("rim", "top")
    asks = scratch.table(_seeded(asks, cands, sent, k), "queries")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few blocks: never fewer tasks than that
    pairs = _bounded_pairs(asks, cands, sent).repartition(tasks, "dim", "block").join(
        cands.select("dim", "block", "ids", "vs", "piv").repartition(tasks, "dim", "block"), ["dim", "block"])

    def run(batches):
        known = sent.value
        for batch in batches:
            for dim, q_ids, q_vs, q_piv, floors, ids, vs, piv in zip(*(batch.column(c).to_pylist() for c in (
                    "dim", "q_ids", "q_vs", "q_piv", "floors", "ids", "vs", "piv"))):
                m = len(known[dim])
                rows = best_of_block(*_arrays(q_ids, q_vs, q_piv, dim, m), *_arrays(ids, vs, piv, dim, m), k,
                                     np.frombuffer(floors), evaluated)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], pa.int64()) for j in (1, 2, 3)],
                    names=["query_id", "vec_id", "score"])

    near = pairs.select("dim", "q_ids", "q_vs", "q_piv", "floors", "ids", "vs", "piv").mapInArrow(
        run, "query_id bigint, vec_id bigint, score bigint")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for every id divisible by 50."""
    with Scratch(spark, "op8") as scratch:
        out = scratch.table(top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, scratch), "out")
        scratch.keep("out")
        return out
