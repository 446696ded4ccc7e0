"""K4: random forest of regression trees, grown from binned rows in Arrow workers.

The same forest as ``pyspark.ml.regression.RandomForestRegressor`` with
``featureSubsetStrategy="all"`` grows: Poisson(1) bootstrap weights per row and
tree, numeric features in at most ``max_bins`` bins, one-hot features of two
categories, every feature tried at every node, variance as impurity; the fitted
model is Spark's own ``RandomForestRegressionModel``.  What differs is where the
work is done.  The library sends a histogram of all nodes of a level from every
partition and updates one histogram cell per feature and row, one-hot columns
included.  Here

1. every block of rows sends a summary of each numeric column, from which the
   split candidates follow (equal shares of all rows, midpoints between values);
2. every block becomes one byte string: the label, and one bin number per row
   for each numeric column and each category column, small ones combined;
3. the blocks go to as many groups of trees as there are task slots, and a task
   grows its trees one after the other from a file of its own, so that only the
   finished trees (a few thousand nodes each) travel any further.

A category column costs one histogram update per row, from which the split of
each of its one-hot features follows.  Of two sibling nodes only the lighter
one is counted, the other is the parent less its sibling.

A task keeps the binned rows in an unnamed temporary file and 5 bytes a row
of its current tree (beyond ``HELD`` bytes in such a file too).  The bootstrap is drawn
per block, tree and seed, so the model does not depend on how many tasks grow it.
"""

from __future__ import annotations

import json
import mmap
import tempfile
import time
from collections.abc import Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import remove_path, shared_path

POSITION = "_pos"  # number of a training row, increasing along each written file
BLOCK = 1 << 16  # rows of one block
POINTS = 512  # weighted values that stand for one numeric column of a block
HELD = 64 << 20  # bytes of a per-row array that stay in memory
NODES = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
         "rawCount bigint, gain double, leftChild int, rightChild int, "
         "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


# --------------------------------------------------------------------------
# Blocks of rows and split candidates
# --------------------------------------------------------------------------
def _blocks(batches):
    """(first position, numeric values, category numbers, labels) of at most
    ``BLOCK`` rows each, from batches of (position, x, c, y).  A block's rows
    follow each other in one written file, so it does not depend on which files
    a task reads."""
    held, size = [], 0

    def joined():
        return tuple(np.concatenate(p) for p in zip(*held))

    for b in batches:
        if not b.num_rows:
            continue
        pos = b.column(0).to_numpy(zero_copy_only=False)
        x, c = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for i in (1, 2))
        y = b.column(3).to_numpy(zero_copy_only=False)
        if np.isnan(y).any() or np.isnan(x).any():
            raise ValueError("labels and features must not be null or NaN")
        # a partition of the written table has positions of its own in the high bits
        cuts = [0, *(np.flatnonzero(np.diff(pos >> 33)) + 1).tolist(), len(pos)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[-1][0][-1] >> 33 != pos[lo] >> 33:
                yield joined()
                held, size = [], 0
            while lo < hi:
                n = min(hi - lo, BLOCK - size)
                held.append((pos[lo:lo + n], x[lo:lo + n], c[lo:lo + n], y[lo:lo + n]))
                lo, size = lo + n, size + n
                if size == BLOCK:
                    yield joined()
                    held, size = [], 0
    if held:
        yield joined()


def _summary(values: np.ndarray):
    """At most ``POINTS`` (value, rows) that stand for the values: all distinct
    ones, or the largest of each of ``POINTS`` equal shares."""
    v, n = np.unique(values, return_counts=True)
    if len(v) > POINTS:
        ends = np.cumsum(n)
        at = np.unique(np.searchsorted(ends, np.arange(1, POINTS + 1) * (ends[-1] / POINTS)).clip(max=len(v) - 1))
        at[-1] = len(v) - 1
        v, n = v[at], np.diff(ends[at], prepend=0)
    return v, n


def _summaries(batches):
    for pos, x, _, y in _blocks(batches):
        points = [_summary(x[:, j]) for j in range(x.shape[1])]
        yield pa.RecordBatch.from_arrays([
            pa.array([int(pos[0])], pa.int64()), pa.array([len(y)], pa.int64()), pa.array([float(y.sum())], pa.float64()),
            pa.array([b"".join(v.astype("<f8").tobytes() + n.astype("<f8").tobytes() for v, n in points)], pa.binary()),
            pa.array([[len(v) for v, _ in points]], pa.list_(pa.int32()))], names=["pos", "n", "total", "points", "sizes"])


def split_candidates(values: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds that cut the rows in equal shares, each midway
    between two values; all midpoints if there are no more than that.  Where the
    values are not all there is (more than ``POINTS``), one may lie at that middle
    and fall on either side by the last digit of the scaled numbers, so the
    threshold is the lower value itself."""
    v, inverse = np.unique(values, return_inverse=True)
    n = np.bincount(inverse, rows, minlength=len(v))
    if len(v) - 1 <= most:
        return (v[1:] + v[:-1]) / 2
    stride = n.sum() / (most + 1)
    at = (v[1:] + v[:-1]) / 2 if len(v) <= POINTS else v[:-1]
    out, seen, target = [], n[0], stride
    for i in range(1, len(v)):
        before, seen = seen, seen + n[i]
        if abs(before - target) < abs(seen - target):
            out.append(at[i - 1])
            target += stride
    return np.array(out[:most])


class Columns:
    """How a row's bins are stored: bin numbers of small features are combined
    into one byte.  ``sizes`` has the bins of each numeric column, then of each
    category column (its categories and one for a value unseen)."""

    def __init__(self, sizes: Sequence[int], numeric: int):
        self.sizes, self.numeric = list(sizes), numeric
        self.of: list[list[int]] = []  # features of each stored column
        for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
            fit = [m for m in self.of if np.prod([sizes[g] for g in m]) * sizes[f] <= 256]
            if fit:
                fit[0].append(f)
            else:
                self.of.append([f])
        self.width = [int(np.prod([sizes[g] for g in m])) for m in self.of]
        self.kind = [np.dtype(np.uint8 if w <= 256 else np.uint16 if w <= 65536 else np.uint32) for w in self.width]
        self.bins = {f: self._bins(j, f) for j, m in enumerate(self.of) for f in m}

    def store(self, bins: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for m, kind in zip(self.of, self.kind):
            key = np.zeros(len(bins[0]), np.int64)
            for f in m:
                key = key * self.sizes[f] + bins[f]
            out.append(key.astype(kind))
        return out

    def _bins(self, j: int, f: int) -> np.ndarray:
        """The bin of feature ``f`` for every key of stored column ``j``."""
        m = self.of[j]
        at = m.index(f)
        inner = int(np.prod([self.sizes[g] for g in m[at + 1:]]))
        return np.arange(self.width[j]) // inner % self.sizes[f]


def _padded(b: bytes) -> bytes:
    return b + bytes(-len(b) % 8)


# --------------------------------------------------------------------------
# One tree
# --------------------------------------------------------------------------
def _array(n: int, kind):
    """An array of ``n`` zeros, in an unnamed file where it is large."""
    size = max(1, n) * np.dtype(kind).itemsize
    if size <= HELD:
        return np.zeros(n, kind)
    with tempfile.TemporaryFile() as f:
        f.truncate(size)
        return np.frombuffer(mmap.mmap(f.fileno(), size), kind, n)


POISSON = np.cumsum([np.exp(-1.0) / factorial(k) for k in range(11)])


def _draws(rng, n: int) -> np.ndarray:
    """How often each row is drawn: Poisson(1), by its distribution function."""
    u, w = rng.random(n), np.zeros(n, np.uint8)
    for p in POISSON:
        w += u >= p
    return w


class Rows:
    """The blocks of one task in the order of their positions: (labels, stored
    columns, bytes of all columns, byte at which each begins) as views of the spool."""

    def __init__(self, columns: Columns, buffer, index, mean: float):
        self.columns, self.mean, self.buffer = columns, mean, buffer
        self.index = sorted(index)
        self.n = sum(n for _, n, _ in self.index)

    def blocks(self):
        for _, n, at in self.index:
            y = np.frombuffer(self.buffer, "<f8", n, at) - self.mean
            sizes = [n * kind.itemsize + -(n * kind.itemsize) % 8 for kind in self.columns.kind]
            flat = np.frombuffer(self.buffer, np.uint8, sum(sizes), at + 8 * n)
            begins = np.cumsum([0, *sizes[:-1]])
            yield y, [flat[o:o + n * k.itemsize].view(k) for o, k in zip(begins, self.columns.kind)], flat, begins


def _best_splits(columns: Columns, hist: list[np.ndarray], count: np.ndarray, total: np.ndarray):
    """For every node the best split: score (the sum over both children of
    sum^2 / count), feature, bin or category, left count and sum, stored column."""
    n = len(count)
    best = [np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)]
    for j, (m, h) in enumerate(zip(columns.of, hist)):
        shaped = h.reshape(2, n, *[columns.sizes[f] for f in m])
        for a, f in enumerate(m):
            part = shaped.sum(axis=tuple(2 + i for i in range(len(m)) if i != a))
            if f < columns.numeric:
                cl, sl = np.cumsum(part, axis=2)[:, :, :-1]
            else:  # one against the other categories; the last bin has the values unseen
                cl, sl = part[:, :, :-1]
            if not cl.shape[1]:
                continue
            cr, sr = count[:, None] - cl, total[:, None] - sl
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where((cl > 0) & (cr > 0), sl * sl / cl + sr * sr / cr, -np.inf)
            at = score.argmax(axis=1)
            rows = np.arange(n)
            top = score[rows, at]
            # equal scores go to the feature that comes first
            better = (top > best[0]) | ((top == best[0]) & (f < best[1]) & (top > -np.inf))
            for keep, new in zip(best, (top, f, at, cl[rows, at], sl[rows, at], j)):
                keep[better] = np.broadcast_to(new, n)[better]
    return best


def grow(rows: Rows, tree: int, depth: int, seed: int, bootstrap: bool) -> dict[str, np.ndarray]:
    """One tree as arrays over its nodes, parents before children: feature (-1
    in a leaf), bin or category, left child (the right one follows it), whether a
    category goes left, and count, sum and sum of squares of the centred labels."""
    cols, nodes_at_most = rows.columns, 1 << (depth + 1)
    # the drawn rows of every block: place, weight and current node
    drawn, start = np.zeros(len(rows.index) + 1, np.int64), 0
    place, weight = _array(rows.n, np.uint16 if BLOCK <= 65536 else np.uint32), _array(rows.n, np.uint8)
    node = _array(rows.n, np.uint16 if nodes_at_most <= 65536 else np.uint32)
    for b, (pos, n, _) in enumerate(rows.index):
        w = _draws(np.random.default_rng([seed & 0xFFFFFFFF, tree, pos]), n) if bootstrap else np.ones(n, np.uint8)
        at = np.flatnonzero(w)
        place[start:start + len(at)], weight[start:start + len(at)] = at, w[at]
        start += len(at)
        drawn[b + 1] = start

    feature, cut, left = [-1], [0], [0]
    flip: list[bool] = [False]
    size, most = 1, max(cols.width)
    wide = [j for j, kind in enumerate(cols.kind) if kind.itemsize > 1]
    jump = np.zeros(1, np.int64)  # left child, or the node itself
    column = np.zeros(1, np.int64)
    right = np.zeros((1, most), np.int8)  # which keys of its column go right
    slot = np.zeros(1, np.int64)  # of the nodes to count
    level, parents = np.array([0]), None
    for step in range(depth + 1):
        counting = step < depth and bool((slot >= 0).any())
        n_slots = int(slot.max()) + 1 if counting else 0
        hist = [np.zeros((2, n_slots * w)) for w in cols.width]
        stats = np.zeros((3, size))
        for b, (y, stored, flat, begins) in enumerate(rows.blocks()):
            span = slice(drawn[b], drawn[b + 1])
            nd, at = node[span], place[span]
            if step:  # to the children
                key = flat[begins[column][nd] + at].astype(np.int64)
                for j in wide:
                    here = np.flatnonzero((column == j)[nd])
                    key[here] = stored[j][at[here]]
                key += (np.arange(len(jump)) * most)[nd]
                nd = (jump[nd] + right.ravel()[key]).astype(node.dtype)
                node[span] = nd
            if step == depth or not counting:
                w = weight[span].astype(np.float64)
                wy = w * y[at]
                stats += [np.bincount(nd, v, minlength=size) for v in (w, wy, wy * y[at])]
                continue
            of = slot[nd]
            picked = np.flatnonzero(of >= 0)
            of, at, w = of[picked], at[picked], weight[span][picked].astype(np.float64)
            wy = w * y[at]
            for h, width, c in zip(hist, cols.width, stored):
                key = of * width + c[at]
                h[0] += np.bincount(key, w, minlength=h.shape[1])
                h[1] += np.bincount(key, wy, minlength=h.shape[1])
        if not counting:
            break
        full = []  # of all nodes of the level: counted, or the parent's less the sibling's
        for i, (h, width) in enumerate(zip(hist, cols.width)):
            h = h.reshape(2, n_slots, width)
            if parents is not None:
                own = slot[level]
                both = np.empty((2, len(level), width))
                both[:, own >= 0] = h[:, own[own >= 0]]
                other = np.flatnonzero(own < 0)
                both[:, other] = parents[i][:, other // 2] - h[:, own[other ^ 1]]
                h = both
            full.append(h)
        count, total = full[0].sum(axis=2)
        score, f_best, at_best, lc, ls, j_best = _best_splits(cols, full, count, total)
        # a gain below the rounding of the scores is none
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = score - total * total / count
        split = np.flatnonzero((score > -np.inf) & (gains > 1e-10 * np.abs(score)))
        new = len(split)
        jump, column = np.arange(size + 2 * new), np.zeros(size + 2 * new, np.int64)
        right = np.zeros((size + 2 * new, most), np.int8)
        slot = np.full(size + 2 * new, -1)
        feature += [-1] * (2 * new)
        cut += [0] * (2 * new)
        left += [0] * (2 * new)
        flip += [False] * (2 * new)
        for k, s in enumerate(split.tolist()):
            i, child, f, j, at = int(level[s]), size + 2 * k, int(f_best[s]), int(j_best[s]), int(at_best[s])
            bins = cols.bins[f]
            feature[i], cut[i], left[i] = f, at, child
            light = child
            if f < cols.numeric:
                goes = bins > at
                if 2 * lc[s] > count[s]:
                    light += 1
            else:
                # as in Spark, the side with the lower mean goes left
                flip[i] = bool(ls[s] * (count[s] - lc[s]) < (total[s] - ls[s]) * lc[s])
                goes = (bins != at) if flip[i] else (bins == at)
                if (2 * lc[s] > count[s]) == flip[i]:
                    light += 1
            right[i, :len(bins)] = goes
            jump[i], column[i], slot[light] = child, j, k
        parents = [h[:, split] for h in full]
        level = np.arange(size, size + 2 * new)
        size += 2 * new
    stats = np.ascontiguousarray(stats)
    at = np.array(left)
    for i in range(size - 1, -1, -1):
        if feature[i] >= 0:
            stats[:, i] = stats[:, at[i]] + stats[:, at[i] + 1]
    return {"feature": np.array(feature), "cut": np.array(cut), "left": at, "flip": np.array(flip), "stats": stats}


def _node_rows(tree: int, t: dict[str, np.ndarray], columns: Columns, thresholds: list[np.ndarray],
               first: list[int], mean: float) -> pa.RecordBatch:
    """The tree as rows of Spark's saved form."""
    count, total, squares = t["stats"]
    own = total / count
    impurity = np.maximum(squares / count - own * own, 0.0)
    data = []
    for i in range(len(count)):
        f, l = int(t["feature"][i]), int(t["left"][i])
        n, m = float(count[i]), float(mean + own[i])
        node = {"id": i, "prediction": m, "impurity": float(impurity[i]), "rawCount": int(n), "gain": -1.0,
                "leftChild": -1, "rightChild": -1, "impurityStats": [n, n * m, n * (float(impurity[i]) + m * m)],
                "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        if f >= 0:
            node |= {"leftChild": l, "rightChild": l + 1, "gain": float(max(
                impurity[i] - (count[l] * impurity[l] + count[l + 1] * impurity[l + 1]) / n, 0.0))}
            at = int(t["cut"][i])
            node["split"] = {"featureIndex": f, "leftCategoriesOrThreshold": [float(thresholds[f][at])], "numCategories": -1} \
                if f < columns.numeric else {"featureIndex": first[f - columns.numeric] + at, "numCategories": 2,
                                             "leftCategoriesOrThreshold": [1.0 if t["flip"][i] else 0.0]}
        data.append(node)
    kind = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
                      ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
                      ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                      ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                           ("numCategories", pa.int32())]))])
    return pa.RecordBatch.from_arrays([pa.array([tree] * len(data), pa.int32()), pa.array(data, kind)],
                                      names=["treeID", "nodeData"])


# --------------------------------------------------------------------------
# The estimator
# --------------------------------------------------------------------------
def _keys(spark, n: int) -> list[int]:
    """``n`` numbers that hash partitioning deals to ``n`` different partitions."""
    of = {}
    for key, part in spark.range(30 * n + 300).select("id", F.pmod(F.hash("id"), F.lit(n))).collect():
        of.setdefault(part, key)
    return [of[p] for p in sorted(of)]


class HistogramForest(Estimator):
    """Fits Spark's ``RandomForestRegressionModel`` (see the module).

    The features of a row are the vector ``numeric_col``, then the one-hot
    vectors ``onehot_cols``; the same categories are read as numbers from
    ``index_cols``.  A column ``_pos`` numbers the rows along each written file
    (without it they are numbered as they come)."""

    def __init__(self, *, numeric_col: str, index_cols: Sequence[str], onehot_cols: Sequence[str], features_col: str,
                 label_col: str, prediction_col: str, num_trees: int, max_depth: int, seed: int, max_bins: int,
                 bootstrap: bool = True):
        super().__init__()
        self.numeric_col, self.index_cols, self.onehot_cols = numeric_col, list(index_cols), list(onehot_cols)
        self.shown = {"featuresCol": features_col, "labelCol": label_col, "predictionCol": prediction_col,
                      "numTrees": num_trees, "maxDepth": max_depth, "maxBins": max_bins, "seed": seed,
                      "featureSubsetStrategy": "all", "impurity": "variance", "bootstrap": bootstrap}

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        spark, p = dataset.sparkSession, self.shown
        trees, depth, seed, bootstrap = p["numTrees"], p["maxDepth"], p["seed"], p["bootstrap"]
        labels = [dataset.schema[c].metadata["ml_attr"]["num_attrs"] for c in self.onehot_cols]
        position = F.col(POSITION) if POSITION in dataset.columns else F.monotonically_increasing_id()
        rows = dataset.select(
            position.cast("bigint").alias("pos"), vector_to_array(F.col(self.numeric_col)).alias("x"),
            F.array(*[F.col(c).cast("int") for c in self.index_cols]).cast("array<int>").alias("c"),
            F.col(p["labelCol"]).cast("double").alias("y"))

        found = sorted(rows.mapInArrow(
            _summaries, "pos bigint, n bigint, total double, points binary, sizes array<int>").collect())
        if not found:
            raise ValueError("no training rows")
        n = sum(r["n"] for r in found)
        mean = sum(r["total"] for r in found) / n
        numeric = len(found[0]["sizes"])
        most = min(p["maxBins"], n) - 1
        thresholds = []
        for j in range(numeric):
            parts = []
            for r in found:
                lo, k = 2 * sum(r["sizes"][:j]), r["sizes"][j]
                parts.append(np.frombuffer(r["points"], "<f8", 2 * k, 8 * lo).reshape(2, k))
            thresholds.append(split_candidates(*np.concatenate(parts, axis=1), most))
        columns = Columns([*[len(t) + 1 for t in thresholds], *[k + 1 for k in labels]], numeric)
        first = [numeric + sum(labels[:i]) for i in range(len(labels))]  # of a category column's one-hot features

        def pack(batches):
            for pos, x, c, y in _blocks(batches):
                bins = [np.searchsorted(t, x[:, j], "left") for j, t in enumerate(thresholds)]
                bins += [c[:, i] for i in range(len(labels))]
                blob = y.astype("<f8").tobytes() + b"".join(_padded(s.tobytes()) for s in columns.store(bins))
                yield pa.RecordBatch.from_arrays([pa.array([int(pos[0])], pa.int64()), pa.array([len(y)], pa.int64()),
                                                  pa.array([blob], pa.binary())], names=["pos", "n", "blob"])

        groups = min(trees, max(1, spark.sparkContext.defaultParallelism))
        keys = _keys(spark, groups)

        def train(batches):
            with tempfile.TemporaryFile() as spool:
                index, end = {}, 0
                for b in batches:
                    for i in range(b.num_rows):
                        blob = b.column(2)[i].as_buffer()
                        spool.write(blob)
                        index.setdefault(b.column(3)[i].as_py(), []).append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), end))
                        end += len(blob)
                if not end:
                    return
                spool.flush()
                buffer = mmap.mmap(spool.fileno(), end, access=mmap.ACCESS_READ)
            for key in sorted(index):
                mine = Rows(columns, buffer, index[key], mean)
                for tree in range(keys.index(key), trees, groups):
                    grown = grow(mine, tree, depth, seed, bootstrap)
                    yield _node_rows(tree, grown, columns, thresholds, first, mean)

        blocks = rows.mapInArrow(pack, "pos bigint, n bigint, blob binary")
        dealt = blocks.select("*", F.explode(F.array(*[F.lit(k).cast("bigint") for k in keys])).alias("g")).repartition(groups, "g")
        root = shared_path(spark, "forest")
        try:
            dealt.mapInArrow(train, NODES).write.parquet(f"{root}/data")
            self._describe(spark, root, numeric + sum(labels))
            return RandomForestRegressionModel.load(root)
        finally:
            remove_path(spark, root)

    def _describe(self, spark, root: str, num_features: int) -> None:
        """What Spark's saved form holds beside the nodes."""
        p, trees = self.shown, self.shown["numTrees"]
        about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {}}
        saved = {"class": "org.apache.spark.ml.regression.RandomForestRegressionModel", "uid": self.uid, **about,
                 "paramMap": p, "numFeatures": num_features, "numTrees": trees}
        of_one = {k: v for k, v in p.items() if k not in ("numTrees", "featureSubsetStrategy", "bootstrap")}
        of_tree = [(i, json.dumps({"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
                                   "uid": f"{self.uid}_{i}", **about, "paramMap": of_one}), 1.0) for i in range(trees)]
        spark.createDataFrame([(json.dumps(saved),)], "value string").coalesce(1).write.text(f"{root}/metadata")
        spark.createDataFrame(of_tree, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{root}/treesMetadata")
