"""SimHash near duplicates with BK-trees.

Fingerprints: 64 bits from the XXH64 hashes of all word shingles.

Search: two fingerprints within 3 bits agree on at least 2 of 5 bit blocks, so
all their links lie inside the buckets of equal block pairs (10 buckets a
fingerprint, about 26 bits each).  A bucket's distinct fingerprints are cut
into shards of a bounded size, each shard is a BK-tree (children keyed by
their Hamming distance to the parent), and every fingerprint of the bucket is
looked up in every shard tree of its bucket, following only the edges within
the radius.  No fingerprint is compared outside its buckets.

Scale: equal fingerprints are one entry whatever the number of copies; trees
hold at most about ``SHARD`` entries and travel to the queries of their own
bucket only; a lookup gives links that join two parts (a spanning forest of
the pair of shards), so links grow with the entries, not with their pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import LOWER, STAGE_ROWS, fresh_name, named, releasing, table
from fieldlens.llm.components import connected_components
from fieldlens.session import Scratch

SHARD = 512
BLOCKS = 5


def simhash(text: bytes | None, shingle: int = 3) -> bytes:
    """64-bit fingerprint (big-endian bytes) of the lower-cased words."""
    from xxhash import xxh64_digest

    words = (text or b"").translate(LOWER).split()
    if not words:
        return bytes(8)
    norm = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_digest(norm, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    ends = (start + size)[shingle - 1:].tolist()
    raw = b"".join([xxh64_digest(norm[a:b], 42) for a, b in zip(start.tolist(), ends)])
    n = len(ends)
    ones = np.zeros(64, dtype=np.int64)
    hashes = np.frombuffer(raw, np.uint8).reshape(n, 8)
    for lo in range(0, n, 4096):
        ones += np.unpackbits(hashes[lo:lo + 4096], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``docs`` with the text replaced by its fingerprint as a bigint (the
    bits of the unsigned value)."""
    rest = [c for c in docs.columns if c != text_col]
    fields = [docs.schema[c] for c in rest]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches):
        for batch in releasing(batches):
            texts = batch.column(len(rest)).to_pylist()
            fps = np.frombuffer(b"".join([simhash(t, shingle) for t in texts]), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*list(batch.columns)[:-1], pa.array(fps)], names=[*rest, out])

    return docs.select(*rest, F.col(text_col).cast("binary").alias("__text")).mapInArrow(
        run, schema + ("," if rest else "") + f" `{out}` bigint")


class BKTree:
    """Distinct integers; a child hangs under the edge of its distance."""

    def __init__(self, values):
        self.nodes: list[int] = []
        self.children: list[dict[int, int]] = []
        for v in values:
            self.add(v)

    def add(self, v: int) -> None:
        nodes, children = self.nodes, self.children
        at = 0
        while nodes:
            d = (nodes[at] ^ v).bit_count()
            nxt = children[at].get(d)
            if nxt is None:
                if d == 0:
                    return
                children[at][d] = len(nodes)
                break
            at = nxt
        nodes.append(v)
        children.append({})

    def within(self, v: int, radius: int) -> list[int]:
        """Numbers of the nodes within ``radius`` of ``v``."""
        nodes, children, out = self.nodes, self.children, []
        stack = [0] if nodes else []
        while stack:
            at = stack.pop()
            d = (nodes[at] ^ v).bit_count()
            if d <= radius:
                out.append(at)
            for e, child in children[at].items():
                if d - radius <= e <= d + radius:
                    stack.append(child)
        return out


def forest_links(tree_values: list[int], queries: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links (node, node) within the radius that connect what was apart.

    ``queries`` None: inside the tree's own values.  Else between the two
    sets; each set's own links are known from its own call, so its parts are
    joined first and not given again.
    """
    values = [v & (2**64 - 1) for v in tree_values]
    tree = BKTree(values)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(asked: list[int], found: BKTree) -> list[tuple[int, int]]:
        links = []
        for q in asked:
            for k in found.within(q, radius):
                a, b = find(q), find(found.nodes[k])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((q, found.nodes[k]))
        return links

    own = join(values, tree)
    if queries is None:
        return own
    asked = [v & (2**64 - 1) for v in queries]
    join(asked, BKTree(asked))
    return join(asked, tree)


def bucket_keys(fp: str, blocks: int = BLOCKS, agree: int = 2):
    """Array of (block choice, bits of those blocks) of a 64-bit column."""
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    out = []
    for k, choice in enumerate(combinations(range(blocks), agree)):
        mask = sum(((1 << (edge[b + 1] - edge[b])) - 1) << edge[b] for b in choice)
        signed = mask - (1 << 64) if mask >> 63 else mask
        out.append(F.struct(F.lit(k).alias("choice"), F.col(fp).bitwiseAND(F.lit(signed).cast("bigint")).alias("bits")))
    return F.array(*out)


def fingerprint_links(fps: DataFrame, scratch: Scratch, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``, each once, a
    written table) that connect every pair within ``radius`` bits."""
    keyed = scratch.table(
        fps.select("fp", F.explode(bucket_keys("fp", BLOCKS, BLOCKS - radius)).alias("k"))
        .select("fp", F.col("k.choice").alias("choice"), F.col("k.bits").alias("bits")), "buckets")
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    cut = keyed.join(sizes, ["choice", "bits"]).select(
        "choice", "bits", "fp", F.ceil(F.col("n") / shard).cast("int").alias("shards"))
    shards = scratch.table(
        cut.withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
        .groupBy("choice", "bits", "shards", "shard").agg(F.collect_list("fp").alias("tree")), "shards")
    alone = shards.filter(F.size("tree") > 1).select("tree", F.lit(None).cast("array<bigint>").alias("queries"))
    # buckets of several shards: each shard's values are queries to the later shards' trees
    many = shards.filter("shards > 1")
    to = many.withColumn("to", F.explode(F.sequence("shard", F.col("shards") - 1))).filter("to > shard")
    pairs = to.select("choice", "bits", F.col("to").alias("shard"), F.col("tree").alias("queries")).join(
        many.select("choice", "bits", "shard", "tree"), ["choice", "bits", "shard"]).select("tree", "queries")

    def look_up(batches):
        for batch in batches:
            a, b = [], []
            for tree, queries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for x, y in forest_links(tree, queries, radius):
                    a.append(x)
                    b.append(y)
            signed = [np.array(x, dtype=np.uint64).view(np.int64) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in signed], names=["a", "b"])

    return alone.unionByName(pairs).mapInArrow(look_up, "a bigint, b bigint").distinct()


def grouped(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(id, tx, fp, component, component_id) per row: ``tx`` is a hash of the
    text, ``component`` the smallest fingerprint reachable, ``component_id``
    the smallest id."""
    fp = scratch.table(fingerprints(
        docs.select(named(id_col).alias("id"), F.xxhash64(named(text_col)).alias("tx"), named(text_col).alias("text")),
        shingle=shingle), "fp", arrow_rows=STAGE_ROWS)
    roots = scratch.table(fp.groupBy("fp").agg(F.min("id").alias("root")), "roots")
    links = scratch.table(fingerprint_links(roots.select("fp"), scratch, radius), "links")
    parts = connected_components(links, scratch).withColumnRenamed("node", "fp")
    placed = roots.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    groups = placed.groupBy("component").agg(F.min("root").alias("component_id"))
    names = scratch.table(placed.join(groups, "component").select("fp", "component", "component_id"), "names")
    return fp.join(names, "fp")


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """(id, fingerprint hex, component_id) per row of ``docs``.

    The component is the smallest id reachable over links of at most
    ``radius`` differing bits.  Null or wordless text has fingerprint zero and
    links like any other; rows that repeat are rows; a null id never names a
    component unless all its ids are null.  Texts are read whole, whatever
    their length; other columns, of any name, play no part.  An empty table
    gives no row.
    """
    return grouped(docs, scratch, id_col, text_col, shingle, radius).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: a row whose id names it (null
    if all its ids are), columns unchanged.  Where several rows do, because an
    id repeats, the one with the smallest text hash stays, and of rows equal
    in both the first by their other columns as JSON text.  Columns may have
    any name and type, maps included."""
    found = grouped(docs, scratch, id_col, text_col, shingle, radius)
    keep_id, keep_tx = fresh_name(docs, "keep_id"), fresh_name(docs, "keep_tx")
    heads = scratch.table(
        found.filter(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("component", "id", "tx").agg(F.count("*").alias("n"))
        .groupBy("component").agg(F.min(F.struct("tx", "id", "n")).alias("h"))
        .select(F.col("h.id").alias(keep_id), F.col("h.tx").alias(keep_tx), F.col("h.n").alias("n")), "heads")

    def rows_of(part: DataFrame) -> DataFrame:
        return docs.join(part.select(keep_id, keep_tx), (F.xxhash64(named(text_col)) == F.col(keep_tx))
                         & named(id_col).eqNullSafe(F.col(keep_id)), "left_semi")

    kept = rows_of(heads.filter("n = 1"))
    repeated = heads.filter("n > 1")
    if repeated.isEmpty():
        return kept
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    # the other columns travel under their positions, so no name can clash
    row = F.struct(F.lit(1).alias("one"), *(named(c).alias(f"c{i}") for i, c in enumerate(rest)))
    first = rows_of(repeated).groupBy(named(id_col).alias("id"), named(text_col).alias("text")).agg(
        F.min_by(row, F.to_json(row)).alias("row"))
    whole = {id_col: "id", text_col: "text", **{c: f"row.c{i}" for i, c in enumerate(rest)}}
    return kept.unionByName(first.select(*(F.col(whole[c]).alias(c) for c in docs.columns)))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    with Scratch(spark, "op2") as scratch:
        out = scratch.table(near_duplicates(table(spark, sf_dir, "documents"), scratch), "out")
        scratch.keep("out")
        return out
