"""Merkle manifest of a dataset: leaf, subroot, root and proof of every row.

The leaves of a group lie in id order at positions 0, 1, ...; runs of
``fanout`` consecutive nodes hash to their parent until one node, the group's
subroot, is left; the subroots in group order hash to the root the same way.

Levels are lag/lead windows.  On level l a node's hash stands on the row of its
first leaf, so its neighbours lie exactly ``fanout**l`` rows away: fixed-offset
lag and lead columns, masked by the node's slot in its run and by the length
of the run (the last run of a level may be shorter), are its siblings, and rows
that are a first child hash the run to the parent.

Scale: positions come from a range-partitioned written table and block totals,
so a group that holds most rows is numbered by many tasks.  A window never
spans a group: positions are cut into blocks of ``fanout**levels`` rows (1024 by
default), aligned to the runs, and one exchange on (group, block) serves all
levels of a block.  The block roots, a thousandth of the rows, are the leaves of
the next pass, until every group has one node.  Texts are read once, for the
leaf hash; only hashes and positions are exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import fresh_name, table
from fieldlens.operators.partitioning import BLOCK, range_blocks
from fieldlens.session import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_ROWS = 1024
_STEP = "struct<left:string,right:string>"
EMPTY = "''"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """Hash of a row: each value as ``-`` if null, else its UTF-8 byte count,
    ``:`` and the value as text."""
    def framed(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return digest(*[framed(v) for v in values])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (the siblings left and right of its
    node, level by level; a null step is a level that the group lacks) lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.when(s.isNull(), h).otherwise(
        F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256)))


def path_digest(path: Column) -> Column:
    """sha256 of all siblings of a path, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def positions(nodes: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``nodes`` (column ``g`` and others) with ``pos``, the place of each row in
    its group under ``order`` (end it with a unique column), and ``n``, the
    rows of the group."""
    cut = range_blocks(nodes, ["g", *order], name=name)
    totals = cut.groupBy("g", BLOCK).agg(F.count("*").alias("_rows"))
    upto = Window.partitionBy("g").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("g").alias("_g"), F.col(BLOCK).alias("_b"),
                           F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_first"),
                           F.sum("_rows").over(Window.partitionBy("g")).alias("n"))
    local = Window.partitionBy("g", BLOCK).orderBy(*order)
    placed = cut.withColumn("_r", F.row_number().over(local) - 1)
    return placed.join(totals, (F.col("g") == F.col("_g")) & (F.col(BLOCK) == F.col("_b"))).select(
        *nodes.columns, (F.col("_first") + F.col("_r")).alias("pos"), "n")


def climb(nodes: DataFrame, fanout: int, levels: int, paths: bool) -> DataFrame:
    """``levels`` levels above ``nodes`` (g, pos, n, h, ...), block by block.

    A block is column ``blk`` (pos div fanout**levels).  Adds ``top``, on the
    first row of a block the block's root.  With ``paths`` every row also gets
    ``path``: its steps on these levels.
    """
    df, base = nodes, [c for c in nodes.columns if c != "h"]
    w = Window.partitionBy("g", "blk").orderBy("pos")
    steps, apart = [], range(1, fanout)
    for level in range(levels):
        stride = fanout ** level
        df = df.select("*", *[F.lag("h", j * stride).over(w).alias(f"_b{j}") for j in apart],
                       *[F.lead("h", j * stride).over(w).alias(f"_a{j}") for j in apart])
        # nodes of the group on this level, the node's slot in its run, the run's length
        count = f"((n + {stride - 1}) div {stride})"
        slot = f"(pos div {stride} % {fanout})"
        run = f"least({fanout}, {count} - (pos div {stride} - {slot}))"
        left = f"concat({', '.join(f'if({slot} >= {j}, _b{j}, {EMPTY})' for j in reversed(apart))})"
        right = f"concat({', '.join(f'if({slot} + {j} < {run}, _a{j}, {EMPTY})' for j in apart)})"
        head = f"pos % {stride} = 0"  # a row that carries a node of this level
        now = []
        if paths:
            now = [F.expr(f"if({head}, named_struct('left', {left}, 'right', {right}, 'live', {count} > 1), null)")
                   .alias(f"_s{level}")]
        parent = f"if({head} AND {slot} = 0, if({count} > 1, sha2(cast(concat(h, {right}) AS binary), 256), h), null)"
        df = df.select(*base, *steps, *now, F.expr(parent).alias("h"))
        steps += [f"_s{level}"] if paths else []
    if not paths:
        return df.withColumnRenamed("h", "top")
    # a node's step stands on its first row: carry it to the node's other rows
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.select(*base, F.col("h").alias("top"), *[F.last(s, ignorenulls=True).over(upto).alias(s) for s in steps])
    path = F.array(*[F.when(F.col(f"{s}.live"), F.struct(f"{s}.left", f"{s}.right")).cast(_STEP) for s in steps])
    return df.select(*base, "top", path.alias("path"))


def _tree(nodes: DataFrame, scratch: Scratch, name: str, fanout: int, levels: int, carry: Sequence[str]) -> DataFrame:
    """(g, carried columns, path, subroot) of every row of the written ``nodes``
    (g, pos, n, h, carried columns)."""
    widest = nodes.agg(F.max("n")).head()[0] or 0
    passes, climbs = [nodes], []
    while widest > 1:
        m = 1  # levels of this pass: as many as the widest group needs
        while m < levels and fanout ** m < widest:
            m += 1
        size = fanout ** m
        roots = climb(passes[-1].select("g", "pos", "n", "h", F.expr(f"pos div {size} AS blk")), fanout, m, False).where(
            F.col("pos") % size == 0).select("g", F.col("blk").alias("pos"),
                                             F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("h"))
        passes.append(scratch.table(roots, f"{name}{len(passes)}"))
        climbs.append(m)
        widest = -(-widest // size)
    none = F.array().cast(f"array<{_STEP}>").alias("path")
    if not climbs:
        return nodes.select("g", "pos", *carry, none, F.col("h").alias("subroot"))
    # from the last pass (one node a group) down: a row's path, then its block's
    above = passes[-1].select("g", "pos", none, F.col("h").alias("subroot"))
    for i in range(len(climbs) - 1, -1, -1):
        cols, size = list(carry) if i == 0 else [], fanout ** climbs[i]
        up = above.select(F.col("g").alias("_g"), F.col("pos").alias("_p"), F.col("path").alias("_up"), "subroot")
        joined = passes[i].select("*", F.expr(f"pos div {size} AS blk")).join(
            up, (F.col("g") == F.col("_g")) & (F.col("blk") == F.col("_p")))
        above = climb(joined.drop("_g", "_p"), fanout, climbs[i], True).select(
            "g", "pos", *cols, F.concat("path", "_up").alias("path"), "subroot")
    return above


def merkle_manifest(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", group_col: str = "lang",
                    fields: Sequence[str] = FIELDS, fanout: int = 2, block_rows: int = BLOCK_ROWS,
                    extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``df``: the id, ``leaf``, ``subroot``, ``root``,
    ``path`` (its siblings from the leaf to the root, for :func:`fold`), and
    the columns of ``extra`` (name -> Column over ``df``).

    Leaves of a group ascend by id, a null id first; rows that repeat an id are
    leaves each, in the order of their hashes, and rows equal in all ``fields``
    are interchangeable.  A null group is a group of its own, before all
    others; an empty text is a value, a null one is not.  A leaf is one hash
    over the whole text, however long.  A group of one row has its leaf as
    subroot, and a single subroot is the root.  An empty table gives no row.
    Other columns of ``df`` are not read, whatever their names.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    levels = 1
    while fanout ** (levels + 1) <= block_rows:
        levels += 1
    extra = extra or {}
    col = lambda c: F.col(f"`{c}`")
    group = F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit(""))
    leaves = scratch.table(df.select(
        group.alias("g"), col(id_col).alias("id"), leaf_hash([col(c) for c in fields]).alias("h"),
        *[c.alias(f"x_{name}") for name, c in extra.items()]).withColumn(
            "row", F.monotonically_increasing_id()), "leaves")
    carry = ["id", "leaf", *[f"x_{name}" for name in extra]]
    nodes = scratch.table(positions(leaves, ["id", "h", "row"], "merkle").withColumn("leaf", F.col("h")).drop("row"),
                          "nodes")
    rows = scratch.table(_tree(nodes, scratch, "pass", fanout, levels, carry), "paths")
    # a subroot stands on its group's last pass; the groups' tree is built alike
    tops = rows.where("pos = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("subroot").alias("h"))
    groups = scratch.table(positions(scratch.table(tops, "subroots"), ["name"], "merkle-groups"), "groups")
    crown = _tree(groups, scratch, "crown", fanout, levels, ["name"]).select(
        F.col("name").alias("_g"), F.col("path").alias("_up"), F.col("subroot").alias("root"))
    return rows.join(crown, F.col("g") == F.col("_g")).select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", F.concat("path", "_up").alias("path"),
        *[F.col(f"x_{name}").alias(name) for name in extra])


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    """All documents; those whose id's CRC-32 is divisible by 7 are verified
    with one more character claimed than stored."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(tampered, F.col("n_chars").cast("decimal(38,0)") + 1).otherwise(F.col("n_chars"))
    seen = leaf_hash([claimed if c == "n_chars" else F.col(c) for c in FIELDS])
    name = fresh_name(docs, "seen")
    with Scratch(spark, "op11") as scratch:
        m = merkle_manifest(docs, scratch, extra={name: seen}).withColumn("folded_root", fold(F.col(name), F.col("path")))
        out = scratch.table(m.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                                     "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")), "out")
        scratch.keep("out")
        return out
