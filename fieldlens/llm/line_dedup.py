"""Cross-site line dedup by distinct-site spread, in DataFrame functions only.

A line that stands on many different sites is boilerplate.  One aggregate keeps
a HyperLogLog sketch of the sites per line hash (Spark's approx_count_distinct:
partial sketches per task, merged after the exchange) and the line's smallest
document.  Lines far from the threshold are decided by the sketch; lines near
it get an exact distinct count.  Boilerplate lines are then cut from every
document but the first that holds them, so that no text vanishes everywhere.

The threshold does not loosen as a corpus grows: lines of fewer than
``min_words`` words recur in any prose and never count, and a line in n
documents must stand on no fewer sites than n documents dealt at random would
reach (less two standard deviations), so a line common on a few sites of very
many is theirs, not boilerplate.  ``min_sites`` is the least in any case.

Scale: a line that stands in a third of all documents is one sketch per task.
Line hashes have 128 bits.  Only lines that can be boilerplate leave the
aggregate; which documents they hit is an equi join.  What chance gives needs the
sites' sizes only by powers of two, at most 63 pairs of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import fresh_name, named, table
from fieldlens.session import Scratch

MIN_SITES = 8
MIN_WORDS = 4
WORD = r"[^\x20\x09-\x0D]+"
NEAR = 0.5
SKETCH_ERROR = 0.1


def line_key(line: Column) -> Column:
    """128-bit key of a trimmed line."""
    t = F.trim(line)
    return F.struct(F.xxhash64(t).alias("h"), F.xxhash64(F.lit(1), t).alias("g"))


def site_sizes(docs: DataFrame, site_col: str) -> list[tuple[int, float]]:
    """(number of sites, mean share of the rows) of the sites whose row counts
    have equally many binary digits."""
    sites = docs.select(named(site_col).alias("site")).dropna().groupBy("site").agg(F.count("*").alias("n"))
    rows = sites.groupBy(F.length(F.bin("n")).alias("digits")).agg(
        F.count("*").alias("sites"), F.sum("n").alias("n")).orderBy("digits").collect()
    total = sum(r.n for r in rows)
    return [(r.sites, r.n / r.sites / total) for r in rows]


def chance_sites(n: Column, sizes: list[tuple[int, float]]) -> Column:
    """Distinct sites that ``n`` documents dealt at random reach, less two
    standard deviations (sites taken as independent, which is never less)."""
    missed = [(k, F.pow(F.lit(1 - p), n)) for k, p in sizes]
    mean = sum((F.lit(k) * (1 - q) for k, q in missed), F.lit(0.0))
    var = sum((F.lit(k) * q * (1 - q) for k, q in missed), F.lit(0.0))
    return F.round(mean - 2 * F.sqrt(var), 6)


def line_keys(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int = 0) -> DataFrame:
    """(id, tx, site, h, g): the distinct non-blank lines of each document, of
    at least ``min_words`` words; ``tx`` tells texts with equal or null ids apart."""
    lines = F.filter(F.array_distinct(F.transform(F.split(named(text_col), "\n"), lambda x: F.trim(x))),
                     lambda x: (x != "") & (F.regexp_count(x, F.lit(WORD)) >= min_words))
    return docs.select(named(id_col).alias("id"), F.xxhash64(named(text_col)).alias("tx"), named(site_col).alias("site"),
                       F.explode(lines).alias("line")).select("id", "tx", "site", line_key(F.col("line")).alias("k")) \
        .select("id", "tx", "site", "k.h", "k.g")


def boilerplate_lines(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                      site_col: str = "source", min_sites: int = MIN_SITES,
                      min_words: int = MIN_WORDS) -> DataFrame:
    """(h, g, first): lines of at least ``min_words`` words on at least
    ``min_sites`` distinct sites and on no fewer than chance gives their number
    of documents, with the smallest id that holds each.  Null sites are not
    sites, and rows without one do not count as documents."""
    lines = line_keys(docs, id_col, text_col, site_col, min_words)
    least = F.greatest(F.lit(float(min_sites)), chance_sites(F.col("n"), site_sizes(docs, site_col)))
    sketched = lines.groupBy("h", "g").agg(
        F.approx_count_distinct("site", SKETCH_ERROR).alias("sites"), F.count("site").alias("n"),
        F.min("id").alias("first")) \
        .withColumn("least", least).filter(F.col("sites") >= F.col("least") * (1 - NEAR))
    spread = scratch.table(sketched, "spread")
    sure = spread.filter(F.col("sites") > F.col("least") * (1 + NEAR))
    near = spread.filter(F.col("sites") <= F.col("least") * (1 + NEAR))
    exact = lines.join(near.select("h", "g"), ["h", "g"], "left_semi").groupBy("h", "g").agg(
        F.count_distinct("site").alias("exact"))
    return scratch.table(
        sure.select("h", "g", "first").unionByName(
            near.join(exact, ["h", "g"]).filter("exact >= least").select("h", "g", "first")),
        "boilerplate")


def drop_boilerplate(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                     site_col: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
                     removed: str | None = None) -> DataFrame:
    """``docs`` with boilerplate lines cut out of the text, rows and columns
    unchanged; with ``removed`` a column of that name counts the cut lines.

    The document with the smallest id that holds a line keeps it (rows that
    repeat that id all do; if every id is null, nobody does).  Blank lines are
    never cut; a text may become empty; null stays null.  Texts are cut into
    lines whole, whatever their length.  Columns may have any name and type.
    An empty table gives no row.
    """
    bad = boilerplate_lines(docs, scratch, id_col, text_col, site_col, min_sites, min_words)
    hits = scratch.table(
        line_keys(docs, id_col, text_col, site_col, min_words).join(bad, ["h", "g"])
        .filter(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id", "tx").agg(F.collect_set(F.struct("h", "g")).alias("bad")), "hits")
    bad_col, tx = fresh_name(docs, "bad"), fresh_name(docs, "tx")
    keyed = docs.withColumn(tx, F.xxhash64(named(text_col)))
    hit_id, hit_tx = fresh_name(docs, "hit_id"), fresh_name(docs, "hit_tx")
    to = hits.select(F.col("id").alias(hit_id), F.col("tx").alias(hit_tx), F.col("bad").alias(bad_col))
    joined = keyed.join(to, (F.col(tx) == F.col(hit_tx)) & named(id_col).eqNullSafe(F.col(hit_id)), "left")
    lines = F.split(named(text_col), "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(bad_col), line_key(x)))
    text = F.when(F.col(bad_col).isNull(), named(text_col)).otherwise(F.array_join(kept, "\n"))
    out = [text.alias(c) if c == text_col else named(c) for c in docs.columns]
    if removed:
        out.append(F.when(F.col(bad_col).isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept))
                   .cast("bigint").alias(removed))
    return joined.select(*out)


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    with Scratch(spark, "op4") as scratch:
        cut = drop_boilerplate(docs, scratch, removed="n_removed").select(
            "doc_id", "n_removed", F.octet_length("text").cast("bigint").alias("n_bytes"),
            F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
        out = scratch.table(cut, "out")
        scratch.keep("out")
        return out
