"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``fieldlens.llm`` on all rows the stage before
kept.  ``STAGES`` are (name, function(spark, docs, sf_dir) -> DataFrame); all
but the last return the columns of ``documents``.  ``run`` writes every
stage's rows as Parquet in the shared folder and rereads them as the next
stage's documents, so a lost executor repeats at most one stage.  The classifier
and the packing write whole texts and token ids in small Arrow batches, whatever
the caller's setting: the memory a large batch takes stays with the executor.

Stages: the quality classifier rejects documents; line dedup cuts cross-site
boilerplate lines (documents stay, a text may become empty); one document of
each SimHash group stays; documents with a benchmark window go; what is left is
packed into sequences of at most 2048 tokens, each piece with its token ids
(little-endian unsigned 32-bit).  Null and empty texts, repeated
rows and empty tables have the results their operators document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm.common import STAGE_ROWS, table
from fieldlens.llm.decontaminate import drop_contaminated
from fieldlens.llm.line_dedup import drop_boilerplate
from fieldlens.llm.packing import pack_documents
from fieldlens.llm.quality import keep_good
from fieldlens.llm.simhash import drop_near_duplicates
from fieldlens.session import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with Scratch(spark, "stage-quality") as scratch:
        out = scratch.table(keep_good(docs, scratch), "out", arrow_rows=STAGE_ROWS)
        scratch.keep("out")
        return out


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with Scratch(spark, "stage-lines") as scratch:
        out = drop_boilerplate(docs, scratch)
        scratch.keep("hits")
        return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with Scratch(spark, "stage-simhash") as scratch:
        out = drop_near_duplicates(docs, scratch, shingle=3, radius=3)
        scratch.keep("heads")
        return out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with Scratch(spark, "stage-packing") as scratch:
        out = pack_documents(docs, scratch, with_ids=True)
        scratch.keep("pieces")
        return out


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

# The classifier, SimHash and the packing have no SQL form; tests/llm holds
# each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for i, (_, stage) in enumerate(STAGES):
            docs = scratch.table(stage(spark, docs, sf_dir), f"stage{i}")
        scratch.keep(f"stage{len(STAGES) - 1}")
    return docs
