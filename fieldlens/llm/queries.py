"""The registered queries of the training-data operators."""

from __future__ import annotations

import corpus_pipeline
from fieldlens.llm.ann import op13_nearest
from fieldlens.llm.common import table
from fieldlens.llm.decontaminate import contamination_report
from fieldlens.llm.fim import op12_fim
from fieldlens.llm.license_scan import op3_license_scan
from fieldlens.llm.line_dedup import op4_line_dedup
from fieldlens.llm.merkle import op11_merkle
from fieldlens.llm.oracle import ORACLE as _SQL
from fieldlens.llm.packing import op6_packing
from fieldlens.llm.quality import op10_quality
from fieldlens.llm.sharding import op5_sharding
from fieldlens.llm.simhash import op2_simhash
from fieldlens.llm.suffix_dedup import op9_suffix_dedup
from fieldlens.llm.topk import op8_topk
from fieldlens.llm.toxicity import op1_toxicity


def op7_decontamination(spark, sf_dir: str):
    """All documents against all benchmark items."""
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_decontamination": op7_decontamination,
    "op8_topk": op8_topk,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_fim": op12_fim,
    "op13_nearest": op13_nearest,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {k: v for k, v in _SQL.items() if k in QUERIES}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
