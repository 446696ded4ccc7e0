"""The pipeline's stages against brute force, and the registered queries."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlens.llm.common import STAGE_ROWS
from fieldlens.llm.queries import ORACLE, QUERIES
from fieldlens.llm.quality import train_quality, votes
from fieldlens.session import Scratch
from tests.conftest import SF_CHECK, SF_SMALL
from tools.compare import compare_frames, duck_connect


def slow_lines(rows):
    from test_dedup import slow_boilerplate

    bad, first = slow_boilerplate([(r.doc_id, r.text, r.source) for r in rows])
    return {(r.doc_id, "\n".join(x for x in r.text.split("\n")
                                 if x.strip(" ") not in bad or first[x.strip(" ")] == r.doc_id)) for r in rows}


def test_stages_one_after_the_other(spark):
    from test_dedup import slow_components
    from test_pack_search import slow_marks

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    with Scratch(spark, "t") as sc:
        step = []
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = sc.table(stage(spark, docs, SF_SMALL), f"s{i}")
            step.append(docs)
        start = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
        assert all(s.columns == start.columns for s in step[:4])
        rows = [s.collect() for s in [start, *step]]
        posterior, scorer = train_quality(start, sc)
    good = [r for r in rows[0] if scorer.score(r.text.encode()) >= 0.5]
    assert sorted(good) == sorted(rows[1]) and 100 < len(good) < 200
    assert {(r.doc_id, r.text) for r in rows[2]} == slow_lines(rows[1])
    parts = slow_components([(r.doc_id, r.text) for r in rows[2]])
    assert sorted(r.doc_id for r in rows[3]) == sorted({c for _, _, c in parts})
    marks = slow_marks([(r.doc_id, r.text) for r in rows[3]], items)
    assert sorted(r.doc_id for r in rows[4]) == sorted(m[0] for m in marks if not m[5])
    whole = Counter()
    for r in rows[5]:
        whole[r.doc_id] += 1
    assert sorted(whole) == sorted(r.doc_id for r in rows[4])
    assert [tuple(r)[:5] for r in sorted(corpus_pipeline.run(spark, SF_SMALL).collect())] == [
        tuple(r)[:5] for r in sorted(rows[5])]


def test_the_last_stage_holds_the_tokens(spark):
    """Sequences and documents can be built from the result alone."""
    from fieldlens.llm.packing import encode_bytes

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    rows = corpus_pipeline.pack(spark, docs, SF_SMALL).collect()
    assert all(len(r.ids) == 4 * r.length for r in rows)
    want = {r.doc_id: b + bytes(4) for r, b in ((r, encode_bytes([r.text])[0]) for r in docs.collect())}
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got[r.doc_id] = got.get(r.doc_id, b"") + bytes(r.ids)
    assert got == want


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "en", "s", 0),
            (3, "long " * 30000, "en", "s", 150000)]
    kind = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    base = spark.createDataFrame(rows, kind)
    extra = base.withColumns({c: F.lit(1) for c in ("quality", "hits", "bad", "tx", "keep_id", "n", "h", "fp", "id")})
    for docs in (extra, extra.limit(0)):
        with Scratch(spark, "t") as sc:
            for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
                out = sc.table(stage(spark, docs, SF_SMALL), f"s{i}")
                if i < 4:
                    assert out.columns == docs.columns
                docs = out
            docs.count()


def test_no_whole_text_leaves_a_stage_through_an_unbounded_batch(spark, monkeypatch):
    """The caller's Arrow batch size (10,000 rows) does not hold for the texts
    of the classifier, SimHash and packing: they write them in small batches.
    Decontamination scans as its rows are written, with the caller's."""
    seen = []
    table = Scratch.table

    def spy(self, df, part, partition_by=(), arrow_rows=None):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append(("MapInArrow" in plan and bool(re.search(r"\b(text|t|__text|ids)#", plan)), arrow_rows, part))
        return table(self, df, part, partition_by, arrow_rows)

    monkeypatch.setattr(Scratch, "table", spy)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).localCheckpoint()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name == "benchmark decontamination":
            continue
        for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n"):
            assert "MapInArrow" not in line or not re.search(r"\b(text|ids)#", line), line
    assert all(rows and rows <= STAGE_ROWS for wide, rows, _ in seen if wide), seen
    assert {part for wide, _, part in seen if wide} >= {"votes", "out", "fp", "pieces"}


def test_a_task_gives_the_memory_arrow_keeps_back(monkeypatch):
    import pyarrow as pa

    from fieldlens.llm.common import releasing

    class Pool:
        calls = 0

        def release_unused(self):
            self.calls += 1

    pool = Pool()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    given = releasing(iter([1, 2]))
    assert next(given) == 1 and pool.calls == 0
    assert list(given) == [2] and pool.calls == 1


def test_thirteen_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    numbers = {int(m[1]) for k in entry.queries() if (m := re.match(r"op(\d+)_", k))}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    df = QUERIES[name](spark, SF_CHECK)
    cur = duck_connect(SF_CHECK).execute(ORACLE[name])
    r = compare_frames([tuple(x) for x in df.collect()], df.columns, cur.fetchall(), [c[0] for c in cur.description])
    assert r["exact"], r
