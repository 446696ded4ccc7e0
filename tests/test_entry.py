"""Driver contract: entry smoke run and every oracle query against DuckDB."""

import pytest

import __spark_entry__ as E
from tools.compare import compare_frames, duck_connect

from conftest import SF_CHECK, SF_SMALL

# This oracle lists the categories seen at sf0.01 (the schema depends on the
# data), so the query is checked at sf0.01; those of BOTH_SCALES at both.
BOTH_SCALES = ["weather_build", "weather_from_pages"]
AT_CHECK_SCALE = {"onehot_encode"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:8] == ["County", "State", "Year", "Crop", "Harvest_Date",
                              "Yield_Per_Acre", "5_Year_Avg_Yield", "Yield_Status"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45


@pytest.mark.parametrize("name, sf", [
    *[(n, SF_CHECK if n in AT_CHECK_SCALE else SF_SMALL) for n in sorted(set(E.oracle_sql()))],
    *[(n, SF_CHECK) for n in BOTH_SCALES]])
def test_query_matches_oracle(spark, name, sf):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = duck_connect(sf).execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    res = compare_frames(rows, df.columns, drows, [c[0] for c in cur.description])
    assert res["names_ok"], (sorted(df.columns), [c[0] for c in cur.description])
    assert res["rows"][0] == res["rows"][1]
    assert res["exact"], res


@pytest.mark.parametrize("name", ["rolling_yield", "gold_features", "residual_bands",
                                  "split_impact", "farmer_summary"])
def test_many_blocks_match_oracle(spark, name):
    """Many small blocks: keys cross block borders on the real tables."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    cur = duck_connect(SF_SMALL).execute(E.oracle_sql()[name])
    res = compare_frames(rows, df.columns, cur.fetchall(), [c[0] for c in cur.description])
    assert res["exact"], res


def test_entry_works_without_the_training_data_folders(tmp_path):
    """The subpackage and the pipeline removed: the rest still imports."""
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(os.path.join(top, "fieldlens"), tmp_path / "fieldlens",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(E.__file__, tmp_path)
    code = ("import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); "
            "assert len(q) >= 50 and set(o) <= set(q) and not any(k.startswith('op') for k in q), q")
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True)


def test_nothing_else_imports_the_subpackage():
    import os
    import re

    top = os.path.join(os.path.dirname(os.path.abspath(E.__file__)), "fieldlens")
    for d, _, files in os.walk(top):
        if os.sep + "llm" not in d:
            for f in files:
                if f.endswith(".py"):
                    assert not re.search(r"fieldlens\.llm|corpus_pipeline", open(os.path.join(d, f)).read()), f
