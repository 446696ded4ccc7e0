"""Sources (T10), pivot (T11, T12) and streaming replay idempotency."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.operators.aggregates import pivot_mean
from fieldlens.schemas import OBSERVATION_RECORD, WEATHER_CSV, WEATHER_NO_CODES, YIELD_CSV
from fieldlens.session import shared_path
from fieldlens.sources.files import read_csv, read_pages, write_csv, write_pages
from fieldlens.streaming.refresh import GoldRefresher


def test_csv_keeps_fips_codes_as_text(spark):
    schema = T.StructType([T.StructField("state_fips", T.StringType()),
                           T.StructField("county_fips", T.StringType())])
    df = spark.createDataFrame([("18", "003")], schema)
    path = write_csv(df, shared_path(spark, "fips_csv"))
    r = read_csv(spark, path, schema).first()
    assert (r["state_fips"], r["county_fips"]) == ("18", "003")


def test_pivot_drops_unseen_types_and_null_keys(spark):
    df = spark.createDataFrame(
        [("c1", dt.date(2025, 1, 1), "TMAX", Decimal("10.00")),
         ("c1", dt.date(2025, 1, 1), "TMAX", Decimal("11.00")),
         ("c1", dt.date(2025, 1, 1), "PRCP", Decimal("0.50")),
         (None, dt.date(2025, 1, 1), "TMAX", Decimal("99.00"))],
        "county string, date date, datatype string, value decimal(18,2)")
    out = pivot_mean(df, ["county", "date"], "datatype", ["TMAX", "TMIN", "PRCP", "TSUN"])
    assert out.columns == ["county", "date", "TMAX", "PRCP"]
    fixed = pivot_mean(df, ["county", "date"], "datatype", ["TMAX", "TMIN", "PRCP", "TSUN"], drop_unseen=False)
    assert [tuple(r)[2:] for r in fixed.collect()] == [(10.5, None, 0.5, None)]
    assert fixed.where("false").columns == ["county", "date", "TMAX", "TMIN", "PRCP", "TSUN"]
    rows = out.collect()
    assert len(rows) == 1 and rows[0]["TMAX"] == 10.5 and rows[0]["PRCP"] == 0.5


def test_pages_without_results_give_no_rows(spark):
    rec = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([(0, "a", 1.0), (0, "b", 2.0), (1, "c", 3.0)],
                               "page long, id string, v double")
    path = write_pages(df, shared_path(spark, "pages"), page_of="page", record_cols=["id", "v"])
    spark.createDataFrame([("done",)], "status string").write.mode("append").json(path)
    got = sorted(r["id"] for r in read_pages(spark, path, rec).collect())
    assert got == ["a", "b", "c"]


def test_replayed_batch_does_not_duplicate_bronze(spark):
    r = GoldRefresher(spark, shared_path(spark, "replay"), lambda y: y, lambda y, w: y,
                      YIELD_CSV, WEATHER_NO_CODES)
    batch = spark.createDataFrame(
        [(1, "A", "S", "corn", 2001, dt.date(2001, 3, 1), Decimal("1.00"))], YIELD_CSV)
    r._on_yields(batch, 7)
    r._on_yields(batch, 7)  # foreachBatch replay of the same batch id
    r._on_yields(batch.withColumn("yield_id", F.lit(2).cast("long")), 8)
    ids = sorted(x["yield_id"] for x in spark.read.parquet(r.bronze_yield).collect())
    assert ids == [1, 2]


def test_late_weather_rewrites_only_its_partition(spark):
    import os

    from fieldlens.plans import gold as G

    r = GoldRefresher(spark, shared_path(spark, "late"),
                      lambda y: G.add_trailing_yield(y, tiebreak=("Harvest_Date", "yield_id")),
                      lambda y, w: G.gold_from_labelled(y, w), YIELD_CSV, WEATHER_NO_CODES)
    ys = spark.createDataFrame(
        [(i, c, "S", "corn", yr, dt.date(yr, 6, 1), Decimal("10.00") + i)
         for i, (c, yr) in enumerate([("A", 2001), ("A", 2002), ("B", 2001), ("B", 2002)])],
        YIELD_CSV)
    wx = spark.createDataFrame(
        [("S", c, dt.date(yr, 5, d), 3.0, Decimal("1.00"), 70.0, 99.0, 50.0)
         for c in ("A", "B") for yr in (2001, 2002) for d in (1, 2)], WEATHER_NO_CODES)
    write_csv(wx, r.landing("weather") + "/d1")
    write_csv(ys, r.landing("yield") + "/d1")
    r.run_once()

    def files(county, year):
        d = f"{r.gold}/State=S/County={county}/Year={year}"
        return sorted(f for f in os.listdir(d) if f.endswith(".parquet"))

    before = {k: files(*k) for k in [("A", 2001), ("A", 2002), ("B", 2001), ("B", 2002)]}
    late = spark.createDataFrame([("S", "A", dt.date(2001, 5, 20), 3.0, Decimal("5.00"), 60.0, 99.0,
                                   40.0)],
                                 WEATHER_NO_CODES)
    write_csv(late, r.landing("weather") + "/d2")
    r.run_once()
    after = {k: files(*k) for k in before}
    assert after[("A", 2001)] != before[("A", 2001)]
    assert all(after[k] == before[k] for k in before if k != ("A", 2001))
    # a late yield of 2002 reads 2002 alone: 2001 stands in by its last rows
    seen = []
    label = r.label_fn
    r.label_fn = lambda y: (seen.append(y), label(y))[1]
    r._on_yields(spark.createDataFrame([(9, "A", "S", "corn", 2002, dt.date(2002, 7, 1), Decimal("30.00"))], YIELD_CSV), 99)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    bronze = next(p for p in plan.split("FileScan")[1:] if "bronze/yield" in p)
    assert ">= 2002" in bronze.split("PartitionFilters: [")[1].split("]")[0]
    avg = {x["Yield_Per_Acre"]: x["5_Year_Avg_Yield"] for x in r.gold_table().where("County = 'A' AND Year = 2002").collect()}
    assert avg == {Decimal("11.00"): 10.0, Decimal("30.00"): 10.5}
    r.label_fn = label
    row = r.gold_table().where("County = 'A' AND Year = 2001").first()
    assert row["60d_Total_Precip"] == 7.0  # 1 + 1 + 5
    # a late file reads only the touched years of both bronze tables
    touched = spark.createDataFrame([("S", "A", 2001, 2001)], "State string, County string, lo int, hi int")
    seen = []
    r.label_fn = lambda y: (seen.append(y), G.add_trailing_yield(y, tiebreak=("Harvest_Date", "yield_id")))[1]
    seen.append(r.touched_inputs(touched)[1])
    for part in seen:
        plan = part._jdf.queryExecution().executedPlan().toString()
        filters = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
        assert any("Year" in f and "<= 2001" in f for f in filters), filters


def test_county_weather_csv_by_name(spark, tmp_path):
    """The county-day layout with codes, another column order, one column more
    and dates with a time; bad fields are NULL and reported."""
    d = tmp_path / "w"
    d.mkdir()
    (d / "a.csv").write_text(
        "Station,state_abbrev,county_fips,county_name,state_fips,date,TMIN,TMAX,TAVG,PRCP,AWND\n"
        "x,IN,003,Foo,09,2020-05-01T00:00:00,1.5,9.5,,0.25,3\n"
        "y,OH,017,\"Bar, the\",39,2020-05-02,1,2,1.5,wet,\n")
    rows = read_csv(spark, str(d), WEATHER_CSV, corrupt="bad").orderBy("county_name").collect()
    assert rows[1][:10] == ("IN", "09", "Foo", "003", dt.date(2020, 5, 1), 3.0, Decimal("0.25"), None, 9.5, 1.5)
    assert rows[1]["bad"] is None
    assert rows[0]["county_name"] == "Bar, the" and rows[0]["PRCP"] is None and "wet" in rows[0]["bad"]
    assert rows[0]["date"] == dt.date(2020, 5, 2)
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.csv").write_text("state_abbrev,county_name\nIN,Foo\n")
    with pytest.raises(ValueError, match="state_fips"):
        read_csv(spark, str(tmp_path / "v"), WEATHER_CSV)


def test_text_station_ids_survive(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"results": [{"date": "2020-05-01", "datatype": "TMAX", "station": "GHCND:USW00014", "value": 3.5}]}')
    r = read_pages(spark, str(tmp_path), OBSERVATION_RECORD).first()
    assert (r["station"], r["value"]) == ("GHCND:USW00014", 3.5)


def test_read_table_sees_new_files(spark, tmp_path):
    from fieldlens.sources.tables import read_table

    p = str(tmp_path / "t.parquet")
    spark.range(10).write.parquet(p)
    assert read_table(spark, str(tmp_path), "t").count() == 10
    spark.range(20).write.mode("append").parquet(p)
    assert read_table(spark, str(tmp_path), "t").count() == 30


def test_left_join_dim_never_multiplies(spark):
    from fieldlens.operators.joins import left_join_dim

    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), (None, "z")], "key string, v string")
    got = sorted((r["n"], r["v"]) for r in left_join_dim(facts, dim, left_on="k", right_on="key", dim_cols=["v"]).collect())
    assert got == [(1, "x"), (2, None), (3, None)]


def test_pivot_looks_for_types_after_the_null_keys_go(spark):
    df = spark.createDataFrame([("a", "TMAX", 1.0), (None, "TMIN", 2.0), ("a", "PRCP", None)],
                               "k string, t string, value double")
    out = pivot_mean(df, ["k"], "t", ["TMAX", "TMIN", "PRCP"])
    assert out.columns == ["k", "TMAX", "PRCP"] and [tuple(r) for r in out.collect()] == [("a", 1.0, None)]


def test_failed_overwrite_keeps_the_old_table(spark):
    from fieldlens.session import unique_name
    from fieldlens.sources.files import save_table

    name = unique_name("kept")
    save_table(spark.range(5), name, shared_path(spark, "kept"))
    bad = spark.range(5).selectExpr("id", "raise_error('no') AS x")
    with pytest.raises(Exception, match="no"):
        save_table(bad, name, shared_path(spark, "kept"))
    assert spark.table(name).count() == 5
    save_table(spark.range(3).selectExpr("id", "id AS other"), name, shared_path(spark, "kept"))
    assert spark.table(name).columns == ["id", "other"]


def test_written_tables_can_be_released(spark):
    import os

    from fieldlens.session import Scratch, materialize, release_written

    release_written(spark)
    a = materialize(spark.range(3), "gone")
    files = [f.removeprefix("file:") for f in a.inputFiles()]
    with Scratch(spark, "s") as sc:
        b = [f.removeprefix("file:") for f in sc.table(spark.range(3), "b").inputFiles()]
        assert all(map(os.path.exists, b))
    assert not any(map(os.path.exists, b)) and all(map(os.path.exists, files))
    assert release_written(spark) >= 1
    assert not any(map(os.path.exists, files))


def test_multiline_pages(spark):
    """A4 with one pretty-printed page per file (``multiLine``)."""
    import json
    import os

    rec = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.DoubleType())])
    d = shared_path(spark, "ml_pages")
    os.makedirs(d)
    pages = [{"metadata": {"count": 2}, "results": [{"id": "a", "v": 1.0}, {"id": "b", "v": 2.0}]},
             {"status": "no more data"}]
    for i, p in enumerate(pages):
        with open(os.path.join(d, f"page-{i}.json"), "w") as f:
            json.dump(p, f, indent=2)
    got = sorted((r["id"], r["v"]) for r in read_pages(spark, d, rec, multiline=True).collect())
    assert got == [("a", 1.0), ("b", 2.0)]


def test_county_day_weather_has_a_fixed_schema(spark):
    """Asked datatypes are columns even where no station matches; leaving out
    unseen ones is an option."""
    from fieldlens.plans.weather import COUNTY_KEYS, county_day_weather

    obs = spark.createDataFrame([("s1", dt.date(2025, 1, 1), "TMAX", 1.0)], "station string, date date, datatype string, value double")
    best = spark.createDataFrame([("g", "s1")], "geoid string, sk string")
    cty = spark.createDataFrame([("g", "OH", "39", "Foo", "001")], "geoid string, state_abbrev string, state_fips string, county_name string, county_fips string")
    kw = dict(station_key="sk", datatypes=["TMAX", "TSUN"])
    none = county_day_weather(obs, best.where("false"), cty, **kw)
    assert none.columns == [*COUNTY_KEYS, "date", "TMAX", "TSUN"] and none.count() == 0
    assert [tuple(r)[5:] for r in county_day_weather(obs, best, cty, **kw).collect()] == [(1.0, None)]
    assert county_day_weather(obs, best, cty, drop_unseen=True, **kw).columns == [*COUNTY_KEYS, "date", "TMAX"]


def test_tail_state_gives_the_averages_of_a_full_run(spark):
    """Yields in random drops, late ones too: gold equals a run over all rows,
    and the state holds at most the window's depth a key and year."""
    import random

    from fieldlens.plans import gold as G

    tie = ("Harvest_Date", "yield_id")
    r = GoldRefresher(spark, shared_path(spark, "tails"), lambda y: G.add_trailing_yield(y, tiebreak=tie),
                      lambda y, w: G.gold_from_labelled(y, w), YIELD_CSV, WEATHER_NO_CODES)
    rng = random.Random(4)
    rows = [(i, rng.choice("AB"), rng.choice(["Ohio", "Indiana"]), rng.choice(["corn", "soy"]), yr,
             dt.date(yr, rng.randint(5, 9), rng.randint(1, 28)), Decimal(rng.randint(100, 9999)) / 100)
            for i, yr in enumerate(rng.choices(range(2000, 2005), k=90))]
    wx = spark.createDataFrame([(s, c, dt.date(yr, 5, d), 3.0, Decimal("1.00"), 70.0, 99.0, 50.0) for s in ("OH", "IN")
                                for c in "AB" for yr in range(2000, 2005) for d in (1, 9)], WEATHER_NO_CODES)
    r._on_weather(wx, 0)
    rng.shuffle(rows)
    for b in range(3):
        r._on_yields(spark.createDataFrame(rows[b::3], YIELD_CSV), b)
    whole = G.gold_features(spark.createDataFrame(rows, YIELD_CSV), wx, tiebreak=tie)
    cols = whole.columns
    assert sorted(map(tuple, r.gold_table().select(cols).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    sizes = spark.read.parquet(r.tails).groupBy("State", "County", "Crop", "Year").count().collect()
    assert max(x["count"] for x in sizes) <= 5 and len(sizes) > 20


def test_a_year_that_holds_most_rows_is_written_by_many_tasks(spark):
    from fieldlens.session import unique_name
    from fieldlens.sources.files import save_table

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128k")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr("id", "if(id % 10 = 0, 1990 + id % 7, 2000) AS Year", "uuid() AS t")
        t = save_table(df, unique_name("rebalanced"), shared_path(spark, "rebalanced"), partition_by=["Year"])
    finally:
        spark.conf.set(key, before)
    files = [f.split("Year=")[1][:4] for f in t.inputFiles()]
    assert files.count("2000") >= 8 and all(files.count(y) <= 2 for y in set(files) - {"2000"})
    assert t.count() == 200_000


def test_rejects_go_to_quarantine_with_file_and_line(spark, tmp_path):
    from fieldlens.session import unique_name
    from fieldlens.sources.files import land_csv

    d = tmp_path / "in"
    d.mkdir()
    (d / "a.csv").write_text("k,n,when\n1,5,2020-01-01\n2,five,2020-01-02\n3,7,soon\n4,x,y\n5,,\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("when", T.DateType())])
    name = unique_name("landed")
    good, bad = land_csv(spark, str(d), schema, name, shared_path(spark, "land"), max_share=0.7)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 5, dt.date(2020, 1, 1)), (5, None, None)]
    assert sorted((r["k"], r["n"], r["_fields"], r["_line"], r["_file"]) for r in bad.collect()) == [
        (2, None, "n", "2,five,2020-01-02", "a.csv"), (3, 7, "when", "3,7,soon", "a.csv"), (4, None, "n,when", "4,x,y", "a.csv")]
    with pytest.raises(ValueError, match="3 of 5 records rejected"):
        land_csv(spark, str(d), schema, name, shared_path(spark, "land"))
    assert spark.table(name).count() == 2  # the table stands as it was


def test_tag_from_the_page_folder(spark):
    rec = T.StructType([T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([(0, "007", 1.0), (0, "GHCND:USW 1/2+%3A", 2.0)], "page long, station string, v double")
    path = write_pages(df, shared_path(spark, "tagged"), page_of="page", record_cols=["v"], tag_cols=["station"], folders=True)
    assert sorted(tuple(r) for r in read_pages(spark, path, rec, tag="station").collect()) == [("007", 1.0), ("GHCND:USW 1/2+%3A", 2.0)]
