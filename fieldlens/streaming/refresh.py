"""Refresh the gold table when new files reach the dataset folders.

Two file streams (yields, daily weather) run with ``trigger(availableNow)``:
each run picks up only the files that arrived since the last run (the stream
checkpoint remembers them) and stops.  Every micro-batch:

1. lands its raw rows in the bronze table under partitions ``(Year, batch_id)``
   with a dynamic partition overwrite - ``foreachBatch`` may replay a batch
   after a failure, and a replay rewrites the same partitions instead of
   appending duplicates; the later steps read the landed partition back;
2. works out which gold partitions ``(State, County, Year)`` it invalidates:
   * late weather of (state, county, year) changes only the look-back features
     of that county-year;
   * a late yield of (state, county, year Y) changes its own features and the
     trailing average of the later rows of its crop, i.e. every year >= Y of
     the county;
3. recomputes those partitions and overwrites exactly them in the gold table
   (dynamic partition overwrite; other partitions are untouched).  Years
   outside the touched range are pruned at both bronze scans.  What the
   trailing average needs of earlier years comes from a maintained state table:
   the last rows of every key in every year (``tail_rows`` each, partitioned
   like gold), rewritten for the years a batch of yields touches.  A late yield
   therefore never re-reads its county's past.

Partitioned writes are rebalanced, so a county or year that holds most rows is
written by many tasks.

No watermark is needed: late files are handled by recomputing the touched
partitions, and every step is a batch recompute of bounded scope.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.exprs import state_key
from fieldlens.sources.files import CORRUPT, by_partition, csv_columns, csv_text_schema

CONTEXT = "_fl_context"

LabelFn = Callable[[DataFrame], DataFrame]
FeaturesFn = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass
class GoldRefresher:
    spark: SparkSession
    root: str
    label_fn: LabelFn  # yields -> yields + trailing average + label (other columns kept)
    features_fn: FeaturesFn  # (labelled yields, weather) -> gold rows
    yield_schema: T.StructType
    weather_schema: T.StructType
    # the trailing window of label_fn: its keys, its order within a year, its depth
    tail_keys: Sequence[str] = ("State", "County", "Crop")
    tail_order: Sequence[str] = ("Harvest_Date", "yield_id")
    tail_rows: int = 5

    @property
    def bronze_yield(self) -> str:
        return f"{self.root}/bronze/yield"

    @property
    def bronze_weather(self) -> str:
        return f"{self.root}/bronze/weather"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def tails(self) -> str:
        return f"{self.root}/state/yield_tails"

    def landing(self, table: str) -> str:
        return f"{self.root}/landing/{table}"

    # ---------------------------------------------------------------- io
    def _land(self, batch: DataFrame, year, path: str, batch_id: int) -> None:
        rows = batch.withColumn("Year", year.cast("int")).withColumn("batch_id", F.lit(int(batch_id)))
        (by_partition(rows, ["Year"])
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("Year", "batch_id").parquet(path))

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).exists(p)

    def _read(self, path: str, schema: T.StructType) -> DataFrame | None:
        """A bronze table with its partition columns Year and batch_id."""
        if not self._exists(path):
            return None
        rest = [f for f in schema if f.name not in ("Year", "batch_id")]
        full = T.StructType([*rest, T.StructField("Year", T.IntegerType()),
                             T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(full).parquet(path)

    # ------------------------------------------------------------- state
    def _last_rows(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        """The last ``tail_rows`` rows of each key (limited before the shuffle)."""
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        return df.withColumn("_fl_n", F.row_number().over(w)).where(F.col("_fl_n") <= self.tail_rows).drop("_fl_n")

    def update_tails(self, touched: DataFrame | None = None) -> None:
        """Rewrite the state of the touched (State, County, Year); of all without
        ``touched``.  Computed from the bronze rows of those years alone, so a
        replayed batch writes the same rows again."""
        y = self._read(self.bronze_yield, self.yield_schema).drop("batch_id")
        if touched is not None:
            span = touched.agg(F.min("Year").alias("lo"), F.max("Year").alias("hi")).head()
            if span["lo"] is None:
                return
            y = y.where(F.col("Year").between(span["lo"], span["hi"])).join(
                touched, ["State", "County", "Year"], "left_semi").select(*y.columns)
        last = self._last_rows(y, [*self.tail_keys, "Year"], self.tail_order)
        keys = ["State", "County", "Year"]
        (by_partition(last, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(self.tails))

    def _context(self, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The rows before each touched county's first year that its trailing
        averages reach back to: at most ``tail_rows`` a key."""
        schema = T.StructType([f for f in self.yield_schema])
        tails = self.spark.read.schema(schema).parquet(self.tails)
        old = tails.join(touched, (state_key(tails["State"]) == touched["_ts"]) & (tails["County"] == touched["_tc"])
                         & (tails["Year"] < touched["_lo"]), "left_semi")
        return self._last_rows(old, self.tail_keys, ["Year", *self.tail_order]).select(*columns)

    # ----------------------------------------------------------- refresh
    def touched_inputs(self, touched: DataFrame) -> tuple[DataFrame, DataFrame] | None:
        """(labelled yields to recompute, weather) for ``touched``: rows (State,
        County, lo, hi) meaning years lo..hi of that county, hi null without
        an end.  The overall first and last year are two numbers on the driver
        and prune the partitions of both bronze scans."""
        y = self._read(self.bronze_yield, self.yield_schema)
        w = self._read(self.bronze_weather, self.weather_schema)
        if y is None or w is None:
            return None
        span = touched.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                           F.count(F.when(F.col("hi").isNull(), 1)).alias("open")).head()
        if span["lo"] is None:
            return None
        if not self._exists(self.tails):  # bronze rows from before the state was kept
            self.update_tails()
        y, w = y.where(F.col("Year") >= span["lo"]), w.where(F.col("Year") >= span["lo"])
        if not span["open"]:
            y, w = y.where(F.col("Year") <= span["hi"]), w.where(F.col("Year") <= span["hi"])
        t = touched.groupBy(state_key("State").alias("_ts"), F.col("County").alias("_tc")).agg(
            F.min("lo").alias("_lo"))
        y = y.drop("batch_id")
        y = y.join(t, (state_key(y["State"]) == t["_ts"]) & (y["County"] == t["_tc"]) & (y["Year"] >= t["_lo"]), "left_semi")
        # the years before a county's first touched one stand in by their last rows
        known = self._context(t, y.columns).withColumn(CONTEXT, F.lit(True))
        labelled = self.label_fn(y.withColumn(CONTEXT, F.lit(False)).unionByName(known)).where(~F.col(CONTEXT)).drop(CONTEXT)
        rng = touched.select(state_key("State").alias("_ts"), F.col("County").alias("_tc"), "lo", "hi")
        keep = labelled.join(
            rng, (state_key(labelled["State"]) == rng["_ts"]) & (labelled["County"] == rng["_tc"])
            & (labelled["Year"] >= rng["lo"]) & (rng["hi"].isNull() | (labelled["Year"] <= rng["hi"])),
            "left_semi")
        w = w.join(t, (state_key(w["state_abbrev"]) == t["_ts"]) & (w["county_name"] == t["_tc"])
                   & (w["Year"] >= t["_lo"]), "left_semi")
        return keep, w.drop("Year", "batch_id")

    def refresh(self, touched: DataFrame) -> None:
        """Recompute the gold partitions named by ``touched``."""
        found = self.touched_inputs(touched)
        if found is None:
            return
        keys = ["State", "County", "Year"]
        (by_partition(self.features_fn(*found), keys)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(self.gold))

    def _on_yields(self, batch: DataFrame, batch_id: int) -> None:
        self._land(batch, F.col("Year"), self.bronze_yield, batch_id)
        landed = self._read(self.bronze_yield, self.yield_schema).where(F.col("batch_id") == int(batch_id))
        self.update_tails(landed.select("State", "County", "Year").distinct())
        self.refresh(landed.groupBy("State", "County").agg(
            F.min("Year").alias("lo"), F.lit(None).cast("int").alias("hi")))

    def _on_weather(self, batch: DataFrame, batch_id: int) -> None:
        self._land(batch, F.year("date"), self.bronze_weather, batch_id)
        landed = self._read(self.bronze_weather, self.weather_schema).where(F.col("batch_id") == int(batch_id))
        self.refresh(landed.select(F.col("state_abbrev").alias("State"), F.col("county_name").alias("County"),
                                   F.col("Year").alias("lo"), F.col("Year").alias("hi")).distinct())

    # ------------------------------------------------------------ streams
    def run_once(self) -> None:
        """Process every file that has landed since the last run, then stop."""
        for table, schema, handler in (
            ("weather", self.weather_schema, self._on_weather),
            ("yield", self.yield_schema, self._on_yields),
        ):
            if not self._exists(self.landing(table)):
                continue
            src = csv_columns(
                self.spark.readStream.schema(csv_text_schema(self.spark, self.landing(table), schema))
                .option("header", True).option("enforceSchema", False)
                .option("recursiveFileLookup", True).option("columnNameOfCorruptRecord", CORRUPT)
                .csv(self.landing(table)), schema)
            q = (src.writeStream.foreachBatch(handler)
                 .option("checkpointLocation", f"{self.root}/_checkpoints/{table}")
                 .trigger(availableNow=True).start())
            q.awaitTermination()

    def gold_table(self) -> DataFrame:
        return self.spark.read.option("basePath", self.gold).parquet(self.gold)
