"""What several passes read is stored once, and a hot series is no single task's."""

from frames import scored
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_cascade import some_scores
from test_plans import plan

from shelfspark import names as N
from shelfspark.operators import scorers, split
from shelfspark.plans import catalog, jobs
from shelfspark.sources import readers, writers


def series(spark, rows=400):
    return spark.range(rows).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 8)).alias("s"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("date"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("tie"), "id",
    )


def test_split_moves_no_row_to_small_cuts_and_spreads_a_hot_series(spark, monkeypatch):
    def labels():
        out = split.time_split(series(spark), ["s"], ties=["tie"], min_rows=10)
        return out, sorted((r.id, r[N.DATA_SPLIT]) for r in out.collect())

    def conf(threshold):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        conf("10m")
        out, expected = labels()
        assert "SortMergeJoin" not in plan(out)
        monkeypatch.setattr(split, "PART_ROWS", 20)
        conf("-1")
        out, got = labels()
        assert got == expected and len(got) == 400
        assert "SortMergeJoin" in plan(out) and "_part" in plan(out)
    finally:
        conf(before)


def test_estimator_reads_stored_rows(spark):
    class Estimator:
        def getLabelCol(self):
            return "y"

        def getFeaturesCol(self):
            return "v"

        def fit(self, df):
            return df.inputFiles(), df.count()

    train = spark.createDataFrame([(1.0, 2, 0), (None, 3, 1), (2.0, 5, 1)], "a double, b long, y long")
    files, rows = scorers.fit_ml_model(train, Estimator(), ["a", "b"])
    assert rows == 2 and files and all("ml-train" in f for f in files)


def test_split_job_joins_once(spark, monkeypatch, tmp_path):
    seen = []
    monkeypatch.setattr(split, "time_split", lambda df, **_: seen.append(df.inputFiles()) or df.withColumn(N.DATA_SPLIT, F.lit("train")))
    rows = spark.range(30).select(
        F.col("id").cast("string").alias("sku"), F.lit("1").alias("location"), F.lit("2001-01-01").cast("date").alias("date"),
        F.lit("0").alias(N.LOCATION_GROUP), F.lit("2001-01-01").alias(N.LOAD_DATE),
    )
    for name in ("features", "targets"):
        rows.write.partitionBy(N.LOCATION_GROUP).parquet(f"{tmp_path}/{name}")
    features = spark.read.parquet(f"{tmp_path}/features")
    monkeypatch.setattr(jobs.split, "FEATURE_BOOKKEEPING", [N.LOAD_DATE])
    jobs.split_job(spark, f"{tmp_path}/features", f"{tmp_path}/targets", f"{tmp_path}/out")
    assert features.count() == readers.read_parquet(spark, f"{tmp_path}/out").count() == 30
    assert len(seen) == 1 and seen[0] and all("/joined-" in f for f in seen[0])


def test_counts_are_taken_once(spark, monkeypatch):
    counts = spark.createDataFrame([("1995-01-01", 1), ("1995-06-01", 2), ("1995-07-01", 3)], f"{N.LOAD_DATE} string, n long")
    seen, write = [], writers.write_counts
    monkeypatch.setattr(writers, "write_counts", lambda df, *a: seen.append(df.inputFiles()) or write(df, *a))
    base = catalog._stored_counts(spark, counts, "n")
    assert len(seen) == 3 and all(files and "n-once" in files[0] for files in seen)
    assert sorted(r.n for r in readers.scan_counts(spark, base).collect()) == [1, 2, 3]


def test_a_rerun_writes_from_stored_labels(spark, monkeypatch):
    seen = []
    rows = series(spark).withColumns({c: F.col("id").cast("string") for c in (N.SKU, N.LOCATION, N.LOAD_DATE)})
    rows = rows.withColumn(N.LOCATION_GROUP, (F.col("id") % 4).cast("string")).withColumn(N.DATA_SPLIT, F.lit("train"))
    monkeypatch.setattr(catalog, "_labelled", lambda *_: rows)
    write = writers.write_split_parquet
    monkeypatch.setattr(writers, "write_split_parquet", lambda df, *a, **k: seen.append(df.inputFiles()) or write(df, *a, **k))
    assert catalog.sink_split_rerun(spark, "").count() == 400 + 300
    assert len(seen) == 3 and all(files and "/labelled-" in files[0] for files in seen)


def test_csv_of_many_groups_is_not_sorted_first(spark, monkeypatch, tmp_path):
    key, csv, seen = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.csv, []
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *a: seen.append(int(spark.conf.get(key))) or csv(self, *a))
    before = spark.conf.get(key)
    rows = spark.range(200, numPartitions=2).select(
        F.col("id").cast("string").alias("sku"), (F.col("id") % 40).cast("string").alias(N.LOCATION_GROUP)
    )
    writers.write_step_csv(rows, f"{tmp_path}/out", "step_1", ["sku"])
    assert seen == [writers.OPEN_FILES] and spark.conf.get(key) == before
    back = spark.read.option("header", True).csv(f"{tmp_path}/out/step_1").collect()
    assert len(back) == 200 and all(int(r.sku) % 40 == int(r[N.LOCATION_GROUP]) for r in back)


def test_step_tables_come_from_one_stored_panel(spark, monkeypatch):
    monkeypatch.setattr(catalog, "panel", lambda *_: scored(spark, some_scores(20)))
    frames = catalog._ordered_steps(spark, "")
    assert len(frames) == 4 and len({f for df in frames for f in df.inputFiles()} ) > 0
    assert all("/panel-" in f for df in frames for f in df.inputFiles()) and {df.count() for df in frames} == {20}
