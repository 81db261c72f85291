"""What the physical plans must and must not contain."""

import re

import pytest
from frames import SCORED, scored
from pyspark.sql import functions as F
from test_cascade import some_scores, stored

from shelfspark import names as N
from shelfspark.operators import cascade, confidence, metrics, split, tuning
from shelfspark.sources import readers, writers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "scored")
    df = scored(spark, some_scores()).withColumn("load_date", F.lit("2020-02-01"))
    df.write.partitionBy("location_group", "load_date").parquet(path)
    return path


def test_cascade_is_one_narrow_stage(spark, table):
    text = plan(cascade.cascade_predict(spark.read.parquet(table)))
    assert "Exchange" not in text and "Python" not in text and "Union" not in text


def test_scan_prunes_partitions_and_columns(spark, table):
    rows = readers.scan_inference_features(spark, table, "2020-02-01", ["01"])
    text = plan(rows.select("sku", N.BINARY_PRED))
    assert re.search(r"PartitionFilters: \[[^\]]*location_group[^\]]*load_date", text)
    assert re.search(r"ReadSchema: struct<sku:string,binary_pred:double>", text)


def test_date_filter_reaches_the_scan(spark, table):
    text = plan(split.filter_train_start(readers.scan_feature_store(spark, table), "2020-01-10").select("sku"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(date,2020-01-10\)", text)


@pytest.mark.parametrize("fn", [metrics.overall_metrics, lambda d: confidence.confidence_metrics(d, 0.4, 0.4)])
def test_a_document_is_one_aggregation(spark, table, fn):
    text = plan(fn(cascade.cascade_predict(spark.read.parquet(table))))
    initial = text.split("Initial Plan")[-1]
    assert len(re.findall(r"Exchange", initial)) == 1 and "Exchange SinglePartition" in initial


def test_grid_has_no_cross_join(spark):
    df = scored(spark, some_scores(20))
    text = plan(tuning.grid_counts(*stored(df), "0.1,0.5", "0.2,0.6"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_rebuild_shuffles_each_step_once(spark, tmp_path):
    frames = dict(zip(N.STEPS, stored(scored(spark, some_scores(20)))))
    for s, f in frames.items():
        f.write.parquet(str(tmp_path / s))
    steps = [spark.read.parquet(str(tmp_path / s)) for s in N.STEPS]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(cascade.cascade_from_predictions(*steps, 0.4, 0.4))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning(sku") == 3


def test_small_groups_are_one_file_each(spark, tmp_path):
    df = scored(spark, some_scores(60)).withColumn("location_group", F.concat(F.lit("0"), (F.col("sku") % 3).cast("int")))
    out = str(tmp_path / "csv")
    writers.write_group_csv(df.repartition(8), out, N.KEYS)
    files = list((tmp_path / "csv").glob("location_group=*/*.csv"))
    assert len(files) == 3
    back = readers.read_csv(spark, out, readers.schemas.table(N.KEYS), out)
    assert back.count() == 60 and {r[0] for r in back.select("location_group").distinct().collect()} == {"00", "01", "02"}
    assert back.where("sku = '0007'").count() == 1


def test_schema_string_is_current():
    assert "binary_pred" in SCORED


def test_control_table_prunes_partitions(spark, table, tmp_path):
    group = readers.read_parquet(spark, table).first().location_group
    spark.createDataFrame([(group, "on"), ("none", "off")], "location_group string, state string").write.parquet(str(tmp_path / "c"))
    control = spark.read.parquet(str(tmp_path / "c")).where("state = 'on'")
    rows = readers.scan_by_control(readers.read_parquet(spark, table), control)
    assert "dynamicpruning" in plan(rows) and "state" not in rows.columns
    every = readers.read_parquet(spark, table)
    assert rows.count() == every.where(F.col("location_group") == group).count() > 0
    twice = control.unionByName(control)
    assert readers.scan_by_control(every, twice).count() == rows.count()
    with pytest.raises(ValueError, match="control table"):
        readers.scan_by_control(every, control.select("state"))
