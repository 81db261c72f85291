"""Outputs are replaced as whole groups, or not at all."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import scorers
from shelfspark.plans import jobs
from shelfspark.sources import publish, readers, schemas, writers
from test_jobs import DAY, MODELS, featured

SCHEMA = schemas.T.StructType([schemas.T.StructField("sku", schemas.T.StringType()), schemas.T.StructField("x", schemas.T.LongType())])


def rows(spark, *names):
    data = [(n[0], n, i) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "location_group string, sku string, x int")


def back(spark, base, step="step_1"):
    return sorted(r.sku for r in readers.scan_step_predictions(spark, base, step, schema=SCHEMA).collect())


def files(base):
    return sorted(str(p.relative_to(base)) for p in Path(base).rglob("*") if p.is_file())


def test_a_run_on_one_group_keeps_the_others(spark, tmp_path):
    base = str(tmp_path / "out")
    for part, groups in ((rows(spark, "0a"), ["0"]), (rows(spark, "1b", "1c"), ["1"]), (rows(spark, "1b"), ["1"])):
        writers.write_step_csv(part, base, "step_1", ["sku", "x"], groups)
    assert back(spark, base) == ["0a", "1b"] and not list(Path(f"{base}._publish").iterdir())


def test_a_rerun_without_rows_leaves_none_of_the_old(spark, tmp_path):
    base = str(tmp_path / "out")
    writers.write_step_csv(rows(spark, "0a", "1b"), base, "step_1", ["sku", "x"], ["0", "1"])
    writers.write_step_csv(rows(spark, "0c"), base, "step_1", ["sku", "x"], ["0", "1"])
    assert back(spark, base) == ["0c"]
    writers.write_step_csv(rows(spark, "0a", "1b"), base, "step_1", ["sku", "x"])
    writers.write_step_csv(rows(spark, "1b"), base, "step_1", ["sku", "x"])  # a run that stands for all groups
    assert back(spark, base) == ["1b"]
    writers.write_step_csv(rows(spark, "1b").limit(0), base, "step_1", ["sku", "x"])
    assert back(spark, base) == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        back(spark, base, "step_9")


def test_an_output_that_never_had_rows_is_empty(spark, tmp_path):
    base = str(tmp_path / "out")
    writers.write_step_csv(rows(spark, "1b").limit(0), base, "step_1", ["sku", "x"], ["1"])
    assert back(spark, base) == []


def test_rows_of_a_foreign_group_are_an_error(spark, tmp_path):
    base = str(tmp_path / "out")
    writers.write_step_csv(rows(spark, "0a"), base, "step_1", ["sku", "x"])
    with pytest.raises(ValueError, match="location_group=1"):
        writers.write_step_csv(rows(spark, "0b", "1b"), base, "step_1", ["sku", "x"], ["0"])
    assert back(spark, base) == ["0a"] and not list(Path(f"{base}._publish").iterdir())


def test_split_replaces_the_load_date_of_its_groups(spark, tmp_path):
    path = str(tmp_path / "split")
    df = spark.createDataFrame([("1", "train"), ("2", "test")], "sku string, data_split string").withColumn("location_group", F.lit("01"))
    other = df.withColumn("location_group", F.lit("a/b=c"))
    for load in ("2020-01-01", "2020-01-02"):
        writers.write_split_parquet(df.unionByName(other), path, load)
    writers.write_split_parquet(df.where("sku = '1'"), path, "2020-01-02", ["01"])
    writers.write_split_parquet(other.where("sku = '2'"), path, "2020-01-01", ["a/b=c"])
    got = sorted(tuple(r) for r in readers.read_parquet(spark, path).select("location_group", "load_date", "sku").collect())
    assert got == [("01", "2020-01-01", "1"), ("01", "2020-01-01", "2"), ("01", "2020-01-02", "1"),
                   ("a/b=c", "2020-01-01", "2"), ("a/b=c", "2020-01-02", "1"), ("a/b=c", "2020-01-02", "2")]


def test_a_failed_job_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    featured(spark).withColumn("load_date", F.lit(DAY)).write.partitionBy("location_group", "load_date").parquet(f"{base}/day")
    df = featured(spark).withColumn("data_split", F.lit("test"))
    writers.write_split_parquet(df, f"{base}/split")
    jobs.evaluate_production_job(spark, f"{base}/split", f"{base}/out", MODELS, 0.4, 0.4)
    before = {f: (tmp_path / "out" / f).read_bytes() for f in files(f"{base}/out")}

    class Failing(scorers.LinearScorer):
        def add(self, df, out, active=None):
            return df.withColumn(out, F.when(F.col("sku").isNotNull(), F.raise_error(F.lit("broken"))).cast("double"))

    with pytest.raises(Exception, match="broken"):
        jobs.evaluate_new_job(spark, f"{base}/split", f"{base}/out", MODELS | {"step_4": Failing({})})
    assert {f: (tmp_path / "out" / f).read_bytes() for f in files(f"{base}/out")} == before
    assert not list(Path(f"{base}/out._publish").iterdir())


@pytest.mark.parametrize("moves", range(4))
def test_a_broken_swap_is_finished(spark, tmp_path, monkeypatch, moves):
    base = str(tmp_path / "out")
    writers.write_step_csv(rows(spark, "0a", "1b", "2c"), base, "step_1", ["sku", "x"])
    done = []
    move = publish.Files.move

    def failing(self, source, target):
        if "location_group" in target:
            if len(done) == moves:
                raise OSError("lost")
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(publish.Files, "move", failing)
    new = rows(spark, "0x", "1y")
    if moves < 2:
        with pytest.raises(OSError, match="lost"):
            writers.write_step_csv(new, base, "step_1", ["sku", "x"])
    else:
        writers.write_step_csv(new, base, "step_1", ["sku", "x"])
    monkeypatch.setattr(publish.Files, "move", move)
    publish.recover(spark, base)
    assert back(spark, base) == ["0x", "1y"]


def test_an_undecided_run_is_dropped(spark, tmp_path):
    base = str(tmp_path / "out")
    writers.write_step_csv(rows(spark, "0a"), base, "step_1", ["sku", "x"])
    lost = publish.Publication(spark, base)
    writers.stage_step_csv(lost, rows(spark, "0z"), "step_1", ["sku", "x"])
    assert back(spark, base) == ["0a"]
    publish.recover(spark, base)
    assert back(spark, base) == ["0a"] and not list(Path(f"{base}._publish").iterdir())
