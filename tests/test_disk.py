"""What the jobs leave on disk, and what they move and store on the way."""

from pathlib import Path

import pytest
from frames import scored
from pyspark.sql import functions as F
from test_cascade import some_scores

from shelfspark import names as N
from shelfspark.operators import cascade, scorers
from shelfspark.plans import catalog, jobs
from shelfspark.sources import readers, writers
from shelfspark.sources.scratch import drops_shuffles

MODELS = {f"step_{i}": scorers.LinearScorer({f"f{i}": 1.0}) for i in range(1, 5)}


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def files(path) -> set[str]:
    """Endings of the data files below a folder."""
    return {"".join(f.suffixes[-2:]) for f in Path(path).rglob("part-*")}


def rows_of(df) -> list[str]:
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def weights(tmp_path):
    (tmp_path / "weights.json").write_text('{"metrics_list": [{"metric_name": "Accuracy", "metric_weight": 1}]}')
    return f"{tmp_path}/weights.json"


@pytest.fixture
def steps(spark, tmp_path, monkeypatch):
    """Step sets of 40 rows, five of them twice."""
    rows = scored(spark, some_scores(40))
    monkeypatch.setattr(catalog, "panel", lambda *_: rows.unionAll(rows.limit(5)).repartition(3))
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: f"{tmp_path}/built/{name}")
    return catalog._stored_steps(spark, "")


def test_step_sets_are_packed_and_their_source_is_dropped(spark, steps):
    for step in N.STEPS:
        assert files(f"{steps}/{step}") == {".csv.gz"}
        assert readers.scan_step_predictions(spark, steps, step).count() == 45
    assert [p.name for p in Path(steps).parent.iterdir() if p.name.startswith("panel")] == []


def test_tuning_and_scoring_leave_no_shuffle_files(spark, steps, weights, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "scratch_path", lambda _, name: f"{tmp_path}/scratch-{name}")
    before = shuffle_files(spark)
    best = jobs.tune_job(spark, steps, f"{tmp_path}/tuned", "0.2,0.5", "0.2,0.5", weights).first()
    jobs.score_job(spark, steps, f"{tmp_path}/score", best.oos_threshold, best.hl_threshold, new_models=True)
    assert shuffle_files(spark) <= before
    assert files(f"{steps}/final_prediction") == {".csv.gz"}
    assert not [*tmp_path.glob("scratch-*")]


def test_scoring_stores_only_what_it_reads_again(spark, steps, weights, tmp_path, monkeypatch):
    jobs.tune_job(spark, steps, f"{tmp_path}/tuned", "0.2,0.5", "0.2,0.5", weights)
    monkeypatch.setattr(jobs, "scratch_path", lambda _, name: f"{tmp_path}/scratch")
    monkeypatch.setattr(jobs, "delete_path", lambda *_: None)
    jobs.score_job(spark, steps, f"{tmp_path}/score", 0.4, 0.4, new_models=True)
    assert sorted(p.name for p in Path(f"{tmp_path}/scratch/parsed").iterdir()) == ["step_1"]
    assert files(f"{tmp_path}/scratch") == {".zstd.parquet"}


def test_daily_sets_are_packed_and_predictions_plain(spark, tmp_path, monkeypatch):
    named = dict(zip((N.BINARY_PRED, N.HL_ORIG_PRED, N.LS_RATIO, N.HS_PRED), ("f1", "f2", "f3", "f4")))
    day = scored(spark, some_scores(60)).withColumnsRenamed(named).withColumns({"location_group": F.lit("01"), "load_date": F.lit("d")})
    day.write.partitionBy("location_group", "load_date").parquet(f"{tmp_path}/day")
    predicted = cascade.cascade_predict(scorers.score_cascade(day, MODELS, 0.4, 0.4), 0.4, 0.4)
    monkeypatch.setattr(jobs.readers, "scan_confidence_document", lambda *_: catalog.confidence.confidence_metrics(predicted, 0.4, 0.4))
    before = shuffle_files(spark)
    jobs.infer_job(spark, f"{tmp_path}/day", f"{tmp_path}/out", "d", MODELS, "", 0.4, 0.4)
    assert shuffle_files(spark) <= before
    for name in ("OOS", "concatenated", *N.DAILY_STEP_COLUMNS):
        assert files(f"{tmp_path}/out/temp/{name}") == {".csv.gz"}
    assert all(f.endswith(".csv") for f in files(f"{tmp_path}/out/prediction"))
    daily = [readers.read_csv(spark, f"{tmp_path}/out/{x}", readers.schemas.DAILY, f"{tmp_path}/out/{x}") for x in ("temp/OOS", "prediction")]
    assert rows_of(daily[0]) == rows_of(daily[1]) and daily[0].count() == predicted.count() > 0
    full = readers.scan_concatenated_predictions(spark, f"{tmp_path}/out")
    keys = [*N.KEYS, N.ORIG_PRED, N.ORIG_PRED_LOW, N.OOS]
    assert rows_of(full.select(keys)) == rows_of(predicted.select(keys))


def test_the_setting_is_as_before_a_job(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen = []

    @drops_shuffles
    def job(spark, fail):
        seen.append(spark.conf.get(key))
        if fail:
            raise ValueError

    before = spark.conf.get(key, None)
    job(spark, False)
    with pytest.raises(ValueError):
        job(spark, True)
    assert seen == ["true", "true"] and spark.conf.get(key, None) == before


def test_packed_rows_come_back(spark, tmp_path):
    rows = scored(spark, some_scores(30)).withColumn(N.LOCATION_GROUP, F.lit("01"))
    for packed in (False, True):
        writers.write_step_csv(rows, f"{tmp_path}/{packed}", "step_1", N.STEP_COLUMNS["step_1"], packed=packed)
    plain, back = (readers.scan_step_predictions(spark, f"{tmp_path}/{p}", "step_1") for p in (False, True))
    assert rows_of(plain) == rows_of(back) and back.count() == 30


def test_the_panel_of_the_step_sets_is_stored_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "panel", lambda *_: scored(spark, some_scores(20)))
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    assert {df.count() for df in catalog._ordered_steps(spark, "")} == {20}
    assert files(f"{tmp_path}/panel") == {".zstd.parquet"}
