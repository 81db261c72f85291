"""Load dates arriving one after the other are each predicted once, exactly as in batch."""

from pyspark.sql import functions as F
from test_jobs import MODELS, featured

from shelfspark import names as N
from shelfspark.operators import cascade, scorers
from shelfspark.streaming import daily


def test_incremental_load_dates(spark, tmp_path):
    base, out, seen = (str(tmp_path / d) for d in ("day", "out", "seen"))
    df = featured(spark, 40)
    columns = [*N.KEYS, N.OOS, N.ORIG_PRED_LOW]

    def arrive(load_date):
        df.withColumn("load_date", F.lit(load_date)).write.mode("append").partitionBy("location_group", "load_date").parquet(base)

    def run():
        schema = df.withColumn("load_date", F.lit("")).schema
        stream = daily.predict_stream(daily.stream_features(spark, base, schema), MODELS, 0.4, 0.4, columns)
        query = daily.write_predictions(stream, out, seen)
        query.awaitTermination(120)
        return spark.read.schema(stream.schema).parquet(out)

    arrive("2020-01-01")
    assert run().count() == 40
    arrive("2020-01-02")
    got = run()
    assert got.count() == 80
    assert run().count() == 80
    want = cascade.cascade_predict(scorers.score_cascade(df, MODELS)).select(*columns, "location_group")
    second = got.where("load_date = '2020-01-02'").drop("load_date")
    assert second.exceptAll(want).count() == 0 and want.exceptAll(second).count() == 0
