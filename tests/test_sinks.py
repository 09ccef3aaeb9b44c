"""Sinks read back, models reload, histories restart."""

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from tapewire.operators import cluster as cl
from tapewire.operators import learn as ln
from tapewire.sources import files as fl
from tapewire.streaming import incremental as inc


def test_json_lines_and_metadata(spark):
    df = spark.createDataFrame([(1, 'say "hi", é'), (2, None)], "id int, t string")
    folder = fl.write_json(df, fl.scratch_folder(spark, "json"), "2024-12-31 00:00:00")
    assert spark.read.schema("id int, t string").json(f"{folder}/articles").orderBy("id").collect() == df.collect()
    assert spark.read.json(f"{folder}/metadata").first().total_articles == 2
    lines = spark.read.text(fl.write_lines(df, fl.scratch_folder(spark, "lines")))
    assert {r.value for r in lines.collect()} == {'{"id":1,"t":"say \\"hi\\", é"}', '{"id":2}'}


def test_keyed_files_by_name(spark):
    folder = fl.scratch_folder(spark, "one")
    spark.createDataFrame([("2024-01-02", 1.5)], "dt string, close double").coalesce(1).write.option("header", True).csv(f"{folder}/ticker=AB")
    row = fl.read_keyed_csv(spark, folder, "dt date, close double").first()
    assert (row.ticker, row.close) == ("AB", 1.5)


def test_model_reloads_and_scores_alike(spark):
    points = [(i, [float(i % 2), float(i)], float(i % 2)) for i in range(40)]
    df = cl.with_features(spark.createDataFrame(points, "id int, v array<double>, label double"), "v")
    model = ln.forest(5, 3).fit(df)
    folder = fl.scratch_folder(spark, "model")
    model.write().overwrite().save(folder)
    again = RandomForestClassificationModel.load(folder)
    scored = lambda m: [r.prediction for r in m.transform(df).orderBy("id").collect()]
    assert scored(model) == scored(again)


def test_history_restarts_from_its_checkpoint(spark):
    folder = fl.scratch_folder(spark, "history")
    step = inc.append_new(["k"], ["pos"])
    for keys in (["a", "b", "a"], ["b", "c"], ["a", "c"]):
        batch = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, pos bigint")
        batch.write.mode("append").parquet(f"{folder}/in")
        inc.run_batches(inc.arrivals(spark, f"{folder}/in", batch.schema), folder, batch.schema, step)
    assert sorted(r.k for r in inc.read_table(spark, folder).select(F.col("k")).collect()) == ["a", "b", "c"]


def test_reports_and_run_record(spark):
    one, two = spark.createDataFrame([("a, b", 1)], "k string, n int"), spark.createDataFrame([], "x double")
    folder = fl.write_reports({"one": one, "two": two}, fl.scratch_folder(spark, "reports"))
    assert fl.read_csv(spark, f"{folder}/one", "k string, n int").collect() == one.collect()
    assert fl.read_csv(spark, f"{folder}/two", "x double").count() == 0
    record = {"settings": {"k": 3}, "score": 0.5}
    back = spark.read.json(fl.write_run_record(spark, fl.scratch_folder(spark, "run"), record)).first().asDict(True)
    assert back == record

