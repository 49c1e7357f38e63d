from datetime import datetime

from driftline.streaming import incremental


def test_flows_add_up_over_batches(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(1, 10), (k, 1)], "id long, total_trips long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, total_trips long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = incremental.upsert_flows(stream, str(tmp_path / "state"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, incremental.current(spark, str(tmp_path / "state")).collect())) == [(0, 1), (1, 31), (2, 1)]
    assert incremental.current(spark, str(tmp_path / "none")) is None


def run(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()


def test_first_routes_and_daily_volume(spark, tmp_path):
    rows = [(1, "a", datetime(2023, 6, 1, 5)), (1, "b", datetime(2023, 6, 1, 6)), (2, "c", datetime(2023, 6, 2, 1))]
    spark.createDataFrame(rows, "od_id long, g string, starting_time timestamp_ntz").coalesce(1).write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema("od_id long, g string, starting_time timestamp_ntz").parquet(str(tmp_path / "t"))
    run(incremental.first_routes(stream), "firsts", "append")
    assert sorted(r.od_id for r in spark.table("firsts").collect()) == [1, 2]
    run(incremental.daily_volume(stream), "days", "complete")
    assert sorted((str(r.day), r.trips) for r in spark.table("days").collect()) == [("2023-06-01", 2), ("2023-06-02", 1)]


def test_first_routes_stay_in_a_table(spark, tmp_path):
    for rows in ([(1, "b"), (1, "a")], [(1, "0"), (2, "c")], [(3, "d")], [(2, "z")], [(4, "e")]):
        spark.createDataFrame(rows, "od_id long, g string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("od_id long, g string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = incremental.first_routes_table(stream, str(tmp_path / "state"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, incremental.current(spark, str(tmp_path / "state")).collect())) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    assert len(incremental._epochs(spark, str(tmp_path / "state"))) == incremental.KEPT


def test_a_missing_version_is_an_error(spark, tmp_path):
    import shutil

    import pytest

    def feed(k):
        spark.createDataFrame([(k, 1)], "id long, total_trips long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long, total_trips long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = incremental.upsert_flows(stream, str(tmp_path / "state"), str(tmp_path / "ck"))
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    feed(1)
    shutil.rmtree(tmp_path / "state")
    with pytest.raises(Exception, match="not complete"):
        feed(2)
