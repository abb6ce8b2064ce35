import random

import pytest
from pyspark.sql import functions as F

from brightloom.operators import reports
from brightloom.plans.enrich import Steps
from brightloom.sources import generators, readers, sinks
from brightloom.staging import stage
from brightloom.streaming import events as ev


def test_csv_folder_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2\n2,3\n")
    (tmp_path / "b.csv").write_text("id,v\n3,4.5\n")
    (tmp_path / "c.csv").write_text("id,w\nx,9\n")
    got = readers.read_csv_dir(spark, str(tmp_path))
    assert {"id", "v", "w", "source_file", "extraction_timestamp"} == set(got.columns)
    assert sorted((r["id"], r["v"], r["w"], r["source_file"]) for r in got.collect()) == [
        ("1", 2.0, None, "a.csv"), ("2", 3.0, None, "a.csv"), ("3", 4.5, None, "b.csv"), ("x", None, 9, "c.csv")]


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        readers.read_csv_dir(spark, str(tmp_path))


def test_blob_formats(spark, tmp_path):
    spark.range(3).write.json(str(tmp_path / "j"))
    assert readers.read_blob(spark, str(tmp_path / "j"), "JSON").count() == 3
    with pytest.raises(ValueError):
        readers.read_blob(spark, str(tmp_path / "j"), "xlsx")


def test_table_or_query(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert readers.read_table(spark, "five").count() == 5
    assert readers.read_table(spark, query="SELECT * FROM five WHERE id > 2").count() == 2
    with pytest.raises(ValueError):
        readers.read_table(spark)


def test_push_batches_and_delivery(spark, tmp_path):
    df = spark.range(25).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    batches = sinks.push_batches(df, ["id"], 10)
    assert sorted(batches.groupBy("batch_id").count().collect()) == [(0, 10), (1, 10), (2, 5)]
    assert batches.filter("row_number = 1").first()["payload"] == '{"id":1,"v":null}'
    out = tmp_path / "sent"
    out.mkdir()
    where = str(out)

    def send(batch, rows):
        with open(f"{where}/{batch}", "w") as f:
            f.write("\n".join(rows))

    sinks.deliver(batches, send)
    assert sorted(p.name for p in out.iterdir()) == ["0", "1", "2"]
    assert len((out / "2").read_text().split("\n")) == 5


def test_parquet_partitions(spark, tmp_path):
    sinks.write_parquet(spark.range(4).withColumn("p", F.col("id") % 2), str(tmp_path / "t"), ["p"])
    assert (tmp_path / "t" / "p=0").exists()


def write_events(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{folder}/{name}")


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    folder = str(tmp_path / "e")
    write_events(spark, folder, "d=1", [(1, "2024-01-01 10:01:00", 1, "view", 1.0), (2, "2024-01-01 10:40:00", 1, "view", 1.0)])
    write_events(spark, folder, "d=2", [(4, "2024-01-01 11:40:00", 1, "view", 1.0)])
    write_events(spark, folder, "d=3", [(3, "2024-01-01 10:02:00", 1, "view", 1.0)])
    stream = ev.event_stream(spark, folder, "*.parquet", files_per_batch=1)
    got = ev.run_to_files(ev.tumbling(stream), "late").orderBy("window_start").collect()
    # 10:02 arrives after the watermark passed 10:15; the 11:30 window is still open
    assert [(str(r["window_start"])[11:16], r["n_events"]) for r in got] == [("10:00", 1), ("10:30", 1)]


def test_repeated_events_pass_once(spark, tmp_path):
    folder = str(tmp_path / "e")
    rows = [(i, f"2024-01-01 10:{i:02d}:00", 1, "view", 1.0) for i in range(20)]
    write_events(spark, folder, "d=1", rows)
    write_events(spark, folder, "d=2", rows[12:] + [(99, "2024-01-01 10:30:00", 1, "view", 1.0)])
    stream = ev.event_stream(spark, folder, "*.parquet", files_per_batch=1)
    got = [r["event_id"] for r in ev.run_to_files(ev.dedup(stream), "dedup").collect()]
    assert sorted(got) == [*range(20), 99]


def test_quality_per_batch(spark, tmp_path):
    folder = str(tmp_path / "e")
    write_events(spark, folder, "d=1", [(1, "2024-01-01 10:01:00", None, "view", 1.0)])
    write_events(spark, folder, "d=2", [(2, "2024-01-01 11:01:00", 1, "view", 1.0)])
    got = ev.run_quality(ev.event_stream(spark, folder, "*.parquet", files_per_batch=1)).orderBy("batch_id").collect()
    assert [r["rows"] for r in got] == [1, 1] and sum(r["null_cells"] for r in got) == 1


def test_publish_report_without_dashboards(spark):
    df = spark.createDataFrame([("a", 3, "boom")], "platform string, dashboards long, error string")
    row = reports.publish_report(df).first()
    assert (row["platforms_used"], row["dashboards_created"], row["productivity_improvement"]) == (0, 0, "0%")


def test_transform_report_without_time(spark):
    df = spark.createDataFrame([("x", 5, 5, 0.0, 2, 0.1)], "operation string, input_records long, output_records long, seconds double, features_created long, improvement double")
    assert reports.transform_report(df).first()["average_processing_speed"] == 0.0


def test_step_chain(spark):
    chain = Steps().add("double", lambda df: df.withColumn("id", F.col("id") * 2)).add("limit", lambda df, top: df.filter(F.col("id") < top), top=6)
    assert [r[0] for r in chain.run(spark.range(10)).collect()] == [0, 2, 4]


@pytest.mark.parametrize("n", [1, 40, 700, 5000])
def test_head_is_cut_by_counting(spark, n):
    rng = random.Random(n)
    rows = [(None if rng.random() < 0.1 else rng.randint(0, 3), rng.choice([None, "a", "b", "ä"]), i) for i in range(3000)]
    df = stage(spark.createDataFrame(rows, "a int, b string, c long").repartition(5), "head")
    order = sorted(rows, key=lambda r: [(v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0) for v in r])
    cut = sinks.counted_head(df, ["a", "b", "c"], n)
    assert min(n, 3000) <= cut.count() <= max(2 * n, 1)
    assert [tuple(r) for r in sinks.extract_head(df, ["a", "b", "c"], n).collect()] == order[:n]


def test_few_ids_make_series_in_many_tasks(spark):
    made = generators.synthetic_series(spark.range(20).coalesce(1), "id")
    assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and made.count() == 20 * 1461
