import os

from pyspark.sql import functions as F

from flowscope.sources import results as store


def _rows(spark):
    return spark.createDataFrame(
        [("2024-01-01 01:00:00", "func1", "DNS", 0.4), ("2024-01-01 01:15:00", "func2", "SSH", 3.0),
         ("2024-01-01 01:15:00", "func5", "10.0.0.1", 7.0)],
        "t string, func string, key string, value double").select(
        F.col("t").cast("timestamp_ntz").alias("time"), "func", "key", "value")


def test_store_insert_read_latest_delete(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    store.insert(_rows(spark), path, batch_id=0)
    store.insert(_rows(spark).limit(1), path, batch_id=1)
    assert store.read_all(spark, path).count() == 4
    store.insert(_rows(spark).limit(1), path, batch_id=1)  # replay of batch 1 replaces it
    assert store.read_all(spark, path).count() == 4
    latest = store.read_latest(spark, path).collect()
    assert sorted(r.key for r in latest) == ["10.0.0.1", "SSH"]
    store.delete_all(spark, path)
    assert store.read_all(spark, path).count() == 0


def test_json_roundtrip(spark):
    df = _rows(spark)
    back = store.from_json_lines(store.to_json_lines(df))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_csv_sink_headerless(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    store.write_csv(spark.createDataFrame([("1.2.3.4", 5)], "ip string, bytes long"), path)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.startswith("part-"))
    assert text.strip() == "1.2.3.4,5"


def test_json_sink_and_text_stream_sink(spark, tmp_dir):
    from flowscope.sources.flows import read_flow_text
    from flowscope.streaming.runner import run_append
    p = os.path.join(tmp_dir, "json")
    store.write_json(_rows(spark), p)
    assert spark.read.schema("func string, key string").json(p).count() == 3
    src = os.path.join(tmp_dir, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("x 1\ny 2\n")
    q = run_append(read_flow_text(spark, src, streaming=True), os.path.join(tmp_dir, "txt"),
                   os.path.join(tmp_dir, "ck"), fmt="text")
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "txt")).collect()) == ["x 1", "y 2"]


def test_monitor_stream_to_store(spark, tmp_dir):
    from flowscope.streaming.runner import flows_stream, monitor_to_store
    sf = "/root/testdata/sf0.001"
    path = os.path.join(tmp_dir, "store")
    for key, funcs in (("protocol", ("func1", "func2", "func3")), ("source_ip", ("func4", "func5", "func6"))):
        q = monitor_to_store(spark, flows_stream(spark, sf), key, path, "1 hour", "15 minutes", 0.2, 3, 2.0, funcs)
        q.awaitTermination()
    rows = store.read_all(spark, path)
    assert set(rows.columns) == {"time", "func", "key", "value"}
    assert {r.func for r in rows.select("func").distinct().collect()} == {f"func{i}" for i in range(1, 7)}
    assert store.read_latest(spark, path).count() > 0
    assert store.peek(rows, 5).count() == 5


def test_store_holds_inserts_and_stream_batches(spark, tmp_dir):
    from flowscope.sources import results as store
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS time, 'func1' AS func, 'a' AS key, 1.0D AS value")
    path = f"{tmp_dir}/mixed"
    store.insert(rows, path)
    store.insert(rows, path, 0, "protocol")  # as monitor_to_store does
    store.insert(rows, path)  # a replay replaces its own batch only
    assert store.read_all(spark, path).count() == 2
    store.delete_all(spark, path)
    assert store.read_all(spark, path).count() == 0


def test_readers_see_one_state(spark, tmp_dir):
    """A frame read before an insert, a replay or a delete keeps its rows; no reader sees half a batch."""
    import threading

    path = os.path.join(tmp_dir, "store")
    store.insert(_rows(spark), path, batch_id=0)
    before = store.read_all(spark, path)
    seen, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            seen.append(store.read_all(spark, path).count())

    t = threading.Thread(target=reader)
    t.start()
    try:
        for b in range(1, 5):
            store.insert(_rows(spark), path, batch_id=b)
    finally:
        stop.set()
        t.join()
    assert seen == sorted(seen) and {n % 3 for n in seen} == {0}
    assert store.read_all(spark, path).count() == 15
    store.delete_all(spark, path)
    assert store.read_all(spark, path).count() == 0 and before.count() == 3
    store.insert(_rows(spark).limit(2), path, batch_id=0)
    assert store.read_all(spark, path).count() == 2
    assert store.store_table(spark, path).vacuum() == 5 and store.read_all(spark, path).count() == 2


def test_concurrent_writers_lose_nothing(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    path = os.path.join(tmp_dir, "store")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: store.insert(_rows(spark), path, batch_id=b), range(8)))
    assert store.read_all(spark, path).count() == 24
    versions = sorted(f for f in os.listdir(os.path.join(path, "commits")) if f.endswith(".json"))
    assert versions == [f"{i:020d}.json" for i in range(8)]


def test_latest_reads_only_its_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    for b in range(4):
        store.insert(_rows(spark).withColumn("time", F.expr(f"time + INTERVAL {b % 3} HOUR")), path, batch_id=b)
    latest = store.read_latest(spark, path)
    assert sorted(r.key for r in latest.collect()) == ["10.0.0.1", "SSH"]
    folders = {os.path.dirname(f) for f in latest.inputFiles()}
    assert len(folders) == 1 and len({os.path.dirname(f) for f in store.read_all(spark, path).inputFiles()}) == 4
    store.insert(_rows(spark).limit(0), path, batch_id=2)  # the batch with the latest rows becomes empty
    assert store.read_latest(spark, path).count() == 2
    assert store.read_latest(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_totals_are_folded(spark, tmp_dir):
    from flowscope.streaming.runner import read_totals, run_totals, running_total_stream

    src, sink = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    schema = "protocol string, packet_size int"
    for i in range(7):
        spark.createDataFrame([(f"p{i % 3}", i), ("all", 1)], schema).coalesce(1).write.mode("append").parquet(src)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    totals = running_total_stream(feed, "protocol")
    run_totals(totals, ["protocol"], sink, os.path.join(tmp_dir, "ck"), fold_every=3).awaitTermination()
    got = {r.protocol: (r.bytes, r.n) for r in read_totals(totals, ["protocol"], sink).collect()}
    assert got == {"p0": (9, 3), "p1": (5, 2), "p2": (7, 2), "all": (7, 7)}
    assert len(os.listdir(os.path.join(sink, "commits"))) >= 7
    live = spark.read.json(os.path.join(sink, "commits", "*.json"))
    assert live.where("replace").count() == 2
