"""Resumable page loads and ordered keep-first, batch by batch."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest

from lavra.operators import keep_first
from lavra.plans import mining_ingest as job
from lavra.streaming import stream_keep_first
from lavra.streaming.ordered import ROW_JSON
from lavra.streaming.pages import PageReader, contiguous_end


def land(folder, start, end, text=None):
    os.makedirs(folder, exist_ok=True)
    rows = [{"attributes": {"FID": str(i), "PROCESSO": f"P{i}", "UF": "SP", "SUBS": "AREIA"},
             "geometry": {"rings": [[[1.0 * i, 2.0]]]}} for i in range(start, end)]
    with open(f"{folder}/page_{start}_{end}.json", "w") as f:
        f.write(json.dumps({"features": rows}) if text is None else text)


def test_paged_load_survives_a_kill_between_write_and_commit(spark, tmp):
    at, lake = f"{tmp}/landing/attributes", f"{tmp}/lake"
    for a, b in ((0, 5), (5, 10), (15, 20)):
        land(at, a, b)
    open(f"{at}/page_10.error", "w").close()

    def killed(batch_id):
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        job.ingest_section(spark, f"{tmp}/landing", lake, "attributes", "2024-01-01", after_write=killed)
    assert not os.listdir(f"{lake}/_offsets/attributes/commits") and os.listdir(f"{lake}/bronze/attributes") == ["batch_id=0"]
    land(at, 20, 25)  # lies behind the gap
    assert job.ingest_section(spark, f"{tmp}/landing", lake, "attributes", "2024-01-02") == 10
    land(at, 10, 15)
    assert job.ingest_section(spark, f"{tmp}/landing", lake, "attributes", "2024-01-03") == 25
    fids = [r.fid for r in job.read_bronze(spark, lake, "attributes").select("fid").collect()]
    assert sorted(fids) == list(range(25))  # no gap, no page twice
    batches = sorted(os.listdir(f"{lake}/bronze/attributes"))
    assert job.ingest_section(spark, f"{tmp}/landing", lake, "attributes", "2024-01-04") == 25
    assert sorted(os.listdir(f"{lake}/bronze/attributes")) == batches  # nothing new, no batch
    land(f"{tmp}/landing/geometry", 0, 20)
    assert job.ingest(spark, f"{tmp}/landing", lake, "2024-01-05") == {"attributes": 25, "geometry": 20}
    silver = job.silver(spark, lake)
    assert silver.count() == 25 and silver.filter("lat is not null").count() == 20
    assert job.ingest_section(spark, f"{tmp}/landing", lake, "geometry", "2024-02-01", mode="overwrite") == 20
    assert {r[0] for r in job.read_bronze(spark, lake, "geometry").select("dt_ingestao").collect()} == {"2024-02-01"}


def test_a_page_that_is_not_one_stops_the_load(spark, tmp):
    at, lake = f"{tmp}/landing/attributes", f"{tmp}/lake"
    land(at, 0, 2)
    land(at, 2, 4, text="<html>gateway timeout</html>")
    with pytest.raises(Exception, match="not a feature page"):
        job.ingest_section(spark, f"{tmp}/landing", lake, "attributes", "2024-01-01")
    assert job.watermark(spark, lake, "attributes") == 0
    land(at, 2, 4)
    assert job.ingest_section(spark, f"{tmp}/landing", lake, "attributes", "2024-01-01") == 4


def test_offsets(tmp):
    assert contiguous_end({0: (5, "a"), 5: (9, "b"), 10: (12, "c")}) == 9 and contiguous_end({}) == 0
    assert contiguous_end({0: (0, "empty")}) == 0
    reader = PageReader({"path": f"{tmp}/none"})
    assert reader.latestOffset() == reader.initialOffset() == {"offset": 0}
    land(f"{tmp}/s", 0, 4)
    land(f"{tmp}/s", 4, 6)
    with open(f"{tmp}/s/total.json", "w") as f:
        f.write('{"count": 6}')
    reader = PageReader({"path": f"{tmp}/s", "taskpages": "1"})
    assert reader.latestOffset() == {"offset": 6}
    land(f"{tmp}/s", 6, 9)
    assert reader.latestOffset() == {"offset": 6}  # all that the source has is in: the folder isn't listed
    assert [p.pages[0][:2] for p in reader.partitions({"offset": 0}, {"offset": 6})] == [(0, 4), (4, 6)]
    with pytest.raises(FileNotFoundError):
        reader.partitions({"offset": 0}, {"offset": 20})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stream_keep_first_equals_the_batch_in_any_order(spark, tmp):
    rng = random.Random(1)
    schema = "k long, n double, t string, ts timestamp, more int"
    rows = [(rng.choice([None, *range(20)]), rng.choice([None, float("nan"), *map(float, range(30))]), rng.choice([None, "a", "B", "é"]),
             datetime(2024, 1, 1, rng.randrange(24), 0, 0, rng.randrange(10**6)), i) for i in range(400)]
    order = ["n", "t", "ts", "more"]
    first, second = (spark.createDataFrame(x, schema) for x in (rows[:250], rows[250:]))
    first.repartition(3).write.options(**ROW_JSON).json(f"{tmp}/src")
    got = stream_keep_first(spark, f"{tmp}/src", schema, ["k"], order, f"{tmp}/lake", max_files_per_trigger=1)
    assert rows_of(got) == rows_of(keep_first(first, ["k"], order))
    second.repartition(2).write.mode("append").options(**ROW_JSON).json(f"{tmp}/src")
    got = stream_keep_first(spark, f"{tmp}/src", schema, ["k"], order, f"{tmp}/lake")
    assert rows_of(got) == rows_of(keep_first(first.unionByName(second), ["k"], order))
    updates = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/lake/updates")
    assert 21 < updates.count() < 250
    again = stream_keep_first(spark, f"{tmp}/src", schema, ["k"], order, f"{tmp}/lake")
    assert rows_of(again) == rows_of(got) and spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
    with pytest.raises(TypeError):
        stream_keep_first(spark, f"{tmp}/src", "k long, a array<int>", ["k"], ["a"], f"{tmp}/lake2")


def test_state_expires_behind_the_watermark(spark, tmp):
    schema = "k string, n long, at timestamp"
    day = datetime(2024, 1, 1)

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp}/src")
        return stream_keep_first(spark, f"{tmp}/src", schema, ["k"], ["n"], f"{tmp}/lake", event_time="at", delay="1 hour")

    def updates():
        return sorted((r.k, r.n) for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/lake/updates").collect())

    put([("a", 5, day), ("b", 7, day)])
    put([("a", 6, day + timedelta(minutes=5)), ("b", 3, day + timedelta(minutes=5))])
    assert updates() == [("a", 5), ("b", 3), ("b", 7)]  # a's second row comes later in the order
    put([("c", 1, day + timedelta(days=2))])
    put([("c", 2, day + timedelta(days=2))])
    put([("a", 9, day + timedelta(days=3))])  # a's state is gone
    assert ("a", 9) in updates()


def test_keep_first_in_a_session_with_another_state_store(spark, tmp):
    key = "spark.sql.streaming.stateStore.providerClass"
    before, other = spark.conf.get(key), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, n long")
    rows.write.json(f"{tmp}/src")
    spark.conf.set(key, other)
    try:
        got = stream_keep_first(spark, f"{tmp}/src", "k string, n long", ["k"], ["n"], f"{tmp}/lake")
        assert rows_of(got) == [("a", 1), ("b", 3)] and spark.conf.get(key) == other
    finally:
        spark.conf.set(key, before)
