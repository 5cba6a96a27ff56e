"""Silver tables replaced whole or not at all, and the versioned ledger."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lavra.operators import commit_keys, read_ledger, reset_ledger
from lavra.operators import ledger as ledger_module
from lavra.operators.ledger import KeyConflict
from lavra.plans import procurement
from lavra.sources.snapshots import VersionConflict, Versions, publish, read_snapshot


def keys_of(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def test_a_write_that_fails_halfway_leaves_the_earlier_version(spark, tmp):
    root = f"{tmp}/silver"
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    assert publish(spark.range(10), root) == 1
    held = read_snapshot(spark, root)
    broken = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="bad row"):
        publish(broken, root)
    assert read_snapshot(spark, root).count() == 10 and Versions(spark, root).numbers() == [1]
    assert publish(spark.range(20).withColumn("p", F.col("id") % 2), root, partition_by=["p"]) == 2
    assert held.count() == 10  # a reader that began before goes on with what it had
    assert read_snapshot(spark, root).count() == 20 and read_snapshot(spark, root, version=1).count() == 10
    left = [f for f in os.listdir(root) if f.startswith("data-")]
    gone = Versions(spark, root).drop_unused(keep=1, older_than_s=0)
    assert len(gone) == len(left) - 1 and read_snapshot(spark, root).count() == 20
    assert Versions(spark, root).drop_unused(keep=1) == []


def test_two_writers_of_one_version(spark, tmp):
    versions = Versions(spark, f"{tmp}/t")
    assert versions.current() == (0, {}) and versions.commit(0, {"folders": []}) == 1
    with pytest.raises(VersionConflict):
        versions.commit(0, {"folders": ["data-x"]})
    assert versions.current() == (1, {"folders": []})
    assert not [f for f in os.listdir(f"{tmp}/t/_versions") if f.startswith(".") and not f.endswith(".crc")]


def test_ledger_stays_a_bounded_number_of_files(spark, tmp, monkeypatch):
    monkeypatch.setattr(ledger_module, "MERGE_AFTER", 4)
    path = f"{tmp}/ledger"
    for i in range(14):
        assert commit_keys(keys_of(spark, f"k{i % 9}", f"only{i}"), path, "p") == i + 1
        assert len(Versions(spark, path).current()[1]["folders"]) <= 4
    got = [r.key for r in read_ledger(spark, path, "p").collect()]
    assert sorted(got) == sorted({f"k{i % 9}" for i in range(14)} | {f"only{i}" for i in range(14)})
    assert read_ledger(spark, path, "q").count() == 0


def test_reset_goes_by_version_not_by_clock(spark, tmp, monkeypatch):
    path = f"{tmp}/ledger"
    commit_keys(keys_of(spark, "a", "b"), path, "p")
    commit_keys(keys_of(spark, "a"), path, "other")
    reset_ledger(spark, path, "p")
    monkeypatch.setattr(ledger_module.F, "current_timestamp", lambda: F.lit("1990-01-01").cast("timestamp"))  # a clock that is behind
    commit_keys(keys_of(spark, "c"), path, "p")
    assert [r.key for r in read_ledger(spark, path, "p").collect()] == ["c"]
    assert [r.key for r in read_ledger(spark, path, "other").collect()] == ["a"]
    monkeypatch.setattr(ledger_module, "MERGE_AFTER", 1)
    commit_keys(keys_of(spark, "d"), path, "p")  # merged: what the reset hides is gone
    assert sorted(r.key for r in read_ledger(spark, path, "p").collect()) == ["c", "d"]


def test_two_writers_cannot_commit_one_key(spark, tmp):
    path, done, failed = f"{tmp}/ledger", [], []

    def write(i):
        try:
            done.append(commit_keys(keys_of(spark, "same", f"own{i}"), path, "p", once=True))
        except KeyConflict:
            failed.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(done) == 1 and len(failed) == 3 and read_ledger(spark, path, "p").count() == 2
    plain = [threading.Thread(target=commit_keys, args=(keys_of(spark, f"n{i}"), path, "p")) for i in range(4)]
    for t in plain:
        t.start()
    for t in plain:
        t.join()
    assert read_ledger(spark, path, "p").count() == 6 and Versions(spark, path).numbers() == list(range(1, 6))


def test_procurement_silver_is_a_version(spark, tmp):
    assert procurement.write_silver(spark, f"{tmp}/lake").count() == 0
    procurement.write_silver(spark, f"{tmp}/lake")
    assert Versions(spark, f"{tmp}/lake/silver").numbers() == [1, 2]
