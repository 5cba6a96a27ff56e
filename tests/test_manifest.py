"""Content manifests and the permits refresh that rests on them."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lavra.operators.manifest import file_manifest, manifest_diff
from lavra.plans import permits_ingest as job

GRID = job.GRID_SCHEMA


def land(spark, root, year, n, note=""):
    rows = [(str(year), "Dados", 0, 0, ["Mês", "Alvará", "Processo"])] + [
        (str(year), "Dados", 0, i + 1, [str(i % 12 + 1), f"A{i}{note}", f"P{i}"]) for i in range(n)]
    spark.createDataFrame(rows, GRID).coalesce(1).write.mode("overwrite").parquet(f"{root}/ano={year}")


def statuses(report):
    return {r.key: (r.status, r.reason) for r in report.collect()}


def test_manifest_hashes_only_what_looks_changed(spark, tmp):
    for name, text in (("a", "x"), ("b", "y"), ("c", "z")):
        with open(f"{tmp}/{name}.txt", "w") as f:
            f.write(text)
    key = F.regexp_extract("file", r"/(\w)\.txt$", 1)
    first = spark.createDataFrame(file_manifest(spark, tmp, key, "*.txt").collect(), "key string, file string, length long, modified timestamp, sha256 string")
    assert {r.key: r.status for r in manifest_diff(first, first).collect()} == dict.fromkeys("abc", "same")
    time.sleep(0.01)
    with open(f"{tmp}/b.txt", "w") as f:
        f.write("other")
    os.utime(f"{tmp}/c.txt")  # touched, but the same content
    os.remove(f"{tmp}/a.txt")
    with open(f"{tmp}/d.txt", "w") as f:
        f.write("x")
    marked = first.withColumn("sha256", F.concat(F.lit("held-"), "sha256"))
    now = file_manifest(spark, tmp, key, "*.txt", known=first)
    assert {r.key: r.status for r in manifest_diff(first, now).collect()} == {"a": "missing", "b": "changed", "c": "same", "d": "new"}
    again = spark.createDataFrame(now.collect(), now.schema).withColumn("sha256", F.concat(F.lit("held-"), "sha256"))
    assert all(r.sha256.startswith("held-") for r in file_manifest(spark, tmp, key, "*.txt", known=again).collect())
    assert marked.count() == 3 and file_manifest(spark, f"{tmp}/none", key).count() == 0


def test_permits_reload_only_what_has_to_be(spark, tmp):
    landing, lake, years = f"{tmp}/landing", f"{tmp}/lake", [2021, 2022, 2023, 2024]
    for y in (2021, 2022, 2023):
        land(spark, landing, y, 5)
    got = statuses(job.ingest(spark, landing, lake, years, as_of=2023))
    assert got == {"2021": ("new", "not committed"), "2022": ("new", "not committed"), "2023": ("new", "not committed"),
                   "2024": ("not landed", None)}
    assert job.write_silver(spark, lake, "2024-01-01").count() == 15
    stamps = {y: os.path.getmtime(f"{lake}/bronze/ano={y}/_SUCCESS") for y in (2021, 2022, 2023)}
    land(spark, landing, 2022, 7, "b")
    land(spark, landing, 2021, 5)  # written anew, with the same rows
    got = statuses(job.ingest(spark, landing, lake, years, as_of=2023))
    assert got["2022"] == ("changed", "changed") and got["2023"] == ("same", "current year") and got["2021"][1] in (None, "changed")
    assert os.path.getmtime(f"{lake}/bronze/ano=2022/_SUCCESS") > stamps[2022]
    assert job.write_silver(spark, lake, "2024-01-02").count() == 17
    from lavra.sources.files import delete_path
    delete_path(spark, f"{lake}/bronze/ano=2021")
    delete_path(spark, f"{landing}/ano=2022")
    got = statuses(job.ingest(spark, landing, lake, years, as_of=2030))
    assert got["2021"] == ("same", "bronze gone") and got["2022"] == ("missing", None) and got["2023"] == ("same", None)
    assert job.write_silver(spark, lake, "2024-01-03").count() == 17  # bronze of a year that is no longer landed stays


def test_a_bad_year_is_reported_and_stays_pending(spark, tmp):
    landing, lake = f"{tmp}/landing", f"{tmp}/lake"
    land(spark, landing, 2021, 3)
    os.makedirs(f"{landing}/ano=2022")
    with open(f"{landing}/ano=2022/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    report = {r.key: r for r in job.ingest(spark, landing, lake, [2021, 2022], as_of=2030).collect()}
    assert report["2021"].error is None and report["2022"].error
    assert statuses(job.ingest(spark, landing, lake, [2021], as_of=2030))["2021"] == ("same", None)
    with pytest.raises(RuntimeError, match="no year readable"):
        job.ingest(spark, landing, lake, [2021, 2022], as_of=2030)
