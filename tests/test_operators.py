import os

import pytest
from pyspark.sql import functions as F

from lavra.operators import (apply_header, commit_keys, contiguous_watermark, coverage,
                             grouped_report, header_rows, sheet_headers, keep_first, latest_variant,
                             monthly_windows, null_safe_join, override_merge, pending,
                             pick_sheet, read_ledger, reset_ledger, weekly_windows,
                             window_diagnostics, diagnosis, batch_ids, preview)
from lavra import config


def test_keep_first_nulls_equal_and_plan(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "p"), (None, 3, "q")],
                               "k string, seq int, v string")
    out = keep_first(df, ["k"], ["seq"])
    assert sorted((r.k or "-", r.v) for r in out.collect()) == [("-", "q"), ("a", "y")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_weekly_and_monthly_windows(spark):
    years = spark.createDataFrame([(2024,), (2023,)], "year int")
    w = weekly_windows(years).collect()
    w24 = sorted((r.start, r.end) for r in w if r.year == 2024)
    w23 = sorted((r.start, r.end) for r in w if r.year == 2023)
    assert len(w24) == 53 and w24[-1] == ("20241230", "20241231")
    assert len(w23) == 53 and w23[-1] == ("20231231", "20231231")
    m = {(r.start, r.end) for r in monthly_windows(years).collect()}
    assert ("20240201", "20240229") in m and len(m) == 24


def test_contiguous_watermark(spark):
    pages = spark.createDataFrame(
        [("s", 0, 100, True), ("s", 100, 200, True), ("s", 200, 300, False), ("s", 300, 400, True),
         ("t", 0, 100, False), ("t", 100, 200, True), ("u", 0, 50, True)],
        "section string, start_offset long, end_offset long, ok boolean")
    got = {r.section: r.watermark for r in contiguous_watermark(pages).collect()}
    assert got == {"s": 200, "t": 0, "u": 50}
    batched = {r.section: r.watermark for r in contiguous_watermark(pages, batch_rows=200).collect()}
    assert batched == {"s": 200, "t": 0, "u": 0}


def test_latest_variant_and_override(spark):
    links = spark.createDataFrame([("2026", "a", 2, 0), ("2026", "b", 3, 1), ("2026", "c", 3, 2),
                                   ("2025", "d", 0, 3)], "year string, href string, month int, pos int")
    recent = latest_variant(links, "year", "href", ["month", "pos"])
    assert {r.year: r.href for r in recent.collect()} == {"2026": "c", "2025": "d"}
    fixed = spark.createDataFrame([("2024", "f24"), ("2025", "f25")], "year string, href string")
    merged = {r.year: (r.href, r.origin) for r in override_merge(fixed, recent, "year", "href").collect()}
    assert merged == {"2024": ("f24", "fixed"), "2025": ("d", "recent"), "2026": ("c", "recent")}


def test_null_safe_left_join(spark):
    a = spark.createDataFrame([("p1", 1), (None, 2), ("p3", 3)], "processo string, x int")
    g = spark.createDataFrame([("p1", 1.5), (None, 9.5)], "processo string, lat double")
    got = sorted((r.x, r.lat) for r in null_safe_join(a, g, ["processo"]).collect())
    assert got == [(1, 1.5), (2, 9.5), (3, None)]


def test_grouped_report_null_semantics(spark):
    df = spark.createDataFrame([("a", "1", 0.125), ("a", "2", None), ("b", None, 5.0), ("c", "3", None)],
                               "k string, cnt string, v double")
    out = {r.k: (r.qtd, r.valor) for r in grouped_report(df, ["k"], "cnt", "v").collect()}
    # null key dropped? no: key k is never null here; 'cnt' null is not counted
    assert out == {"a": (2, 0.12), "b": (0, 5.0), "c": (1, 0.0)}
    nk = spark.createDataFrame([(None, "1", 1.0)], "k string, cnt string, v double")
    assert grouped_report(nk, ["k"], "cnt", "v").count() == 0


def test_coverage(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "lat double")
    r = coverage(df, "lat").collect()[0]
    assert (r.total, r.with_value, r.without_value, r.pct_with, r.pct_without) == (3, 2, 1, 66.7, 33.3)
    empty = coverage(spark.createDataFrame([], "lat double"), "lat").collect()[0]
    assert empty.total == 0 and empty.pct_with is None


def test_diagnostics_labels(spark):
    o = spark.createDataFrame([("A", False, 0, 0, 0), ("B", False, 2, 0, 0), ("C", True, 0, 5, 5),
                               ("D", False, 0, 10, 4)],
                              "category string, skipped boolean, n_events int, rows_seen int, rows_kept int")
    d = {r.category: r.diagnosis for r in window_diagnostics(o).withColumn("diagnosis", diagnosis()).collect()}
    assert d["A"].startswith("no rows") and d["B"].startswith("every window failed")
    assert d["C"] == "nothing queried" and d["D"] == "ok"


def test_ledger_roundtrip(spark, tmp):
    path = f"{tmp}/ledger"
    assert read_ledger(spark, path, "p").count() == 0
    commit_keys(spark.createDataFrame([("k1",), ("k2",)], "key string"), path, "p")
    planned = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    assert [r.key for r in pending(planned, read_ledger(spark, path, "p")).collect()] == ["k3"]
    reset_ledger(spark, path, "p")
    assert read_ledger(spark, path, "p").count() == 0
    commit_keys(spark.createDataFrame([("k3",)], "key string"), path, "p")
    assert [r.key for r in read_ledger(spark, path, "p").collect()] == ["k3"]


def test_batch_ids(spark):
    periods = spark.createDataFrame([(f"2024-{m:02d}", m % 4) for m in range(1, 13)], "period string, n int")
    got = [(r.period, r.batch_id) for r in batch_ids(periods, ["period"], 2, F.col("n") > 0).orderBy("period").collect()]
    assert [b for _, b in got] == [0, 0, 1, 1, 2, 2, 3, 3, 4] and got[0][0] == "2024-01"


def test_rows_are_numbered_by_ranges(spark):
    from lavra.operators.ledger import number_rows
    n = 30_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.lit("x").alias("seq_of"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"))
    got = number_rows(rows.repartition(7), ["k"], "no")
    assert got.columns == ["k", "seq_of", "v", "no"] and got.filter("no <> k + 1").count() == 0 and got.count() == n
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert number_rows(rows.limit(0), ["k"]).count() == 0
    back = batch_ids(rows, ["k"], 100, F.col("v").isNotNull())
    assert back.agg(F.countDistinct("batch_id"), F.max("seq")).first()[:] == (240, 24_000)


def test_preview(spark):
    df = spark.range(25).withColumnRenamed("id", "v")
    rows = preview(df, [F.desc("v")], 10).collect()
    assert [r.v for r in rows][:3] == [24, 23, 22] and {r.n_more for r in rows} == {15}


GRID = [
    # file f1: two sheets with equal rows → the earlier one wins
    ("f1", "A", 0, 0, ["Relatório 2023", None]),
    ("f1", "A", 0, 1, ["Mês", "Alvará", None, "Alvará", "Unidade"]),
    ("f1", "A", 0, 2, ["1", "A-1", "x", "dup", "u1"]),
    ("f1", "A", 0, 3, [None, None, None, None, None]),
    ("f1", "A", 0, 4, ["2", "A-2", None, "d2", None]),
    ("f1", "B", 1, 0, ["mes", "alvara"]),
    ("f1", "B", 1, 1, ["9", "Z"]),
    ("f1", "B", 1, 2, ["9", "Z"]),
    ("f1", "B", 1, 3, ["9", "Z"]),
    ("f1", "B", 1, 4, ["9", "Z"]),
    # file f2: no header words anywhere → row 0 is the header
    ("f2", "S", 0, 0, ["c1", "c2"]),
    ("f2", "S", 0, 1, ["v1", "v2"]),
]


def test_grid_sheet_header_and_records(spark):
    grid = spark.createDataFrame(GRID, "file string, sheet string, sheet_idx int, row_idx int, cells array<string>")
    chosen = {r.file: r.sheet for r in pick_sheet(grid).collect()}
    assert chosen == {"f1": "A", "f2": "S"}
    sheet = grid.join(pick_sheet(grid).select("file", "sheet_idx"), ["file", "sheet_idx"], "left_semi")
    heads = {r.file: r.header_row for r in header_rows(sheet, config.PERMIT_HEADER_WORDS).collect()}
    assert heads == {"f1": 1, "f2": 0}
    recs = apply_header(sheet, header_rows(sheet, config.PERMIT_HEADER_WORDS))
    assert set(recs.columns) >= {"mês", "alvará", "alvará_1", "unidade", "c1", "c2"}
    f1 = sorted((r["mês"], r["alvará"], r["alvará_1"]) for r in recs.filter("file = 'f1'").collect())
    assert f1 == [("1", "A-1", "dup"), ("2", "A-2", "d2")]
    f2 = [(r.c1, r.c2) for r in recs.filter("file = 'f2'").collect()]
    assert f2 == [("v1", "v2")]


def test_apply_header_shared_layouts_stable_order(spark):
    # 40 files over two header layouts: layouts are collected, files are not;
    # output columns follow the layout of the first file, then new names
    rows = []
    for i in range(40):
        f = f"f{i:02d}"
        head = ["Mês", "Alvará", "Extra"] if i % 2 else ["Mês", "Alvará"]
        rows.append((f, 0, head))
        rows.append((f, 1, [str(i), f"A-{i}"] + (["x"] if i % 2 else [])))
        rows.append((f, 2, [None, None] + ([None] if i % 2 else [])))
    grid = spark.createDataFrame(rows, "file string, row_idx int, cells array<string>")
    heads = spark.createDataFrame([(f"f{i:02d}", 0) for i in range(40)], "file string, header_row int")
    recs = apply_header(grid, heads)
    assert recs.columns == ["file", "row_idx", "mês", "alvará", "extra"]
    got = sorted((r.file, r["mês"], r["alvará"], r.extra) for r in recs.collect())
    assert got == sorted((f"f{i:02d}", str(i), f"A-{i}", "x" if i % 2 else None) for i in range(40))


def test_hot_key_third_of_rows(spark):
    # key 0 holds a third of all rows; both operators cut it map-side before the shuffle
    n = 30_000
    df = (spark.range(n).repartition(8)
               .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                       F.col("id").alias("seq"), (F.col("id") % 7).cast("double").alias("v")))
    first = keep_first(df, ["k"], ["seq"])
    assert first.count() == 1 + (n - n // 3)
    assert first.filter("k = 0").collect()[0].seq == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # partial limit sits below the exchange
    rep = grouped_report(df, ["k"], "seq", "v", digits=0)
    hot = rep.filter("k = 0").collect()[0]
    assert hot.qtd == n // 3
    assert hot.valor == float(sum(i % 7 for i in range(0, n, 3)))
    agg_plan = rep._jdf.queryExecution().executedPlan().toString()
    assert agg_plan.count("HashAggregate") >= 2  # partial (map-side) + final


def test_null_safe_join_hot_null_key(spark):
    # a third of the left keys are null; null matches the one null-keyed right row
    n = 9_000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50)
                                 .cast("bigint").alias("k"), F.col("id"))
    right = spark.createDataFrame([(None, "null-row")] + [(i, f"r{i}") for i in range(50)],
                                  "k bigint, label string")
    out = null_safe_join(left, right, ["k"], "left")
    assert out.count() == n
    assert out.filter(F.col("k").isNull() & (F.col("label") == "null-row")).count() == n // 3
    assert out.filter(F.col("label").isNull()).count() == 0


def test_apply_header_takes_any_number_of_layouts(spark):
    n = 12_000  # a layout per file: the wanted column moves, and each file has a column of its own
    files = spark.range(n).select(F.col("id").cast("string").alias("file"), F.col("id"))
    pad = F.transform(F.sequence(F.lit(0), (F.col("id") % 30).cast("int")), lambda i: F.concat(F.lit("c"), F.col("file"), F.lit("_"), i))
    head = F.concat(pad, F.array(F.lit("Alvará"), F.lit("Mês")))
    body = F.concat(F.transform(pad, lambda x: F.lit("v")), F.array(F.concat(F.lit("A-"), F.col("file")), F.lit("NA")))
    grid = files.select("file", F.lit(0).alias("sheet_idx"), F.explode(F.array(
        F.struct(F.lit(0).alias("row_idx"), head.alias("cells")), F.struct(F.lit(1).alias("row_idx"), body.alias("cells")),
        F.struct(F.lit(2).alias("row_idx"), F.array(F.lit(""), F.lit("NA")).alias("cells")))).alias("r")).select("file", "sheet_idx", "r.*")
    recs = apply_header(grid, sheet_headers(grid, config.PERMIT_HEADER_WORDS), columns=["alvará", "mês", "none"])
    row = recs.agg(F.count("*").alias("n"), F.count_if(F.col("alvará") == F.concat(F.lit("A-"), "file")).alias("right"),
                   F.count("mês").alias("m"), F.count("none").alias("x")).first()
    assert tuple(row) == (n, n, 0, 0)


def test_widening_union(spark, tmp):
    from itertools import permutations

    from pyspark.sql import types as T

    from lavra.operators import read_drifting, union_widened
    from lavra.operators.widen import widened, wider
    a = spark.createDataFrame([(1, 1, "2024-01-01", True, [1])], "a int, b long, d string, f boolean, g array<int>").withColumn("d", F.to_date("d"))
    b = spark.createDataFrame([(2.5, 2, "x", 3)], "a double, b short, f string, h int")
    c = spark.createDataFrame([(None, "2024-02-02 03:04:05", {"k": 1})], "a byte, d string, g map<string,int>").withColumn("d", F.to_timestamp_ntz("d"))
    for frames in permutations([a, b, c]):
        out = union_widened(frames)
        assert dict(out.dtypes) == {"a": "double", "b": "bigint", "d": "timestamp_ntz", "f": "string", "g": "string", "h": "int"}
        assert sorted(str((r.a, r.b, r.f, r.g, r.h)) for r in out.collect()) == sorted(
            str(x) for x in [(1.0, 1, "true", "[1]", None), (2.5, 2, "x", None, 3), (None, None, None, '{"k":1}', None)])
    report = {r[0]: r[1:] for r in widened([a.schema, b.schema, c.schema])[1]}
    assert report["a"] == (["double", "int", "tinyint"], "double", False) and report["f"] == (["boolean", "string"], "string", True)
    assert wider(T.DecimalType(10, 2), T.LongType()) == T.DecimalType(21, 2) and wider(T.DecimalType(38, 0), T.DecimalType(10, 5)) == T.StringType()
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType() and wider(T.LongType(), T.FloatType()) == T.DoubleType()
    for i, df in enumerate((a, b, b, c)):
        df.write.parquet(f"{tmp}/{i}")
    rows, seen = read_drifting(spark, tmp)
    assert rows.count() == 4 and {r["column"] for r in seen.filter("conflict").collect()} == {"f", "g"}
    assert {r["column"]: r.result for r in seen.collect()}["a"] == "double"
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{tmp}/none")
        read_drifting(spark, f"{tmp}/none")
