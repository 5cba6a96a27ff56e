"""Delimited files split inside quotes, and zip archives planned by member."""

import os
import random
import zipfile

import pytest

from lavra.sources import quoted_records, read_delimited, read_inferred_zip, read_quoted, read_zip, write_zips
from lavra.sources.delimited import parse_delimited_lines
from lavra.sources.zip_source import plan_archive


@pytest.fixture()
def split_size(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}

    def use(n):
        for k in keys:
            spark.conf.set(k, str(n))
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rng):
    return rng.choice(["", '"' + rng.choice(["a;b", "x\ny", 'q""r', "\n\n", "p\r\nq", ";\n;\n", 'é\n""']) + '"', '5" pipe', '""',
                       '"w" z', "abc", "1,5", "ção", "NA", " lead"])


def test_quoted_splits_equal_the_whole_read(spark, tmp, split_size):
    rng = random.Random(1)
    for f in range(3):
        records = [";".join(field(rng) for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for _ in range(300)]
        if f == 1:  # a record that spans many splits
            records.insert(50, 'a;"' + "long line\n" * 800 + 'end";z')
        with open(f"{tmp}/f{f}.csv", "wb") as out:
            out.write(("h1;h2;h3\n" + "\n".join(records) + "\n" * (f > 0)).encode("latin-1"))
    want = sorted(map(tuple, read_delimited(spark, tmp, ["a", "b", "c"]).collect()), key=str)
    assert any(r[1] and r[1].startswith("long line\nlong") for r in want)
    for size in (128 << 20, 3000, 61):
        split_size(size)
        assert sorted(map(tuple, read_quoted(spark, tmp, ["a", "b", "c"]).collect()), key=str) == want


def test_quoted_charsets_folders_and_open_ends(spark, tmp, split_size):
    for period, body in (("2024-01", 'x;"a\nb"\r\n\r\ny;"c"\r\n'), ("2024-02", 'z;€ “q”\n"open;\nto the end')):
        os.makedirs(f"{tmp}/period={period}")
        with open(f"{tmp}/period={period}/f.csv", "wb") as out:
            out.write(body.encode("cp1252"))
    for size in (1 << 20, 5):
        split_size(size)
        got = {(str(r.period), r.line) for r in quoted_records(spark, tmp, charset="windows-1252", header=False).collect()}
        assert got == {("2024-01", 'x;"a\nb"'), ("2024-01", 'y;"c"'), ("2024-02", "z;€ “q”"), ("2024-02", '"open;\nto the end')}
    assert quoted_records(spark, tmp, charset="UTF-8", header=True).count() == 2


def test_one_quoted_file_is_many_tasks(spark, tmp, split_size):
    with open(f"{tmp}/big.csv", "w") as out:
        out.writelines(f'{i};"line one\nline two";x\n' for i in range(20_000))
    split_size(64 << 10)
    rows = read_quoted(spark, tmp, ["a", "b", "c"], header=False)
    assert rows.agg({"a": "max"}).first()[0] == "9999" and rows.filter("b = 'line one\nline two'").count() == 20_000
    assert spark.read.text(tmp).rdd.getNumPartitions() >= 8


def test_zip_members_are_planned_read_and_isolated(spark, tmp):
    body = b'h;t\n1;"x\ny"\r\nz;\xe9\n' * 50
    rows = [(f"a{i % 2}.zip", f"d/m{i}.CSV", bytearray(body)) for i in range(6)] + [("n.zip", "r.txt", bytearray(b"t"))]
    written = write_zips(spark.createDataFrame(rows, "archive string, member string, content binary"), f"{tmp}/z")
    assert sorted(map(tuple, written.collect())) == [("a0.zip", 3), ("a1.zip", 3), ("n.zip", 1)]
    with open(f"{tmp}/z/a0.zip", "rb") as f:
        data = bytearray(f.read())
    data[42:52] = b"\xff" * 10  # inside the first member
    with open(f"{tmp}/z/b.zip", "wb") as f:
        f.write(data)
    with open(f"{tmp}/z/short.zip", "wb") as f:
        f.write(b"PK")
    got = read_zip(spark, f"{tmp}/z", pattern=r"\.csv$", sep=";", bundleBytes=1, batchRows=7)
    assert got.rdd.getNumPartitions() == 10  # a member each; archives with an error share one
    lines = [(r.archive, r.member, r.line_no, r.line) for r in got.filter("error is null").collect()]
    whole = {(a, f"m{i}.CSV") for a, n in (("a0.zip", 0), ("a1.zip", 1)) for i in (n, n + 2, n + 4)} | {("b.zip", "m2.CSV"), ("b.zip", "m4.CSV")}
    records = ["h;t", '1;"x\ny"', "z;é"] * 50
    for a, m in whole:
        assert [x[3] for x in sorted(x for x in lines if x[:2] == (a, m))] == records
    errors = {(r.archive, r.member): r.error for r in got.filter("error is not null").collect()}
    assert set(errors) == {("b.zip", "m0.CSV"), ("short.zip", None), ("n.zip", None)}
    assert errors["short.zip", None] == "BadZipFile: File is not a zip file"
    content = read_zip(spark, f"file://{tmp}/z/a1.zip", rows="content").collect()
    assert [bytes(r.content) for r in content] == [body] * 3
    first = read_zip(spark, f"{tmp}/z", names="^a", first=True).filter("line_no = 0").select("archive", "member").collect()
    assert sorted(map(tuple, first)) == [("a0.zip", "m0.CSV"), ("a1.zip", "m1.CSV")]
    assert [len(p.members) for p in plan_archive(f"{tmp}/z/a1.zip", None, 1 << 20)] == [3]
    assert read_zip(spark, f"{tmp}/z").rdd.getNumPartitions() == 1
    os.makedirs(f"{tmp}/none")
    assert read_zip(spark, f"{tmp}/none").count() == 0


def test_zip_with_drifting_headers(spark, tmp):
    with zipfile.ZipFile(f"{tmp}/s.zip", "w") as zf:
        zf.writestr("a.csv", 'nome;valor\nx;1\n"y\nz";2\n')
        zf.writestr("b.csv", "nome;valor;novo\nw;3;t\nv;4\nu;5;6;7\n")
    got = read_inferred_zip(spark, f"{tmp}/s.zip")
    assert dict(got.dtypes) == {"nome": "string", "valor": "bigint", "novo": "string"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("x", 1, None), ("y\nz", 2, None), ("w", 3, "t"), ("v", 4, None)], key=str)
    with pytest.raises(ValueError):
        read_inferred_zip(spark, f"{tmp}/s.zip", pattern="none$")


def test_reading_many_columns_is_planned_at_once(spark, tmp):
    """A condition on a record's fields must not be multiplied by every set of columns made of them."""
    names = [f"c{i}" for i in range(10)]
    full = ";".join(f"v{i}" for i in range(10))
    with open(f"{tmp}/x.csv", "w") as out:
        out.write(f"{full}\n{full};extra\na;NA\n{full};\n{full};;;\n")
    rows = read_quoted(spark, tmp, names, header=False)
    lines = spark.read.text(tmp).withColumnRenamed("value", "line")
    for got in (rows, parse_delimited_lines(lines, names)):
        got = got.filter("c0 <> 'x'").select("*", got.c1.alias("again")).distinct()
        plan = got._jdf.queryExecution().optimizedPlan()
        size = 0
        while plan.children().size():  # every step, down to the file
            size = max(size, plan.validConstraints().size())
            plan = plan.children().head()
        assert size < 60
        assert sorted(tuple(r)[:3] for r in got.collect()) == [("a", None, None), ("v0", "v1", "v2")]
