import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from lavra.sources import expand_zip, extract_links, zip_lines, read_delimited, read_envelope_pages, read_inferred, read_jsonl


def test_delimited_bad_line_policy(spark, tmp):
    path = os.path.join(tmp, "t.csv")
    lines = ["a;b;c", "1;2;3", "4;5", "6;7;8;9", "10;11;12;", '"x;y";z;w', "NA;null;ok", '"q"";r";s;t']
    with open(path, "wb") as fh:
        fh.write(("\n".join(lines) + "\n").encode("latin-1"))
    df = read_delimited(spark, path, ["a", "b", "c"], sep=";", header=True)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted([("1", "2", "3"), ("4", "5", None), ("x;y", "z", "w"), (None, None, "ok"),
                          ("q\";r", "s", "t")], key=repr)


def test_delimited_count_nul_and_cp1252(spark, tmp):
    # count() alone must work (no query over only a corrupt-record column);
    # a line holding NUL is kept whole; windows-1252 bytes are re-mapped
    path = os.path.join(tmp, "n.csv")
    with open(path, "wb") as fh:
        fh.write(b"h1;h2\n1;a\x00b\n\x93q\x94;2\n3;4;5\n")
    df = read_delimited(spark, path, ["a", "b"], sep=";", charset="windows-1252", header=True)
    assert df.count() == 2
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(
        [("1", "a\x00b"), ("\u201cq\u201d", "2")], key=repr)


def test_cp1252_csv(spark, tmp):
    path = os.path.join(tmp, "w.csv")
    with open(path, "wb") as fh:
        fh.write(b"Munic\xedpio;Valor\n\x93A\x94;1\n\x81;2\n\"p\"\"q\";3\n")
    df = read_inferred(spark, path, sep=";", charset="windows-1252")
    assert df.columns == ["Município", "Valor"]
    got = sorted((r[0], r[1]) for r in df.collect())
    assert got == [("p\"q", 3), ("“A”", 1), ("�", 2)]


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def test_expand_zip(spark):
    rows = [("a.zip", bytearray(_zip([("d/x.CSV", b"1"), ("y.csv", b"22"), ("z.txt", b"3")]))),
            ("empty.zip", bytearray(_zip([]))), ("bad.zip", bytearray(b"not a zip"))]
    files = spark.createDataFrame(rows, "path string, content binary")
    out = expand_zip(files, member_pattern=r"\.(csv|xlsx)$")
    got = sorted((r.archive, r.member, None if r.content is None else bytes(r.content), r.error is None)
                 for r in out.collect())
    assert got[:2] == [("a.zip", "x.CSV", b"1", True), ("a.zip", "y.csv", b"22", True)]
    assert {r[0] for r in got[2:]} == {"bad.zip", "empty.zip"} and not any(r[3] for r in got[2:])
    first = expand_zip(files.filter("path = 'a.zip'"), first_only=True).collect()
    assert [r.member for r in first] == ["x.CSV"]


def test_extract_links(spark):
    html = ('<a href="/documents/d/licenciamento/sissel_ano_2026_02">x</a>'
            '<a class="c" href="/documents/d/licenciamento/sissel_ano_2026_03">y</a>'
            '<a href="https://other/documents/d/licenciamento/sissel_ano_2025">z</a><a href="/nope">n</a>')
    df = spark.createDataFrame([(1, html)], "id int, html string")
    out = extract_links(df, "html", "https://host", keep=["id"], fragment="/documents/d/licenciamento/sissel")
    assert [r.href for r in out.orderBy("link_pos").collect()] == [
        "https://host/documents/d/licenciamento/sissel_ano_2026_02",
        "https://host/documents/d/licenciamento/sissel_ano_2026_03",
        "https://other/documents/d/licenciamento/sissel_ano_2025"]


def test_envelope_pages_and_jsonl(spark, tmp):
    page = {"data": [{"numeroControlePNCP": "1", "orgaoEntidade": {"esferaId": "M"}},
                     {"numeroControlePNCP": "2"}], "totalPaginas": 1}
    os.makedirs(os.path.join(tmp, "p"))
    with open(os.path.join(tmp, "p", "page_1.json"), "w") as fh:
        json.dump(page, fh, indent=2)
    rows = read_envelope_pages(spark, os.path.join(tmp, "p")).orderBy("position").collect()
    assert [json.loads(r.payload)["numeroControlePNCP"] for r in rows] == ["1", "2"]
    assert json.loads(rows[0].payload)["orgaoEntidade"] == {"esferaId": "M"}
    missing = read_jsonl(spark, os.path.join(tmp, "absent"), "a string")
    assert missing.count() == 0 and missing.columns == ["a"]
    with open(os.path.join(tmp, "l.jsonl"), "w") as fh:
        fh.write('{"a": "x"}\n\n{"a": "y"}\n')
    assert read_jsonl(spark, os.path.join(tmp, "l.jsonl"), "a string").count() == 2


def test_layers_routing_and_landing(spark, tmp):
    import pytest
    from lavra.sources import land_bytes, list_layer, read_bytes, route_by_extension
    for layer, name, data in [("bronze/x", "a.csv", b"1"), ("bronze/x", "b.ZIP", b"22"),
                              ("bronze/x_y", "c.csv", b"333")]:
        os.makedirs(os.path.join(tmp, layer), exist_ok=True)
        with open(os.path.join(tmp, layer, name), "wb") as fh:
            fh.write(data)
    listed = sorted(os.path.basename(r.path) for r in list_layer(spark, tmp, "bronze/x").collect())
    assert listed == ["a.csv", "b.ZIP"]  # the trailing slash keeps x_y out
    routes = route_by_extension(list_layer(spark, tmp, "bronze/x"), ["csv", "zip"])
    assert routes["csv"].count() == 1 and routes["zip"].count() == 1
    with pytest.raises(ValueError):
        route_by_extension(list_layer(spark, tmp, "bronze/x"), ["csv"])
    land_bytes(read_bytes(spark, os.path.join(tmp, "bronze", "x_y")), os.path.join(tmp, "landed"))
    got = spark.read.parquet(os.path.join(tmp, "landed")).collect()
    assert [(r.length, bytes(r.content)) for r in got] == [(3, b"333")]


def test_delimited_stray_quotes_and_quoted_newlines(spark, tmp):
    path = os.path.join(tmp, "q.csv")
    records = ['a;5" pipe;y', 'a;5" pipe;y;z', '"q\nnl";b;c', "x;y;", "x;y;z;", "x;y;z;;", "only", '"d""q";;3']
    with open(path, "wb") as fh:
        fh.write(("\n".join(records) + "\n").encode("latin-1"))
    df = read_delimited(spark, path, ["a", "b", "c"], sep=";", header=False)
    # by hand from the policy: fields too many drop a record, also blank ones; missing ones are null
    want = [("a", '5" pipe', "y"), ("q\nnl", "b", "c"), ("x", "y", None), ("only", None, None), ('d"q', None, "3")]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)
    assert df.select("b").count() == len(want)


def test_inferred_pads_short_rows_and_reads_missing_tokens(spark, tmp):
    path = os.path.join(tmp, "i.csv")
    with open(path, "wb") as fh:
        fh.write("h1;h2;h3;h4\n1;2,5;1.5;x\n2;NA;N/A\n3;text;2;\x81y\n4;5;6;7;8\n".encode("latin-1"))
    df = read_inferred(spark, path, sep=";", charset="windows-1252")
    assert dict(df.dtypes) == {"h1": "bigint", "h2": "string", "h3": "double", "h4": "string"}
    rows = {r.h1: r for r in df.collect()}
    assert sorted(rows) == [1, 2, 3] and rows[2].h2 is None and rows[2].h3 is None and rows[2].h4 is None


def test_zip_lines_stream_in_batches_with_error_rows(spark):
    def pack(members):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            for name, body in members:
                zf.writestr(name, body)
        return bytearray(buf.getvalue())

    files = spark.createDataFrame(
        [("a.zip", "2024-01", pack([("x.csv", "l0\r\nl1 \xe9\n\nl3".encode("latin-1")), ("y.csv", b"no")])),
         ("b.zip", "2024-02", bytearray(b"broken")), ("c.zip", "2024-03", pack([("n.txt", b"t")])),
         ("d.zip", "2024-04", pack([("big.csv", b"z\n" * 5000)]))], "path string, period string, content binary")
    rows = zip_lines(files, ["path", "period"], member_pattern=r"\.csv$", batch=64).collect()
    assert [(r.line_no, r.line) for r in rows if r.path == "a.zip"] == [(0, "l0"), (1, "l1 \xe9"), (2, ""), (3, "l3")]
    errors = {r.path: r.error for r in rows if r.error}
    assert set(errors) == {"b.zip", "c.zip"} and all(r.line is None for r in rows if r.error)
    assert sum(r.path == "d.zip" and r.period == "2024-04" for r in rows) == 5000


def test_esri_pages_keep_the_geometry_text(spark, tmp):
    from lavra.plans import mining
    from lavra.sources import jsonl
    with open(os.path.join(tmp, "p.json"), "w") as fh:
        fh.write('{"features":[{"attributes":{"PROCESSO":"1"},"geometry":{"rings":[[[1.50,2],[3,4]]],"hasZ":false}},'
                 '{"attributes":{"PROCESSO":"2"}}]}')
    rows = {r.processo: r for r in mining.geometry_rows(jsonl.read_esri_pages(spark, tmp), "2024-01-01").collect()}
    assert rows["1"].geometry_raw == '{"rings":[[[1.50,2],[3,4]]],"hasZ":false}' and rows["2"].geometry_raw == "{}"
    assert rows["1"].lat is not None and rows["2"].lat is None


def test_links_quotes_case_and_other_attributes(spark):
    html = """<A HREF='/a'>x</a> <a data-href="/no" href=/b>y</a> <a data-href="/no">z</a> <a class="k" href="c?d">w</a>"""
    rows = extract_links(spark.createDataFrame([(html,)], "html string"), "html", "https://h.example").collect()
    assert [r.href for r in rows] == ["https://h.example/a", "https://h.example/b", "c?d"]
