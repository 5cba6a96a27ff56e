import datetime as dt

from pyspark.sql import functions as F

from lavra import config
from lavra.functions import (br_money, br_quantity, concat_skip_blank, cp1252_from_latin1,
                             extract_optional_int, first_match_regex, first_match_set,
                             first_ring_centroid, nullable_int, parse_dayfirst, parse_iso,
                             parse_two_formats, snake_ascii, snake_keep_accents, strip_unicode,
                             to_double, url_basename)
from lavra.functions.names import dedupe_names
from tests.conftest import values


def test_br_money(spark):
    got = values(spark, br_money("x"), ["1.234,56", "1234.56", "12d", "NA", None, " 2,5 "])
    assert got == [1234.56, 123456.0, None, None, None, 2.5]


def test_br_quantity(spark):
    assert values(spark, br_quantity("x"), ["1.234,5", "2,5", "3"]) == [None, 2.5, 3.0]


def test_to_double_is_strict(spark):
    got = values(spark, to_double("x"), [" 7 ", "-1e3", ".5", "0x10", "1_000", "", "inf", "nan", "12f"])
    assert got == [7.0, -1000.0, 0.5, None, None, None, None, None, None]


def test_nullable_int(spark):
    assert values(spark, nullable_int("x"), ["7.0", "7.5", "x", "42"]) == [7, None, None, 42]


def test_two_format_dates_with_pivot(spark):
    got = values(spark, parse_two_formats("x"),
                 ["1/2/2023", "01/02/99", "01/02/68", "01/02/69", "2023-05-01 00:00:00", "31/02/2023", None])
    assert got == [dt.datetime(2023, 2, 1), dt.datetime(1999, 2, 1), dt.datetime(2068, 2, 1),
                   dt.datetime(1969, 2, 1), None, None, None]


def test_dayfirst_and_iso(spark):
    assert values(spark, parse_dayfirst("x"), ["05/03/2023", "31/02/2023", "5/3/2023 10:30:00"]) == \
        [dt.datetime(2023, 3, 5), None, dt.datetime(2023, 3, 5, 10, 30)]
    assert values(spark, parse_iso("x"), ["2024", "2024-01-15T10:30:00", "2024-01-15", "x"]) == \
        [None, dt.datetime(2024, 1, 15, 10, 30), dt.datetime(2024, 1, 15), None]


def test_strip_unicode(spark):
    assert values(spark, strip_unicode("x"), ["\t a  ", "　b ", "c"]) == ["a", "b", "c"]


def test_concat_skip_blank(spark):
    df = spark.createDataFrame([("3", " ", "2"), (None, "", " "), ("a", None, "b")], "a string, b string, c string")
    assert [r[0] for r in df.select(concat_skip_blank(" / ", "a", "b", "c")).collect()] == ["3 / 2", None, "a / b"]


def test_works_type_rules(spark):
    got = values(spark, first_match_regex("x", config.WORKS_TYPE_RULES, config.WORKS_TYPE_DEFAULT),
                 ["Rede de ÁGUA", "ponte sobre córrego", None, "pintura", "UBS central"])
    assert got == ["saneamento", "viário", "construção geral", "construção geral", "equipamento social"]


def test_land_use_rules(spark):
    got = values(spark, first_match_regex("x", config.LAND_USE_RULES, config.LAND_USE_DEFAULT),
                 ["nr1-3", "Comercial", None, "zzz", "e2"])
    assert got == ["residencial", "comercial", "outros", "outros", "equipamento"]


def test_regex_fallback_matches_rlike(spark):
    rules = [("^ab+c$", "anchored"), ("x|y", "xy")]
    assert values(spark, first_match_regex("x", rules, "none"), ["abbc", "AY", "q"]) == ["anchored", "xy", "none"]


def test_set_classifiers(spark):
    got = values(spark, first_match_set("x", config.MINING_PHASE_GROUPS, config.OTHER_GROUP),
                 ["LICENCIAMENTO", "REQUERIMENTO DE PESQUISA", "APTO PARA DISPONIBILIDADE", "XYZ", None])
    assert got == ["ativo", "em_processo", "disponivel", "outros", "outros"]


def test_centroid(spark):
    schema = "r array<array<array<double>>>"
    rows = [([],), ([[]],), ([[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]],),
            ([[[1.0, 1.0]], [[9.0, 9.0]]],), (None,)]
    df = spark.createDataFrame(rows, schema)
    lat, lon = first_ring_centroid("r")
    got = [tuple(r) for r in df.select(lat, lon).collect()]
    assert got == [(None, None), (None, None), (0.5, 1.0), (1.0, 1.0), (None, None)]


def test_name_normalizers():
    assert snake_ascii("Valor Investido ($)") == "valor_investido_s"
    assert snake_ascii("R$ Milhões") == "rs_milhoes"
    assert snake_ascii("Município") == "municipio"
    assert snake_ascii("a  b") == "a__b"
    assert snake_keep_accents("Área da Construção (m²)") == "área_da_construção_m"
    assert snake_keep_accents(" B/Locos P/Avimentos U/Nidades ") == "b_locos_p_avimentos_u_nidades"
    assert dedupe_names(["a", "a", "b", "a"]) == ["a", "a.1", "b", "a.2"]


def test_cp1252_mapping(spark):
    latin1 = b"\x93q\x94 \x81 \x80".decode("latin-1")
    assert values(spark, cp1252_from_latin1("x"), [latin1]) == ["“q” � €"]


def test_optional_group_and_paths(spark):
    pat = config.PERMIT_LINK_PATTERN
    assert values(spark, extract_optional_int("x", pat, 2), ["sissel_ano_2026_03", "sissel_ano_2025"]) == [3, 0]
    assert values(spark, url_basename("x"), ["https://h/a/Arq%20X.xlsx?d=1"]) == ["Arq X.xlsx"]


def test_nullable_int_exact(spark):
    assert values(spark, nullable_int("x"), ["9007199254740993", "7.0", "7.5", "1e3", " -4. ", "99999999999999999999"]) \
        == [9007199254740993, 7, None, 1000, -4, None]


def test_parse_iso_offsets_keep_wall_clock(spark):
    got = values(spark, parse_iso("x"), ["2024-01-15T10:00:00Z", "2024-01-15T10:00:00-03:00", "2024-01-15", "2024Z"])
    assert got == [dt.datetime(2024, 1, 15, 10)] * 2 + [dt.datetime(2024, 1, 15), None]


def test_name_rules():
    assert snake_ascii(" Valor  Investido ($) ") == "valor__investido_s" and snake_ascii("Açaí/ção-1") == "acaicao1"
    assert snake_keep_accents("Área da Construção (m²)") == "área_da_construção_m"
    assert snake_keep_accents("__a__b//c%") == "a_b_c" and snake_keep_accents("") == ""


def test_plain_rules_are_the_regex_rules(spark):
    """Folded text searches against (?iu) searches: each code point in place of each letter the rules use."""
    from pyspark.sql import functions as F

    from lavra.functions.classify import literal_alternatives

    rules = config.WORKS_TYPE_RULES + config.LAND_USE_RULES
    plain = [literal_alternatives(p) for p, _ in rules]
    assert None not in plain and plain[2][2:4] == ["ubs", "ubc"] and "r4" in plain[7]
    assert literal_alternatives("a.c") is None and literal_alternatives("[^a]") is None
    assert literal_alternatives("µ") is None and literal_alternatives("σ") is None and literal_alternatives("a||b") == ["a", "", "b"]
    letters = sorted({c for p in plain for x in p for c in x})
    points = spark.range(1, 0x20000).filter("id < 55296 or id > 57343").select(
        F.expr("decode(cast(unhex(lpad(hex(id), 8, '0')) as binary), 'UTF-32')").alias("c"))
    differ = points.filter(F.lit(False))
    for c in letters:
        as_rule = first_match_regex("c", [(c, "yes")], "no") == "yes"
        differ = differ.unionByName(points.filter(as_rule != F.col("c").rlike("(?iu)" + c)))
    assert differ.collect() == []


def test_classifier_edges(spark):
    texts = [None, "", "PAVİMENT", "pavıment", "ſaneamento", "SANEAMENTO", "CÓRREGO e ESCOLA", "galeria\nubC", "strASSE ß", "UBſ",
             "nr1-3", "ÁREA ÁGUA", "i̇ndust"]
    for rules in (config.WORKS_TYPE_RULES, config.LAND_USE_RULES):
        got = values(spark, first_match_regex("x", rules, "none"), texts)
        want = values(spark, first_match_regex("x", [*rules, ("(?!x)x", "never")], "none"), texts)  # not plain: regexes
        assert got == want
    assert values(spark, first_match_regex("x", [], "none"), ["a"]) == ["none"]
    assert values(spark, first_match_regex("x", [("", "any")], "none"), ["a", None]) == ["any", "any"]
