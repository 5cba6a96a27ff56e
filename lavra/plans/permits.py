"""Building permits: yearly workbooks (as grid tables) → one silver table.

Per file: the sheet with most rows, the header row found by header words,
rows below it named by that row (accents kept). Years are merged by name
(spellings drift across years), coalescing variants, parsing areas and
dates, classifying land use and keeping the first row per
(alvara, processo, ano_referencia).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config
from ..functions import (br_money, concat_skip_blank, extract_optional_int, first_match_regex,
                         parse_two_formats, snake_keep_accents)
from ..operators import (apply_header, coalesce_variants, col_or_null, grouped_report, keep_first, latest_variant,
                         override_merge, sheet_headers)
from ..sources import extract_links

AREA_COLUMNS = {"area_construcao_m2", "area_terreno_m2"}
DATE_COLUMNS = {"dt_aprovacao", "dt_autuacao"}
# every spelling that silver reads; other columns of a workbook are not silver's
PERMIT_RAW_COLUMNS = list(dict.fromkeys(
    [c for _, variants in config.PERMIT_COLUMN_VARIANTS for c in variants]
    + [config.PERMIT_BLOCKS_DIRECT, *config.PERMIT_BLOCKS_PARTS]))


def records(grid: DataFrame, years: DataFrame, ingest_date: str) -> DataFrame:
    """Grid rows of every file → named records with ``ano_referencia`` lineage.

    ``years`` maps ``file`` → ``ano`` (one row per file).
    """
    # one pass decides sheet and header of every file, one more reads the records
    heads = sheet_headers(grid, config.PERMIT_HEADER_WORDS)
    recs = apply_header(grid, heads, snake_keep_accents, columns=PERMIT_RAW_COLUMNS)
    return recs.join(years.select("file", F.col("ano").alias("ano_referencia")), "file") \
               .withColumn("dt_ingestao", F.lit(ingest_date))


def silver(raw: DataFrame) -> DataFrame:
    cols = [col_or_null(raw, "ano_referencia").alias("ano_referencia"),
            col_or_null(raw, "dt_ingestao").alias("dt_ingestao")]
    for target, variants in config.PERMIT_COLUMN_VARIANTS:
        value = coalesce_variants(raw, variants)
        if target in AREA_COLUMNS:
            value = br_money(value)
        elif target in DATE_COLUMNS:
            value = parse_two_formats(value)
        cols.append(value.alias(target))
    blocks = F.coalesce(col_or_null(raw, config.PERMIT_BLOCKS_DIRECT),
                        concat_skip_blank(" / ", *[col_or_null(raw, c) for c in config.PERMIT_BLOCKS_PARTS]))
    cols.append(blocks.alias("blocos_pavimentos_unidades"))
    order = [c for c in ("file", "row_idx") if c in raw.columns]
    out = raw.select(*cols, *[F.col(c) for c in order])
    out = out.withColumn("uso_classificado", first_match_regex("categoria_de_uso", config.LAND_USE_RULES,
                                                               config.LAND_USE_DEFAULT))
    first = keep_first(out, ["alvara", "processo", "ano_referencia"], ["ano_referencia"] + order)
    return first.drop(*order)


def recent_links(pages: DataFrame, host: str) -> DataFrame:
    """Latest link per year from the listing page(s): highest month, later link on a tie."""
    links = extract_links(pages.withColumn("__page", F.monotonically_increasing_id()), "html", host,
                          keep=["__page"], fragment=config.PERMIT_LINK_FRAGMENT)
    links = links.filter(F.col("href").rlike(config.PERMIT_LINK_PATTERN))
    links = links.withColumn("year", F.regexp_extract("href", config.PERMIT_LINK_PATTERN, 1)) \
                 .withColumn("month", extract_optional_int("href", config.PERMIT_LINK_PATTERN, 2))
    return latest_variant(links, "year", "href", ["month", "__page", "link_pos"])


def year_urls(spark: SparkSession, fixed: dict[str, str], recent: DataFrame) -> DataFrame:
    """Fixed year → URL catalog overridden by the links found on the page."""
    fixed_df = spark.createDataFrame(sorted(fixed.items()), "year string, href string")
    return override_merge(fixed_df, recent, "year", "href")


def report(silver_df: DataFrame) -> DataFrame:
    """Permits and built area (km², 2 decimals) per land use and year."""
    return grouped_report(silver_df, ["uso_classificado", "ano_referencia"], "alvara", "area_construcao_m2",
                          count_name="qtd", sum_name="area_total_km2", scale=1e6, digits=2,
                          order=[F.asc("ano_referencia"), F.desc("qtd")])
