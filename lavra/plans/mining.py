"""Mining claims: ESRI attribute and geometry pages → one silver table.

Attributes are projected and typed (absent fields → null), classified by
phase and aggregate type and kept once per claim (first by FID); geometries
become first-ring centroids and are kept once per claim; the two meet in a
null-safe left join (null claim numbers match, as in the source tool).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import config
from ..functions import first_match_set, first_ring_centroid, nullable_int, to_double
from ..operators import coverage, grouped_report, keep_first, null_safe_join

ATTRIBUTE_FIELDS = [
    ("processo", "PROCESSO"), ("processo_formatado", "DSProcesso"), ("id_anm", "ID"),
    ("numero", "NUMERO"), ("ano", "ANO"), ("substancia", "SUBS"), ("uso", "USO"),
    ("fase", "FASE"), ("titular", "NOME"), ("area_ha", "AREA_HA"), ("uf", "UF"),
    ("ultimo_evento", "ULT_EVENTO"),
]


def source_filter(attrs: DataFrame) -> DataFrame:
    """The state + substance predicate the source query applies."""
    return attrs.filter((F.col("attributes")["UF"] == config.MINING_STATE)
                        & F.col("attributes")["SUBS"].isin(config.MINING_SUBSTANCES))


def attributes_rows(pages: DataFrame, ingest_date: str, keep: Sequence[str] = ()) -> DataFrame:
    """ESRI feature rows → attribute map + FID + lineage."""
    return pages.select("attributes", F.col("attributes")["FID"].try_cast("bigint").alias("fid"),
                        *keep, "source_file", "position", F.lit(ingest_date).alias("dt_ingestao"))


def geometry_rows(pages: DataFrame, ingest_date: str, keep: Sequence[str] = ()) -> DataFrame:
    """ESRI feature rows → (processo, lat, lon, geometry_raw as landed); absent geometry → ``{}``."""
    lat, lon = first_ring_centroid(F.col("geometry.rings"))
    text = F.col("geometry_raw") if "geometry_raw" in pages.columns else F.to_json("geometry")
    raw = F.coalesce(text, F.lit("{}"))
    return pages.select(F.col("attributes")["PROCESSO"].alias("processo"), lat.alias("lat"),
                        lon.alias("lon"), raw.alias("geometry_raw"), *keep, "source_file", "position",
                        F.lit(ingest_date).alias("dt_ingestao"))


def silver(attrs: DataFrame, geom: DataFrame) -> DataFrame:
    a = F.col("attributes")
    cols = []
    for name, key in ATTRIBUTE_FIELDS:
        v = a[key]
        if name in ("numero", "ano"):
            v = nullable_int(v)
        elif name == "area_ha":
            v = to_double(v)
        cols.append(v.alias(name))
    typed = attrs.select(*cols, "dt_ingestao", "fid", "source_file", "position")
    typed = typed.withColumn("fase_grupo", first_match_set("fase", config.MINING_PHASE_GROUPS, config.OTHER_GROUP)) \
                 .withColumn("tipo_agregado", first_match_set("substancia", config.MINING_AGGREGATE_GROUPS,
                                                              config.OTHER_GROUP))
    first = keep_first(typed, ["processo"], ["fid", "source_file", "position"]).drop("fid", "source_file", "position")
    g = keep_first(geom, ["processo"], ["source_file", "position"]).select("processo", "lat", "lon", "geometry_raw")
    return null_safe_join(first, g, ["processo"], "left")


def coverage_report(silver_df: DataFrame) -> DataFrame:
    return coverage(silver_df, "lat")


def report(silver_df: DataFrame) -> DataFrame:
    """Claims and area (ha, units) per aggregate type and phase group."""
    return grouped_report(silver_df, ["tipo_agregado", "fase_grupo"], "processo", "area_ha",
                          count_name="qtd_processos", sum_name="area_total_ha", digits=0,
                          order=[F.asc("tipo_agregado"), F.asc("fase_grupo")])
