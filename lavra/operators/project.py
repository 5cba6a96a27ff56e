"""Projection, renaming, lineage, filters and JSON flattening."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ..functions.text import lower_contains_any


def col_or_null(df: DataFrame, name: str, dtype: str | DataType = "string") -> Column:
    """The column when the frame has it, else a typed null (drifting schemas)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast(dtype)


def project_or_null(df: DataFrame, mapping: Sequence[tuple[str, str]],
                    dtypes: Mapping[str, str | DataType] | None = None) -> DataFrame:
    """``select(source AS target)`` where an absent source gives a null column."""
    dtypes = dtypes or {}
    return df.select(*[col_or_null(df, src, dtypes.get(tgt, "string")).alias(tgt)
                       for tgt, src in mapping])


def coalesce_variants(df: DataFrame, variants: Sequence[str],
                      dtype: str | DataType = "string") -> Column:
    """First non-null among the spellings present, in the order given."""
    present = [F.col(f"`{v}`") for v in variants if v in df.columns]
    if not present:
        return F.lit(None).cast(dtype)
    return F.coalesce(*present) if len(present) > 1 else present[0]


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL aligned by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))


def with_lineage(df: DataFrame, **values: object) -> DataFrame:
    """Add constant lineage columns (source, category, ingest date, period…)."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position; a width mismatch is an error, never a silent shift."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def keyword_filter(df: DataFrame, column: Column | str, terms: Iterable[str]) -> DataFrame:
    """Keep rows whose lower-cased text contains any term (null text never matches)."""
    return df.filter(lower_contains_any(column, terms))


def eq_in_filter(df: DataFrame, equals: Mapping[str, object] | None = None,
                 isin: Mapping[str, Sequence[object]] | None = None,
                 between: Mapping[str, tuple[object, object]] | None = None) -> DataFrame:
    """Conjunction of ``=``, ``IN`` and inclusive ranges; all push down to Parquet."""
    cond = F.lit(True)
    for k, v in (equals or {}).items():
        cond = cond & (F.col(k) == F.lit(v))
    for k, vs in (isin or {}).items():
        cond = cond & F.col(k).isin(list(vs))
    for k, (lo, hi) in (between or {}).items():
        cond = cond & F.col(k).between(F.lit(lo), F.lit(hi))
    return df.filter(cond)


def flatten_json(df: DataFrame, payload: str, schema: StructType,
                 fields: Sequence[tuple[str, str]], keep: Sequence[str] = (),
                 corrupt_flag: str | None = None) -> DataFrame:
    """Parse a JSON text column with a declared schema and pull nested paths out.

    ``fields`` is ``[(output_name, "a.b.c"), …]``; a null or missing struct on
    the way gives null, like ``dict.get`` chains. ``corrupt_flag`` names an
    optional boolean column that is true when the payload is not a JSON object.
    """
    if corrupt_flag:
        schema = StructType(list(schema.fields) + [StructField("__corrupt", StringType())]) \
            if isinstance(schema, StructType) else f"{schema}, __corrupt string"
        doc = F.from_json(F.col(payload), schema,
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    else:
        doc = F.from_json(F.col(payload), schema)
    # explode(array(doc)) is a generator the optimizer will not fold into the
    # field accesses below: the text is parsed once, not once per field
    parsed = df.select("*", F.explode(F.array(doc)).alias("__doc"))
    cols = [F.col(k) for k in keep]
    cols += [F.col("__doc." + path).alias(name) for name, path in fields]
    if corrupt_flag:
        # a text that is not a JSON object lands whole in the corrupt-record field
        cols.append((F.col(payload).isNotNull() & F.col("__doc.__corrupt").isNotNull()).alias(corrupt_flag))
    return parsed.select(*cols)