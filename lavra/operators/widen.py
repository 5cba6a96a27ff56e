"""Union of tables whose columns drift in type as well as in name.

A column has the narrowest type that holds all its types: whole numbers the
widest of them, whole numbers and decimals a decimal that fits both, any number
and a floating one ``double`` (whole numbers past 2 ** 53 are rounded, as in any
double), a date and a timestamp a timestamp. Types without such a common one are
text, nested values as JSON, and the report names them as conflicts. A table
that lacks a column has nulls there. Names are matched exactly.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
REPORT = "column string, types array<string>, result string, conflict boolean"


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    floating = (T.FloatType, T.DoubleType)
    number = (*floating, T.DecimalType)
    if (isinstance(a, number) or a in _WHOLE) and (isinstance(b, number) or b in _WHOLE):
        if isinstance(a, floating) or isinstance(b, floating):
            return T.DoubleType()
        (p, s), (q, r) = ((x.precision, x.scale) if isinstance(x, T.DecimalType) else (_DIGITS[x], 0) for x in (a, b))
        scale, whole = max(s, r), max(p - s, q - r)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, dated) and isinstance(b, dated):
        return next(x for x in (a, b) if not isinstance(x, T.DateType)) if T.DateType() in (a, b) else T.TimestampType()
    return T.StringType()


def widened(schemas: Iterable[T.StructType]) -> tuple[T.StructType, list[tuple]]:
    """(schema of the union, report rows) of tables; columns come in the order in which they first appear."""
    seen: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for f in schema.fields:
            kinds = seen.setdefault(f.name, [])
            if f.dataType not in kinds:
                kinds.append(f.dataType)
    fields, report = [], []
    for name, kinds in seen.items():
        # text swallows all, so what the others come to doesn't depend on the order of tables
        result = T.StringType() if T.StringType() in kinds else reduce(wider, sorted(kinds, key=str))
        fields.append(T.StructField(name, result))
        conflict = isinstance(result, T.StringType) and any(not isinstance(k, (T.StringType, T.NullType)) for k in kinds)
        report.append((name, sorted(k.simpleString() for k in kinds), result.simpleString(), conflict))
    return T.StructType(fields), report


def _as(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    c, kind = F.col(f"`{field.name}`"), df.schema[field.name].dataType
    if isinstance(field.dataType, T.StringType) and isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c).alias(field.name)
    return c.cast(field.dataType).alias(field.name)


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name with every column as wide as its tables need."""
    schema, _ = widened(f.schema for f in frames)
    return reduce(DataFrame.unionByName, [f.select(*[_as(f, x) for x in schema.fields]) for f in frames])


def widening_report(spark: SparkSession, schemas: Iterable[T.StructType]) -> DataFrame:
    """column, types, result, conflict of a union of such tables."""
    return spark.createDataFrame(widened(schemas)[1], REPORT)


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """file, schema (Spark's JSON) of every Parquet file under a path, from the files' footers."""
    from ..sources.zip_source import open_path
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path"))

    def footers(batches):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                system, at = open_path(name)
                with system.open_input_file(at) as f:
                    schema = pq.read_schema(f)
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                out.append(own.decode() if own else from_arrow_schema(schema).json())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["file", "schema"])

    return files.mapInArrow(footers, "file string, schema string")


def read_drifting(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, report) of Parquet files whose columns differ in type from file to file.

    Files of one schema are read together; the driver holds the schemas that differ and the list
    of files, as it does to plan any scan of them.
    """
    groups = (file_schemas(spark, path).groupBy("schema").agg(F.sort_array(F.collect_list("file")).alias("files"))
              .orderBy(F.col("files")[0]).collect())
    if not groups:
        raise FileNotFoundError(f"no Parquet file under {path}")
    schemas = [T.StructType.fromJson(json.loads(g["schema"])) for g in groups]
    frames = [spark.read.schema(s).parquet(*g["files"]) for s, g in zip(schemas, groups, strict=True)]
    return union_widened(frames), widening_report(spark, schemas)


__all__ = ["file_schemas", "read_drifting", "union_widened", "widened", "wider", "widening_report"]
