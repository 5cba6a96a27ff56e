"""Streaming keep-first by a declared order: the first row of each key, whenever it arrives.

The state of a key is the row that is first so far, one row however many arrive.
A key's rows in a batch are compared with it, and only a row that comes before
it is emitted, as an update of the key. After any batch, the last update of each
key is what the batch ``keep_first`` gives for all rows read so far, in whatever
order they came. Null keys and values are kept as they are; nulls come first in
the order, as in a batch sort, and rows equal in the whole order are one.

With an event time, a key's state is dropped by a timer once the watermark has
passed its latest row; a row that comes later starts anew. Rows without an
event time are left out then.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.utils import AnalysisException

from ..operators.dedup import keep_first
from ..session import SESSION_DEFAULTS
from ..sources.jsonl import missing_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# whole microseconds, which JSON texts of timestamps leave out by default
ROW_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def sort_values(df: DataFrame, column: str) -> list[Column]:
    """Two columns without nulls that sort together as the column does: nulls first, NaN last."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        value = F.unix_date(c).cast("long")
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        value = c.cast("long")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.nanvl(c.cast("double"), F.lit(0.0))
    elif isinstance(kind, (T.StringType, T.DecimalType)):
        value = c
    else:
        raise TypeError(f"no order for {column}: {kind.simpleString()}")
    level = F.when(c.isNull(), 0)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        level = level.when(F.isnan(c), 2)
    zero = F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind if isinstance(kind, T.DecimalType) else "double" if isinstance(
        kind, (T.FloatType, T.DoubleType)) else "long")
    return [level.otherwise(1).cast("long"), F.coalesce(value, zero)]


class FirstRow(StatefulProcessor):
    """Emits a row when it comes before all rows of its key so far. Rows travel as JSON text beside their order."""

    def __init__(self, state: str, timed: bool):
        self.state, self.timed = state, timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", self.state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        best, due = None, 0
        for part in rows:  # columns by place: key, event time and its ms where there is one, order, row
            columns = [part[c].tolist() for c in part.columns[1:]]
            if self.timed:
                due = max(due, max(columns[1]) + 1)
                columns = columns[2:]
            best = min([*zip(*columns, strict=True), *([best] if best else [])], key=lambda r: r[:-1])
        held = tuple(self.first.get()) if self.first.exists() else None
        if best and (held is None or best[:-1] < held[:-1]):
            self.first.update(best)
            yield pd.DataFrame({"row": [best[-1]]})
        if self.timed and due:
            for t in list(self.handle.listTimers()):
                due = max(due, t)
                self.handle.deleteTimer(t)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.first.clear()
        return iter([])

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, keys: Sequence[str], order: Sequence[str], event_time: str | None = None,
               delay: str = "1 day") -> DataFrame:
    """A stream of updates: the columns of ``stream``, a row whenever its key's first one changes."""
    ranks = [c.alias(f"o{i}_{j}") for i, name in enumerate(order) for j, c in enumerate(sort_values(stream, name))]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), ROW_JSON).alias("row")
    timed = []
    if event_time:
        at = F.col(f"`{event_time}`").cast("timestamp")
        timed = [at.alias("at"), F.unix_millis(at).alias("at_ms")]
    # one text that is never null: the Python worker finds a group's rows by the key's value
    key = F.to_json(F.struct(*[F.col(f"`{c}`") for c in keys]), ROW_JSON).alias("key")
    packed = stream.select(key, *timed, *ranks, row)
    if event_time:
        packed = packed.filter("at is not null").withWatermark("at", delay)
    state = ", ".join(f"{c} {packed.schema[c].dataType.simpleString()}" for c in packed.columns[1 + len(timed):])
    updates = packed.groupBy("key").transformWithStateInPandas(
        statefulProcessor=FirstRow(state, bool(event_time)), outputStructType="row string",
        outputMode="Update", timeMode="EventTime" if event_time else "None")
    return updates.select(F.from_json("row", stream.schema, ROW_JSON).alias("r")).select("r.*")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """A query started inside keeps its state in RocksDB, the only store that holds ``transformWithState``'s.

    A query copies the session's settings when it starts; the session's own is put back for other queries.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, SESSION_DEFAULTS[STATE_STORE])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def stream_keep_first(spark: SparkSession, src: str, schema: str, keys: Sequence[str], order: Sequence[str], root: str,
                      event_time: str | None = None, delay: str = "1 day", max_files_per_trigger: int | None = None) -> DataFrame:
    """The first row of each key of the JSON-lines files under ``src``, up to what is landed; resumes where it stopped.

    Updates go to a folder per batch, which a replayed batch replaces; the newest of a key is its first
    row, and being first it also comes first among the key's updates.
    """
    out, offsets = f"{root}/updates", f"{root}/_offsets"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = (first_rows(reader.json(src), keys, order, event_time, delay).writeStream.foreachBatch(write_batch)
              .outputMode("update").option("checkpointLocation", offsets).trigger(availableNow=True))
    with rocksdb_state(spark):
        query = writer.start()
    query.awaitTermination()
    kind = T.StructType.fromDDL(schema)
    try:
        updates = spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(out)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], kind)
    return keep_first(updates, list(keys), list(order))
