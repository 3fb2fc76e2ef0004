"""Sessions kept current straight from a stream of raw events (X1 + X2).

``shard_stream`` reloads the days that changed.  Here events themselves arrive, each once, and
no day is read again: a stateful streaming aggregation keeps the partial state of every
(day, session) and emits, in update mode, the partials that a micro-batch changed.  They are
written as one part of a versioned table per micro-batch, named by its epoch.  Of the parts
that hold a (day, session) the newest counts; sessions are the merge of these partials over
the days, as in the batch mart.

The table's version file is the ledger.  It names the epoch and the streaming query (the
checkpoint) beside the part, so rows and ledger entry become visible in one step.  A replayed
micro-batch finds its epoch, brings its state up to date and changes nothing in the table; one
that died before the version file left rows that nobody reads.  A stream with a new checkpoint
begins its source again, so its first epoch replaces the whole table.

State and watermark: without ``max_delay`` the state keeps every (day, session) for good, and
an event of any age counts.  With it, state of days that lie further behind the newest event
day is dropped, and so are events that come for them: ``StreamRun.late`` counts these (a day's
events of one session and task once); days that must take them belong to ``shard_stream``.
Events without a date would never leave the state: with ``max_delay`` they raise.
Large states ask for the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).

``compact`` folds the parts into one, so that readers do not see old partials again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.operators.flatten import flatten_events
from liftlens.operators.sessions import SESSION_KEYS, merge_partials, session_partials
from liftlens.schema import RAW_EVENT, STAGING
from liftlens.sources.versions import EVERYTHING, current, log, publish, read_table, stage

PART = "part"
EPOCH = "epoch"
BASE = "base"
QUERY = "query="
DAY = "event_day"
PARTIAL_KEYS = ("event_date_key", *SESSION_KEYS)


class StreamRun(NamedTuple):
    """What one run of the stream did."""

    batches: int    # micro-batches that changed the table
    late: int       # partial rows that came after their day had left the state


def read_event_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw events arriving as Parquet files in a folder."""
    reader = spark.readStream.schema(RAW_EVENT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def stream_partials(raw: DataFrame, max_delay: str | None = None) -> DataFrame:
    """The stateful aggregation: partials per (day, session) of a stream of raw events."""
    stg = flatten_events(raw)
    if max_delay is None:
        return session_partials(stg)
    day = F.col("event_date").cast("timestamp")
    dated = stg.withColumn(DAY, F.when(day.isNull(), F.raise_error(F.lit("an event without a date in a stream with max_delay"))
                                       .cast("timestamp")).otherwise(day))
    return session_partials(dated.withWatermark(DAY, max_delay), (DAY,)).drop(DAY)


def _schema(spark: SparkSession) -> T.StructType:
    fields = session_partials(spark.createDataFrame([], STAGING)).schema.fields
    return T.StructType([*fields, T.StructField(EPOCH, T.LongType()), T.StructField(PART, T.StringType())])


def _ledger(spark: SparkSession, root: str) -> tuple[str | None, set[str]]:
    """The streaming query that fills the table and the epochs it has published."""
    entries = log(spark, root) or []
    since = max((e.version for e in entries if e.value == EVERYTHING), default=0)
    values = {e.value for e in entries if e.version >= since}
    query = next((v[len(QUERY):] for v in values if v.startswith(QUERY)), None)
    return query, values


def apply_epoch(batch: DataFrame, epoch: int, query: str, root: str) -> bool:
    """Publish the partials that a micro-batch changed; False where the ledger holds the epoch already."""
    spark = batch.sparkSession
    writer, published = _ledger(spark, root)
    part = f"{epoch:012d}"
    if writer == query and part in published:
        # computed all the same: the state of this epoch is committed by the tasks that run it
        batch.write.format("noop").mode("overwrite").save()
        return False
    load = stage(batch.withColumns({EPOCH: F.lit(epoch).cast("long"), PART: F.lit(part)}), root, PART)
    # a micro-batch without a change is entered as well
    publish(spark, load, [part, QUERY + query], full=writer != query)
    return True


def stream_sessions(raw: DataFrame, root: str, checkpoint: str, max_delay: str | None = None) -> StreamRun:
    """Process the raw events that have arrived on a stream in micro-batches and stop.

    ``root`` holds the partials (``read_sessions``), ``checkpoint`` the state; a run with the
    same checkpoint goes on where the last one stopped.
    """
    applied, late, started = [], {}, []

    def count_late(progress) -> None:
        if progress is not None:
            late[progress["batchId"]] = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])

    def per_batch(batch: DataFrame, epoch: int) -> None:
        # a query remembers its last progress reports only: each is taken while it is there
        for query in started:
            count_late(query.lastProgress)
        # the id is the checkpoint's: it survives restarts
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if apply_epoch(batch, epoch, query, root):
            applied.append(epoch)

    running = (stream_partials(raw, max_delay).writeStream.outputMode("update").foreachBatch(per_batch)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    started.append(running)
    running.awaitTermination()
    for progress in running.recentProgress:
        count_late(progress)
    return StreamRun(len(applied), sum(late.values()))


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    """The newest partial of every (day, session), with the epoch that changed it last.

    Rows are brought together by session, which serves this step and the merge over the days:
    one shuffle.
    """
    held = read_table(spark, root, PART, _schema(spark)).drop(PART).repartition(*SESSION_KEYS)
    state = F.struct(*[c for c in held.columns if c not in PARTIAL_KEYS])
    return held.groupBy(*PARTIAL_KEYS).agg(F.max_by(state, EPOCH).alias("s")).select(*PARTIAL_KEYS, "s.*")


def read_sessions(spark: SparkSession, root: str) -> DataFrame:
    """The sessions as of the last published micro-batch."""
    return merge_partials(read_partials(spark, root))


def compact(spark: SparkSession, root: str) -> int:
    """Fold all parts into one in one step; returns how many it replaced.

    Epochs that are published meanwhile stay; the one that takes the same version number as
    this step fails and is tried again by its stream.
    """
    parts = sorted(current(spark, root) or {})
    if len(parts) < 2:
        return 0
    held = read_table(spark, root, PART, _schema(spark), parts)
    newest = max(p.rsplit("-", 1)[-1] for p in parts)
    state = F.struct(*[c for c in held.columns if c not in (*PARTIAL_KEYS, PART)])
    folded = held.groupBy(*PARTIAL_KEYS).agg(F.max_by(state, EPOCH).alias("s")).select(*PARTIAL_KEYS, "s.*")
    publish(spark, stage(folded.withColumn(PART, F.lit(f"{BASE}-{newest}")), root, PART), parts)
    return len(parts)
