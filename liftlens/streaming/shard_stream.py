"""Daily shards arriving as files, processed with Structured Streaming.

``readStream`` only tells *which* shards changed; those are then read in full as a batch and
their staging partitions replaced.  Overwriting with the micro-batch alone would be wrong
when one day's files arrive in several micro-batches: the later batch would replace the
earlier rows (trap T14).

Shards landed by ``land_shards`` are watched through their version files: one small file per
landing names the days it replaced, after they became visible.  Plain ``shard=`` folders of
another writer are watched through their data files; a day is loaded once per run for all
files that were there, whatever number of micro-batches they are dealt to.

The stream's checkpoint lives below the shared folder, so a restarted query
resumes where it stopped; ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from liftlens.schema import RAW_SHARDS
from liftlens.sources.footers import data_files
from liftlens.sources.shards import load_staging
from liftlens.sources.versions import EVERYTHING, LOG, NULL_VALUE, log


def run_stream(source: DataFrame, per_batch: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Process what is there in micro-batches and stop; returns the number of micro-batches."""
    batches = []

    def counted(batch: DataFrame, epoch_id: int) -> None:
        per_batch(batch, epoch_id)
        batches.append(epoch_id)

    query = (source.writeStream.foreachBatch(counted).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)


def changed_days(spark: SparkSession, raw_root: str, max_files_per_trigger: int | None = None
                 ) -> tuple[DataFrame, Callable[[DataFrame], list[str | None]]]:
    """A stream that sees every change of the raw shards, and a function that names the days of a micro-batch."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if log(spark, raw_root) is not None:
        def named(batch: DataFrame) -> list[str | None]:
            # one row per replaced day
            values = {r.value for r in batch.select("value").distinct().collect()}
            if EVERYTHING in values:
                values |= {e.value for e in log(batch.sparkSession, raw_root)}
            return _sorted({None if v == NULL_VALUE else v for v in values - {EVERYTHING}})
        return reader.schema(LOG).parquet(f"{raw_root}/versions"), named

    seen: dict[str | None, set[str]] = {}

    def held(batch: DataFrame) -> list[str | None]:
        # one row per new file
        files: dict[str | None, set[str]] = {}
        for r in batch.distinct().collect():
            files.setdefault(r.shard, set()).add(_name(r.file_path))
        days = _sorted({d for d, new in files.items() if not new <= seen.get(d, set())})
        for d in days:
            folder = f"{raw_root}/shard={NULL_VALUE if d is None else d}"
            seen[d] = set(map(_name, data_files(batch.sparkSession, folder))) | files[d]
        return days
    return reader.schema(RAW_SHARDS).parquet(raw_root).select("shard", "_metadata.file_path"), held


def _name(path: str) -> str:
    # within a day's folder the name is enough; paths of one file are written in several ways
    return path.rsplit("/", 1)[-1]


def _sorted(days: set[str | None]) -> list[str | None]:
    return sorted(d for d in days if d is not None) + [None] * (None in days)


def stream_shards_to_staging(spark: SparkSession, raw_root: str, stg_root: str, checkpoint: str,
                             max_files_per_trigger: int | None = None,
                             key_range: tuple[int, int] | None = None,
                             rejects_root: str | None = None) -> int:
    """Run the shard stream until all present files are processed; returns micro-batches run.

    Rows outside ``key_range`` are written to ``rejects_root`` (default: beside staging).
    """
    source, days_of = changed_days(spark, raw_root, max_files_per_trigger)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        if days := days_of(batch):
            load_staging(batch.sparkSession, raw_root, stg_root, days=days, key_range=key_range,
                         rejects_root=rejects_root)
    return run_stream(source, per_batch, checkpoint)
