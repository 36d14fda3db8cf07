"""Incremental runs driven by newly landed payment files.

A Structured Streaming file source watches the landing folder; its
checkpoint remembers which files were already seen, so each file triggers
work once, across restarts. The stream carries only the files' month folders
(no file is opened for that); the months are noted under the checkpoint, and
every noted month is then rebuilt once with the batch jobs (Bronze, Silver and
the month-partitioned Gold pre-aggregate by partition overwrite), after which
Gold is rolled up once. A note is removed when its month is done, so a run that
dies in between is made up for by the next one. Rebuilding whole months keeps
a retried batch idempotent and stays correct when one month's files arrive in
several batches.

``run_available`` processes what has landed, then stops: however many
micro-batches the files took, each month is rebuilt once. ``start_incremental``
with a processing-time trigger runs as a service and rebuilds after each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans import pipeline as P
from ledgerline.settings import Layout, checkpoint_dir
from ledgerline.sinks.tables import _fs, child_dirs, delete_path
from ledgerline.sources import raw_csv as R

FILE_SCHEMA = f"path string, modificationTime timestamp, length long, content binary, {R.PERIOD_DIR} int"


def landed_months(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame with the month of every newly landed file. The content
    column is not selected, so no file is read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing).select(R.PERIOD_DIR)


def _checkpoint(spark: SparkSession, layout: Layout, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-stream/{layout.dataset}"


def _note(spark: SparkSession, checkpoint: str, batch: DataFrame) -> None:
    # One row per month present in the batch (bounded by the calendar).
    for (month,) in batch.distinct().collect():
        if month is not None:
            fs, p = _fs(spark, f"{checkpoint}/months/{int(month)}")
            fs.mkdirs(p)


def rebuild_noted(spark: SparkSession, layout: Layout, checkpoint: str, **run_options) -> dict | None:
    """Run the layers for every noted month, then forget the notes."""
    noted = sorted(int(m) for m in child_dirs(spark, f"{checkpoint}/months") if m.isdigit())
    if not noted:
        return None
    result = P.run(spark, layout, [(m // 100, m % 100) for m in noted], **run_options)
    for m in noted:
        delete_path(spark, f"{checkpoint}/months/{m}")
    return result


def start_incremental(
    spark: SparkSession,
    layout: Layout,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    rebuild: bool = True,
    **run_options,
) -> StreamingQuery:
    """Start the file-driven pipeline; returns the running query.

    ``checkpoint`` defaults to a folder under the session's shared
    checkpoint folder; keep it stable between runs so files are not
    processed twice. ``run_options`` go to ``pipeline.run`` (layers, file_hash,
    multi_line, rebalance, jdbc, ...). ``rebuild=False`` only notes the months.
    """
    ckpt = _checkpoint(spark, layout, checkpoint)

    def process(batch: DataFrame, batch_id: int) -> None:
        _note(spark, ckpt, batch)
        if rebuild:
            rebuild_noted(spark, layout, ckpt, **run_options)

    writer = (
        landed_months(spark, layout.landing, max_files_per_trigger)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", ckpt)
        .queryName(f"ledgerline_landing_{layout.dataset}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(
    spark: SparkSession,
    layout: Layout,
    *,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    **run_options,
) -> dict | None:
    """Process everything landed since the last run, then return the run's result (None without new files)."""
    q = start_incremental(
        spark, layout, checkpoint=checkpoint, max_files_per_trigger=max_files_per_trigger, rebuild=False
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return rebuild_noted(spark, layout, _checkpoint(spark, layout, checkpoint), **run_options)
