"""The incremental load as a Structured Streaming job (I8).

A file source tracks which input files were already read; each micro-batch
goes through the same reading and the same load as the batch path: width
check, missing tokens, allowed campaigns, day-first dates, rows strictly newer
than the watermark. The trigger is ``availableNow``: process everything
present, then stop — a scheduled incremental run with streaming's file
bookkeeping.

One run reads the watermark once, at its start, and moves it once, at its end.
Every micro-batch is filtered against the start, so neither the order of the
files nor how many of them a micro-batch takes changes what is loaded. Each
micro-batch is an increment of bronze, added by one commit that also holds how far
the stream has come: a micro-batch that is replayed after a failure is found there
and not loaded again. The run's start stays in bronze's state until the run
has ended, so a run that is taken up again after a crash goes on from the same start.

With ``rules="all"`` duplicates (rule 4) are told over all micro-batches and all
earlier loads, by the index of keys that bronze keeps: the first row of a key in
the order of the files counts, however they are batched.

The daily marts use row-based windows (rolling means, ``lag``), which
Structured Streaming does not support; they are recomputed in batch from
bronze after the stream stops.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlens.config import VALID_CAMPAIGN_IDS
from adlens.operators.ingest import BRONZE_SCHEMA, add_increment, read_bronze, read_checkpoint, write_checkpoint
from adlens.session import fresh_dir, read_text
from adlens.sources.raw import CORRUPT, raw_rows, scan_csv
from adlens.sources.testdata import lineitem_to_ad_rows
from adlens.versions import VersionedTable


def _with_run(state: dict, place: str, **run) -> dict:
    return {**state, "runs": {**state.get("runs", {}), place: {**state.get("runs", {}).get(place, {}), **run}}}


def _open_run(spark: SparkSession, place: str, watermark_path: str, bronze_path: str) -> dt.date:
    """The start of the run that did not end, or of a new one."""
    table = VersionedTable(spark, bronze_path)
    base = table.current()
    run = base.state.get("runs", {}).get(place, {})
    if run.get("open"):
        return dt.date.fromisoformat(run["start"])
    start = read_checkpoint(spark, watermark_path, bronze_path)
    table.commit(base, base.folders, BRONZE_SCHEMA, _with_run(base.state, place, open=True, start=start.isoformat(), last=None))
    return start


def stream_incremental_load(spark: SparkSession, stream: DataFrame, bronze_path: str,
                            watermark_path: str, checkpoint_location: str,
                            loaded_at=None, rules: str = "campaign",
                            campaign_ids=VALID_CAMPAIGN_IDS) -> list[dict]:
    """Run the load over every file available now; returns one report per batch."""
    reports: list[dict] = []
    stamp = loaded_at or dt.datetime.now()
    place = checkpoint_location.rstrip("/")
    start = _open_run(spark, place, watermark_path, bronze_path)
    table = VersionedTable(spark, bronze_path)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # the stream's own id: a new stream at the same place counts its batches from 0 again
        stream_id = json.loads(read_text(spark, f"{place}/metadata").splitlines()[0])["id"]
        run = table.current().state["runs"][place]
        if run.get("id") == stream_id and batch_id <= run.get("batch", -1):
            return  # replayed, and its rows are in
        raw = raw_rows(batch) if CORRUPT in batch.columns else batch

        def state_of(state: dict, stats: dict) -> dict:
            dates = [d for d in (state["runs"][place].get("last"), stats["last"] and stats["last"].isoformat()) if d]
            return _with_run(state, place, id=stream_id, batch=batch_id, last=max(dates, default=None))

        stats = add_increment(spark, raw, bronze_path, start, stamp, rules, campaign_ids, state_of)
        reports.append({"batch_id": batch_id, "last_loaded": start, "inserted": stats["n"],
                        "null_ids": stats["null_ids"]})

    query = (stream.writeStream
             .foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    # the latest date over the batches of this run, also those before a crash
    base = table.current()
    last = base.state["runs"][place].get("last")
    state = _with_run(base.state, place, open=False)
    if last:
        state["last"] = max(filter(None, [state.get("last"), last]))
    table.commit(base, base.folders, BRONZE_SCHEMA, state)
    if last:
        write_checkpoint(spark, watermark_path, max(dt.date.fromisoformat(last), read_checkpoint(spark, watermark_path)))
    return reports


def raw_csv_stream(spark: SparkSession, source_dir: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw ad-row CSV files arriving in a folder, read as ``read_raw_csv`` reads them.

    ``max_files_per_trigger`` bounds each micro-batch (a large backlog is then
    loaded in several batches instead of one); the rows loaded are the same.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return scan_csv(reader, source_dir)


def stream_load_testdata(spark: SparkSession, sf_dir: str,
                         to_raw: Callable[[DataFrame], DataFrame] = lineitem_to_ad_rows
                         ) -> DataFrame:
    """Stream the ``lineitem`` file as raw ad rows into a fresh bronze; read it back.

    Folders are new sub-folders of the shared work folder
    (``spark.checkpoint.dir``). ``loaded_at`` is left out of the result.
    """
    root = fresh_dir(spark, "stream-load")
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").schema
    source = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/lineitem*.parquet")
    stream_incremental_load(spark, to_raw(source), f"{root}/bronze",
                            f"{root}/watermark", f"{root}/checkpoint")
    return read_bronze(spark, f"{root}/bronze").drop("loaded_at")
