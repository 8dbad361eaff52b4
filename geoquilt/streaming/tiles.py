"""Tiles that arrive one after the other: ingest into a written pyramid, and progress."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from geoquilt.sources.pyramid import valid_addresses

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
KEY = ["zoom_level", "tile_column", "tile_row"]
TILES = "zoom_level int, tile_column int, tile_row int, event_id long, value double"


def read_stream(spark: SparkSession, folder: str, names: str = "*.parquet") -> DataFrame:
    """The events of the files of a growing folder as tiles, with their time as one that a watermark can be on."""
    e = spark.readStream.schema(EVENTS).option("pathGlobFilter", names).parquet(folder)
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.lit(3) + F.col("user_id") % 3).cast("int").alias("zoom_level"), (F.col("event_id") % 8).cast("int").alias("tile_column"), (F.col("user_id") % 8).cast("int").alias("tile_row"), "value")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The tiles written so far."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(f"{TILES}, batch long").parquet(path).drop("batch")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType.fromDDL(TILES))


def first_tile(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The tile with the smallest event of an address that has none yet; the state tells the event of one that has."""
    best = None
    for pdf in rows:
        if not state.exists and len(pdf):
            one = pdf.loc[pdf["event_id"].idxmin(), ["event_id", "value"]]
            if best is None or one["event_id"] < best["event_id"]:
                best = one
    if best is not None:
        state.update((int(best["event_id"]),))
        yield pd.DataFrame([(*map(int, key), int(best["event_id"]), float(best["value"]))], columns=[*KEY, "event_id", "value"])


def commit_batch(batch: DataFrame, number: int, path: str) -> None:
    """Write a batch to a folder of its own number; the same batch again replaces it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def ingest(tiles: DataFrame, levels: DataFrame, path: str, checkpoint: str | None = None):
    """Start the ingest of a stream of tiles, whose addresses lie in their level's matrix; returns the query.

    The first batch with a tile of an address stores it, the one of its smallest event. Addresses that have a tile are keyed
    state of the stream, without a watermark, so however late an event comes it is met right, and a batch reads no stored
    tile. A batch that is run again after a failure replaces what it wrote. The stream's offsets and state belong to the
    pyramid: by default they are beside it, and a pyramid is continued with the ones that it was begun with. Null tiles are
    left out."""
    first = valid_addresses(tiles, levels).filter("value IS NOT NULL").select(*KEY, "event_id", "value")
    first = first.groupBy(*KEY).applyInPandasWithState(first_tile, TILES, "event_id long", "append", GroupStateTimeout.NoTimeout)
    write = lambda batch, number: commit_batch(batch, number, path)
    return first.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint or f"{path}-state").trigger(availableNow=True).start()


def progress(spark: SparkSession, stored_tiles: str, totals: DataFrame, path: str, checkpoint: str):
    """Start the count of tiles written per level beside the level's number of tiles; each batch replaces the report.

    The stream is the written pyramid itself, where every address stands once, so a count never exceeds its total; a
    batch reads the files that are new, and the state is a row for each level."""
    counts = spark.readStream.schema(f"{TILES}, batch long").parquet(stored_tiles).groupBy("zoom_level").agg(F.count(F.lit(1)).alias("written"))
    report = lambda batch, _: batch.join(F.broadcast(totals), "zoom_level").write.mode("overwrite").parquet(path)  # noqa: E731  a row for each level
    return counts.writeStream.outputMode("complete").foreachBatch(report).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
