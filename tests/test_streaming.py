"""Ingest of tiles by keyed state: batches read nothing stored, and may be run again."""

import os
import shutil

from pyspark.sql import functions as F

from geoquilt.streaming import tiles as st

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def drop_file(spark, folder, name, rows):
    """A file of events (event_id, user_id, value); the address is (3 + user % 3, event % 8, user % 8)."""
    df = spark.createDataFrame([(e, None, u, "t", v, None) for e, u, v in rows], EVENTS).coalesce(1)
    df.write.parquet(str(folder / f"_{name}"))
    part = next(p for p in os.listdir(folder / f"_{name}") if p.startswith("part"))
    os.makedirs(folder / "in", exist_ok=True)
    shutil.move(str(folder / f"_{name}" / part), str(folder / "in" / f"{name}.parquet"))


def test_batches_and_replays(spark, tmp_path):
    levels = spark.createDataFrame([(z, 8, 8) for z in (3, 4, 5)], "zoom_level int, matrix_width int, matrix_height int")
    path = str(tmp_path / "tiles")
    run = lambda: st.ingest(st.read_stream(spark, str(tmp_path / "in")), levels, path).awaitTermination()
    kept = lambda: sorted((r.zoom_level, r.tile_column, r.tile_row, r.event_id, r.value) for r in st.stored(spark, path).collect())
    assert st.stored(spark, path).count() == 0
    drop_file(spark, tmp_path, "a", [(17, 0, 1.0), (9, 0, 2.0), (9, 0, 2.0), (2, 1, None), (4, 9, 4.0)])
    run()
    first = [(3, 1, 0, 9, 2.0), (3, 4, 1, 4, 4.0)]
    assert kept() == first
    run()
    assert kept() == first
    # a batch that failed after its files were written is run again: its folder is replaced, and the state is the one before
    commits = tmp_path / "tiles-state" / "commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.remove(commits / str(last))
    (commits / f".{last}.crc").unlink(missing_ok=True)
    run()
    assert kept() == first
    # later batches know what is stored without reading it: it isn't there now
    shutil.move(path, path + "-away")
    drop_file(spark, tmp_path, "b", [(1, 0, 7.0), (2, 1, 8.0), (12, 9, 9.0)])
    run()
    assert kept() == [(4, 2, 1, 2, 8.0)]
    for folder in os.listdir(path + "-away"):
        if folder.startswith("batch="):
            shutil.move(f"{path}-away/{folder}", f"{path}/{folder}")
    assert kept() == sorted([*first, (4, 2, 1, 2, 8.0)])
    assert st.stored(spark, path).groupBy(*st.KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count() == 0
