"""Closed days of a streamed table, rewritten as a few large files.

A ``foreachBatch`` sink stores a partition (event_date, writer, batch_id) per
micro-batch. ``archive_days`` packs the partitions of closed days into a
published table, a slice per day, whose manifest lists what each slice
replaces; publishing it is the swap. ``read_archived`` takes archived days
from there and everything else, also batches that came late for an archived
day, from the partitions that no manifest lists. ``drop_archived`` deletes
listed partitions once no reader of the old form can be left.
"""

from __future__ import annotations

import datetime as dt
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sinks.published import FILE_BYTES, Published

DAY = "event_date"
LAYOUT = (DAY, "writer", "batch_id")
GRACE_S = 24 * 3600


def stored_batches(spark: SparkSession, path: str) -> dict[tuple[str, str, int], str]:
    """(day, writer, batch) -> folder of every partition of a streamed table,
    from folder names alone."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    level = [((), path.rstrip("/"))]
    for column in LAYOUT:
        below = []
        for values, folder in level:
            at = jvm.org.apache.hadoop.fs.Path(folder)
            names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
            below += [((*values, n.split("=", 1)[1]), f"{folder}/{n}") for n in names if n.startswith(f"{column}=")]
        level = below
    return {(day, writer, int(batch)): folder for (day, writer, batch), folder in level}


def read_batches(spark: SparkSession, path: str, folders: list[str], schema=None) -> DataFrame:
    """The rows of some partitions of a streamed table; other folders are not
    listed. ``schema`` is what an empty list gives."""
    if not folders:
        return spark.createDataFrame([], schema or spark.read.parquet(path).schema)
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(*folders)


def _ranges(numbers) -> list[list[int]]:
    """Sorted numbers as [first, last] stretches."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and out[-1][1] + 1 == n:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def _listed(meta: dict, day: str, writer: str, batch: int) -> bool:
    held = meta.get(f"batches/{day}", {}).get(writer, [])
    return any(first <= batch <= last for first, last in held)


def archive_days(spark: SparkSession, live: str, archive: str, before: dt.date,
                 file_bytes: int = FILE_BYTES) -> list[str]:
    """Pack the batches of days before ``before`` that the archive does not
    hold yet, a day at a time: about size / ``file_bytes`` files a day. The
    days packed."""
    table, done = Published(spark, archive), []
    stored = stored_batches(spark, live)
    by_day = defaultdict(list)
    for (day, writer, batch), folder in stored.items():
        if day < before.isoformat():
            by_day[day].append((writer, batch, folder))
    for day in sorted(by_day):
        base = table.manifest()
        fresh = [x for x in by_day[day] if not _listed(base["meta"], day, x[0], x[1])]
        if not fresh:
            continue
        rows = read_batches(spark, live, [f for *_, f in fresh])
        rows = rows.withColumn(DAY, F.col(DAY).cast("date")).withColumn("batch_id", F.col("batch_id").cast("long"))
        old = base["slices"].get(day)
        size = sum(sum(table._sizes(f)) for *_, f in fresh)
        if old:
            rows = table.read(day.__eq__, base).unionByName(rows)
            size += sum(s for f in old for s in table._sizes(f"{archive}/{f}"))
        aside = table.write_aside(rows.repartition(max(1, -(-size // file_bytes))), F.lit(day))
        held = base["meta"].get(f"batches/{day}", {})
        batches = {w: [n for a, b in r for n in range(a, b + 1)] for w, r in held.items()}
        for writer, batch, _ in fresh:
            batches.setdefault(writer, []).append(batch)
        # Raises if another archiver published meanwhile: its day may be ours.
        table.publish(base, aside, rows.schema, meta={
            f"batches/{day}": {w: _ranges(n) for w, n in batches.items()}, f"packed_at/{day}": time.time()})
        done.append(day)
    return done


def read_archived(spark: SparkSession, live: str, archive: str) -> DataFrame:
    """Every stored row once: archived days from the archive, all batches that
    it does not list from the streamed table."""
    table = Published(spark, archive)
    m = table.manifest()
    rest = [f for (day, w, b), f in stored_batches(spark, live).items() if not _listed(m["meta"], day, w, b)]
    if not m["version"]:
        return read_batches(spark, live, rest)
    packed = table.read(manifest=m)
    if not rest:
        return packed
    return packed.unionByName(read_batches(spark, live, rest).withColumn(DAY, F.col(DAY).cast("date"))
                              .withColumn("batch_id", F.col("batch_id").cast("long")))


def drop_archived(spark: SparkSession, live: str, archive: str, grace_s: float = GRACE_S) -> int:
    """Delete the partitions of days packed ``grace_s`` seconds ago or longer
    that the archive lists; how many."""
    meta, gone = Published(spark, archive).manifest()["meta"], 0
    conf = spark._jsc.hadoopConfiguration()
    for (day, writer, batch), folder in stored_batches(spark, live).items():
        if _listed(meta, day, writer, batch) and meta[f"packed_at/{day}"] <= time.time() - grace_s:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            gone += bool(at.getFileSystem(conf).delete(at, True))
    return gone
