"""Tables that readers can always read: written aside, audited, published.

A published table is a folder of data folders that never change and one
manifest per version. The manifest names the data folders of every slice (a
report date, a hash bucket, a batch). A writer writes new data folders aside,
checks them, and publishes a manifest that differs from the last one in the
slices it replaced; the manifest appears under its name by a rename that
fails if another writer was faster. Readers take the newest manifest, so they
see all of a write or nothing of it, and go on with the folders they have
while newer versions appear. A killed writer leaves data that no manifest
names. The last ``keep`` versions stay readable.

Merging reads and rewrites the touched slices alone. Streams are
replay-safe: a version records, per writer, the last batch it holds.

The rename must be atomic, as on HDFS and local file systems.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP = 20                        # versions that stay readable
ORPHAN_MS = 24 * 3600 * 1000     # age at which data of killed writers goes
FILE_BYTES = 128 << 20
RETRIES = 20
SLICE = "_slice"
SEQ = "_seq"                     # version that wrote a row of a log
DELTA = "delta-"


class Conflict(RuntimeError):
    """Another writer published first."""


class AuditFailed(ValueError):
    """What was written aside failed its checks; nothing was published."""


class Published:
    def __init__(self, spark: SparkSession, path: str, keep: int = KEEP):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._Path(self.path).toUri(), spark._jsc.hadoopConfiguration())

    # --- manifests -----------------------------------------------------------

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """(name, modification time) of what a folder holds."""
        at = self._Path(f"{self.path}/{folder}")
        if not self._fs.exists(at):
            return []
        return [(x.getPath().getName(), x.getModificationTime()) for x in self._fs.listStatus(at)]

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n, _ in self._names("_versions") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version (default: the newest); of a table that
        nothing was published to yet, an empty one of version 0."""
        for _ in range(RETRIES):
            known = self.versions()
            if version is None and not known:
                return {"version": 0, "schema": None, "slices": {}, "writers": {}, "meta": {}}
            try:
                n = known[-1] if version is None else version
                stream = self._fs.open(self._Path(f"{self.path}/_versions/{n:012d}.json"))
            except Exception:
                if version is not None or self.versions() == known:
                    raise
                continue     # went while we looked: a newer one is there
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            return json.loads(text)
        raise Conflict(f"{self.path}: versions change faster than they can be read")

    def publish(self, base: dict, slices: dict[str, list[str] | None], schema: T.StructType,
                writer: str | None = None, batch_id: int | None = None, meta: dict | None = None) -> dict:
        """Publish ``base`` with the given slices replaced (None: gone).
        Raises ``Conflict`` if ``base`` is not the newest version."""
        new = {"version": base["version"] + 1, "schema": schema.jsonValue(), "writers": dict(base["writers"]),
               "meta": {**base["meta"], **(meta or {})},
               "slices": {k: v for k, v in {**base["slices"], **slices}.items() if v}}
        if writer is not None:
            new["writers"][writer] = batch_id
        jvm = self.spark._jvm
        aside = self._Path(f"{self.path}/_versions/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(new).encode()))
        finally:
            out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        name = self._Path(f"{self.path}/_versions/{new['version']:012d}.json")
        try:
            self._context.rename(aside, name, none)
        except Exception as error:
            self._fs.delete(aside, False)
            if self._fs.exists(name):
                raise Conflict(f"{self.path}: version {new['version']} was published by another writer") from error
            raise
        self._forget(new)
        return new

    def _forget(self, new: dict) -> None:
        """Drop versions beyond ``keep`` with the data only they name, and old
        data that no version names."""
        known = self.versions()
        old, kept = known[:-self.keep], known[-self.keep:]
        if not old:
            return
        held = [self._folders(n) for n in kept]
        if None in held:
            return    # other writers have gone on and forget for us
        named = set().union(*held)
        roots = {f.split("/")[1] for f in named}
        for n in old:
            for folder in (self._folders(n) or set()) - named:
                root = folder.split("/")[1]
                self._fs.delete(self._Path(f"{self.path}/{folder if root in roots else f'data/{root}'}"), True)
            self._fs.delete(self._Path(f"{self.path}/_versions/{n:012d}.json"), False)
        before = time.time() * 1000 - ORPHAN_MS
        for name, at in self._names("data"):
            if name not in roots and at < before:
                self._fs.delete(self._Path(f"{self.path}/data/{name}"), True)

    def _folders(self, version: int) -> set[str] | None:
        """The data folders of a version; None if another writer, who forgets
        old versions too, was faster."""
        try:
            return {f for s in self.manifest(version)["slices"].values() for f in s}
        except Exception:
            if version in self.versions():
                raise
            return None

    # --- data ----------------------------------------------------------------

    def read(self, slices: Callable[[str], bool] | None = None, manifest: dict | None = None,
             schema: T.StructType | None = None) -> DataFrame:
        """The rows of the newest version (or of ``manifest``), of the slices
        whose name passes; other slices' files are neither listed nor read."""
        m = manifest or self.manifest()
        schema = T.StructType.fromJson(m["schema"]) if m["schema"] else schema
        if schema is None:
            raise FileNotFoundError(f"nothing was published to {self.path}")
        folders = [f"{self.path}/{f}" for s, fs in sorted(m["slices"].items()) if slices is None or slices(s) for f in fs]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders)

    def write_aside(self, df: DataFrame, slice_of) -> dict[str, list[str]]:
        """Write ``df`` to new data folders, one for each value of the
        expression ``slice_of``; slice name -> folders."""
        root = f"data/{uuid.uuid4().hex}"
        named = df.withColumn(SLICE, slice_of.cast("string"))
        named.write.partitionBy(SLICE).parquet(f"{self.path}/{root}")
        return {n.split("=", 1)[1]: [f"{root}/{n}"] for n, _ in self._names(root) if n.startswith(f"{SLICE}=")}

    # --- writes --------------------------------------------------------------

    def upsert(self, new: DataFrame, keys: list[str], slice_of, order: list[str] | None = None,
               writer: str | None = None, batch_id: int | None = None, meta: dict | None = None,
               merged: dict[str, int] | None = None) -> dict:
        """Merge rows by key: a new row replaces the stored row of its key,
        other keys stay. With ``order`` the row that is greatest in those
        columns stays. Only slices that ``new`` has rows of are read and
        rewritten. A key given twice fails the audit of what was written and
        publishes nothing. A batch that the table already holds is skipped;
        if another writer publishes first the merge is done anew."""
        for _ in range(RETRIES):
            base = self.manifest()
            if writer is not None and base["writers"].get(writer, -1) >= batch_id:
                return base
            touched = {r[0] for r in new.select(slice_of.cast("string")).distinct().collect()}
            both = new
            if touched & set(base["slices"]):
                stored = self.read(touched.__contains__, base).select(*new.columns)
                if order is None:
                    both = stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
                else:
                    both = stored.unionByName(new)
            if order is not None:
                rest = [c for c in new.columns if c not in keys]
                both = (both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
                          .select(*keys, "_r.*").select(*new.columns))
            aside = self.write_aside(both, slice_of)
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in new.schema.fields])
            if order is None:
                self.audit(aside, schema, keys)
            try:
                return self.publish({**base, "writers": {**base["writers"], **(merged or {})}},
                                    {**dict.fromkeys(touched), **aside}, schema, writer, batch_id, meta)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: other writers were faster {RETRIES} times")

    def audit(self, aside: dict[str, list[str]], schema: T.StructType, keys: list[str]) -> None:
        """Fail if what was written aside holds a key twice."""
        written = self.read(manifest={"schema": schema.jsonValue(), "slices": aside})
        twice = written.groupBy(*keys).count().filter("count > 1").limit(3).collect()
        if twice:
            raise AuditFailed(f"{self.path}: keys {keys} occur more than once, such as {[tuple(r) for r in twice]}")

    def replace(self, df: DataFrame, slice_of, keys: list[str] | None = None, gone: Iterable[str] = ()) -> dict:
        """Replace whole slices: those ``df`` has rows of, and ``gone``, which
        end empty if it has none. ``keys`` are audited."""
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        aside = self.write_aside(df, slice_of)
        if keys:
            self.audit(aside, schema, keys)
        for _ in range(RETRIES):
            try:
                return self.publish(self.manifest(), {**dict.fromkeys(gone), **aside}, schema)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: other writers were faster {RETRIES} times")

    def append(self, df: DataFrame, writer: str, batch_id: int, meta: dict | None = None) -> dict:
        """Add a batch's rows as a slice of their own (a delta of a log), with
        the version that wrote them. A batch that the table holds is skipped."""
        for _ in range(RETRIES):
            base = self.manifest()
            if base["writers"].get(writer, -1) >= batch_id:
                return base
            rows = df.withColumn(SEQ, F.lit(base["version"] + 1).cast("long"))
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
            aside = self.write_aside(rows, F.lit(f"{DELTA}{base['version'] + 1}"))
            try:
                return self.publish(base, aside, schema, writer, batch_id, meta)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: other writers were faster {RETRIES} times")

    def deltas(self, manifest: dict) -> list[str]:
        return [s for s in manifest["slices"] if s.startswith(DELTA)]

    def newest(self, keys: list[str], slices: Callable[[str], bool] | None = None,
               manifest: dict | None = None) -> DataFrame:
        """A log's last row of every key."""
        log = self.read(slices, manifest)
        rest = [c for c in log.columns if c not in keys and c != SEQ]
        return (log.groupBy(*keys).agg(F.max_by(F.struct(*rest, SEQ), SEQ).alias("_r")).select(*keys, "_r.*")
                .select(*[c for c in log.columns if c != SEQ], SEQ))

    def fold(self, slice_of, keys: list[str] | None = None, least: int = 1) -> dict:
        """Once a log has ``least`` deltas, merge them into the slices they
        touch (with ``keys``: the last row of every key stays), so that
        readers and later folds meet a bounded number of deltas."""
        for _ in range(RETRIES):
            base = self.manifest()
            deltas = set(self.deltas(base))
            if len(deltas) < least:
                return base
            fresh = self.read(deltas.__contains__, base)
            touched = {r[0] for r in fresh.select(slice_of.cast("string")).distinct().collect()}
            both = (touched | deltas).__contains__
            rows = self.newest(keys, both, base) if keys else self.read(both, base)
            aside = self.write_aside(rows, slice_of)
            try:
                return self.publish(base, {**dict.fromkeys(deltas | touched), **aside},
                                    T.StructType.fromJson(base["schema"]))
            except Conflict:
                continue
        raise Conflict(f"{self.path}: other writers were faster {RETRIES} times")

    def compact(self, slices: Callable[[str], bool], file_bytes: int = FILE_BYTES) -> list[str]:
        """Rewrite slices that have more files than their size needs, as about
        size / ``file_bytes`` files each; the slices rewritten. One slice is
        published at a time, and only while nobody else has changed it."""
        done = []
        for name in sorted(filter(slices, self.manifest()["slices"])):
            for _ in range(RETRIES):
                base = self.manifest()
                folders = base["slices"].get(name)
                if not folders:
                    break
                files = [s for f in folders for s in self._sizes(f"{self.path}/{f}")]
                wanted = max(1, -(-sum(files) // file_bytes))
                if len(files) <= wanted:
                    break
                schema = T.StructType.fromJson(base["schema"])
                rows = self.read(name.__eq__, base).repartition(wanted)
                aside = self.write_aside(rows, F.lit(name))
                try:
                    self.publish(base, aside, schema)
                    done.append(name)
                    break
                except Conflict:
                    continue
        return done

    def _sizes(self, folder: str) -> list[int]:
        out, files = [], self._fs.listFiles(self._Path(folder), True)
        while files.hasNext():
            f = files.next()
            if f.getPath().getName().startswith("part-"):
                out.append(f.getLen())
        return out
