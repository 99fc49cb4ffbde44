"""Helpers the operators share: written tables, hashing, components."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import checkpoint_root


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/roadpulse-llm/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._llm_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_mod5(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: int) -> DataFrame:
    """(doc_id, fold, text, label) of about ``most`` labelled training
    documents, chosen by a hash of doc_id; held-out ones never."""
    known = (labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (id_mod5() != 0))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    share = most / max(1, known.count())
    if share < 1:
        place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30))
        known = known.filter(place < int(share * (1 << 30)))
    # At most about ``most`` rows of two numbers: small enough to broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), F.lit(2)).cast("int")
    return materialize(rows.select("doc_id", fold.alias("fold"), "text", "label"))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to ``room`` words."""

    def __init__(self, room: int = 300_000):
        super().__init__()
        self.room = room

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.room:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (fewer words: of all of
    them as one run; none: empty)."""
    n = len(h)
    if n == 0:
        return h
    size = min(n, k)
    out = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + len(out)]
    return mix64(out)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node id reachable over the links.

    Alternating large-star and small-star rounds (Kiveris et al. 2014), each
    a pair of aggregations and joins; every round is written out, so nothing
    is collected and the lineage stays short. Nodes without links to others
    are not returned.
    """
    e = materialize(edges.filter(F.col(a) != F.col(b))
                    .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").unionByName(least.withColumnRenamed("m", "v")).distinct())
        new = materialize(small)
        state = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(e)
        e = new
        if state == before:
            break
        before = state
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = members.unionByName(roots)
    out._llm_path = e._llm_path   # what ``discard`` deletes
    return out
