"""A uniform shuffle into shards of exact sizes, by a communication matrix.

How many rows each partition sends to each shard is drawn first: the matrix
whose rows sum to the partitions' counts and whose columns sum to the shards'
sizes, from the multivariate hypergeometric law that a uniform permutation of
all rows would give it. Every partition then permutes its own rows over the
shards, the rows are exchanged, and every shard is permuted again (Gustedt
2008). The result is a uniformly random permutation, and no shard's size is
left to chance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import materialize, mix64
from roadpulse.llm.registry import query, table

SHARDS = 8
SEED = 20_240_115
BUCKET_ROWS = 10_000         # rows of a shard permuted in one window, about
EXACT_BELOW = 1_000_000_000  # numpy draws hypergeometric numbers below this population
PLACE_BITS = 33              # monotonically_increasing_id: partition << 33, then the row's place


def drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn without replacement from ``good + bad``
    are good ones. For populations beyond numpy's range: every row is taken
    with probability n / population, and rows drawn from the rest (or put
    back from those taken) make up the difference, which leaves all sets of
    ``n`` rows equally likely."""
    total = good + bad
    if n > total - n:
        return good - drawn(rng, good, bad, total - n)
    if total < EXACT_BELOW or not n:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    if n < 16:
        taken = 0
        for k in range(n):
            taken += int(rng.integers(total - k)) < good - taken
        return taken
    p = n / total
    x, y = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
    if x + y <= n:
        return x + drawn(rng, good - x, bad - y, n - x - y)
    return x - drawn(rng, x, y, x + y - n)


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows that each partition (``counts``) sends to each shard (``sizes``)
    under a uniform permutation of all rows."""
    if sum(counts) != sum(sizes):
        raise ValueError("partitions and shards hold different numbers of rows")
    rng = np.random.default_rng([seed, 0])
    room = list(sizes)
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for p, n in enumerate(counts):
        rest = sum(room)
        for k in range(len(room)):
            if not n:
                break
            rest -= room[k]
            out[p, k] = take = drawn(rng, room[k], rest, n)
            room[k] -= take
            n -= take
    return out


def _dealt(matrix: np.ndarray, seed: int):
    """The local permutation: the rows of a partition, by their place in it,
    get the shards of its row of the matrix in random order; and a random
    key each. The last column is (partition << 33) + place."""
    def run(batches):
        permuted: dict[int, np.ndarray] = {}

        def of(part: int) -> np.ndarray:
            if part not in permuted:
                permuted.clear()
                mine = np.repeat(np.arange(matrix.shape[1], dtype=np.int32), matrix[part])
                permuted[part] = np.random.default_rng([seed, 1, part]).permutation(mine)
            return permuted[part]

        for batch in batches:
            place = batch.column(batch.num_columns - 1).to_numpy()
            shard = np.zeros(len(place), np.int32)
            parts = place >> PLACE_BITS
            for part in np.unique(parts):
                here = parts == part
                shard[here] = of(int(part))[place[here] & ((1 << PLACE_BITS) - 1)]
            key = mix64(mix64(place.astype(np.uint64)) + np.uint64(seed)) >> np.uint64(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shard), pa.array(key.astype(np.int64))],
                                             [*batch.schema.names[:-1], "s", "key"])
    return run


def shuffled_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS,
                    shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: a uniformly random permutation of
    all rows, cut into ``shards`` shards whose sizes are at most one apart;
    ``slot`` is a row's place in its shard, gapless from 0.

    The input is written to the shared folder once, every row with its
    partition and its place there, so that counting and dealing see the same
    rows however the table is split when it is read, also after a lost
    executor. The driver sees one count per partition and draws the matrix
    (partitions x shards), which goes to the tasks. In a shard rows carry
    random keys; keys fall into buckets of about ``bucket_rows`` rows, and a
    window numbers a bucket's rows from where the bucket starts. So no shard
    meets in one task, a hot value of any column is dealt like all others, and
    a task permutes the places of one partition and the rows of one bucket at
    a time. Equal rows are dealt apart like any others.

    The same ``seed``, input files and partitions give the same permutation.
    Columns may hold nulls and any names; one named like ``shard`` or
    ``slot`` is replaced. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    kept = [c for c in rows.columns if c.lower() not in (shard.lower(), slot.lower())]
    # Columns go by number until the end: any name may stand in the input.
    numbered = rows.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)])
    stored = materialize(numbered.withColumn("place", F.monotonically_increasing_id()))
    by_part = dict(stored.groupBy(F.shiftright("place", PLACE_BITS)).count().collect())
    counts = [by_part.get(p, 0) for p in range(max(by_part, default=0) + 1)]
    total = sum(counts)
    matrix = communication_matrix(counts, shard_sizes(total, shards), seed)
    buckets = max(1, -(-total // shards // bucket_rows))
    at = F.floor(F.col("key") / F.lit(2.0 ** 63 / buckets)).cast("long")   # keys in order, buckets in order

    def deal(part: DataFrame) -> DataFrame:
        fields = T.StructType([*part.schema.fields[:-1], T.StructField("s", T.IntegerType()),
                               T.StructField("key", T.LongType())])
        return part.mapInArrow(_dealt(matrix, seed), fields).withColumn("bucket", F.least(at, F.lit(buckets - 1)))

    # Where buckets start: the same deal over the places alone.
    sizes = deal(stored.select("place")).groupBy("s", "bucket").agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("s", "bucket", F.coalesce(F.sum("n").over(in_order), F.lit(0)).cast("long").alias("before"))
    order = Window.partitionBy("s", "bucket").orderBy("key")
    return (deal(stored).join(starts, ["s", "bucket"])
            .select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], F.col("s").alias(shard),
                    (F.row_number().over(order) - 1 + F.col("before")).cast("long").alias(slot)))


@query("op11_hypergeometric_shards")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"))
    return (shuffled_shards(docs).withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
