"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is tiny against a long document, so their Jaccard similarity
says nothing. The sketch is therefore the item's alone: its smallest shingle
hashes, and the share of them found among the hashes of a whole document
estimates how much of the item the document contains. Items are partitioned
by size; each partition has its own sketch length, and with it the least
number of sketch hits that a contained item can fall to by chance.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import WordHashes, materialize, run_hashes
from roadpulse.llm.registry import query, table

SHINGLE = 5
CONTAINMENT = 0.8
# (items of up to so many shingles, sketch length); an item of no more
# shingles than its sketch length is searched by all of them.
SIZES = ((64, 16), (512, 24), (math.inf, 32))
SLACK = 5                    # standard deviations below the expected hits
BROADCAST_ROWS = 1_000_000   # hashes and words of items sent to every task at most; more are joined
BROADCAST_BYTES = 64 << 20   # and their bytes
SKETCH = "item_id long, words array<binary>, run int, n_shingles int, need int, hashes array<long>"


def item_sketch(text: str | None, hashes: WordHashes, k: int = SHINGLE, least: float = CONTAINMENT,
                sizes=SIZES):
    """(words, words per shingle, distinct shingles, hits needed, sketch) of
    a test item; an item of fewer than ``k`` words is one shingle."""
    words = (text or "").lower().encode().split()
    found = np.unique(run_hashes(hashes.of(words), k))
    n = len(found)
    length = min(n, next(length for most, length in sizes if n <= most))
    spread = 0.0 if length == n else SLACK * math.sqrt(length * least * (1 - least))
    need = max(1, math.ceil(least * length - spread - 1e-9))
    return words, min(len(words), k), n, need, found[:length]


def _sketches(k: int, least: float, sizes):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            rows = [item_sketch(t.as_py(), hashes, k, least, sizes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.list_(pa.binary())),
                 *[pa.array([r[i] for r in rows], pa.int32()) for i in (1, 2, 3)],
                 pa.array([r[4].view(np.int64) for r in rows], pa.list_(pa.int64()))],
                ["item_id", "words", "run", "n_shingles", "need", "hashes"])
    return run


def runs_of(words: list[bytes], k: int) -> set:
    return set(zip(*(words[i:] for i in range(k)))) if len(words) >= k else set()


def whole_runs(h: np.ndarray, k: int) -> np.ndarray:
    return run_hashes(h, k) if len(h) >= k else h[:0]


class Items:
    """Test items with an index from sketch hash to items."""

    def __init__(self, rows: list, least: float):
        self.least = least
        self.ids = [r["item_id"] for r in rows]
        self.need = [r["need"] for r in rows]
        self.run = [r["run"] for r in rows]
        self.shingles = [runs_of([bytes(w) for w in r["words"]], r["run"]) for r in rows]
        self.lengths = sorted(set(self.run))
        flat = np.array([h for r in rows for h in r["hashes"]], np.int64).view(np.uint64)
        item = np.repeat(np.arange(len(rows)), [len(r["hashes"]) for r in rows])
        order = np.argsort(flat, kind="stable")
        self.hash, self.item = flat[order], item[order]

    def contained(self, text: str | None, hashes: WordHashes) -> list[tuple[int, int]]:
        """(item, shingles found) of the items that the text contains."""
        words = (text or "").lower().encode().split()
        if not words or not len(self.hash):
            return []
        h = hashes.of(words)
        hits: Counter = Counter()
        for k in self.lengths:
            mine = whole_runs(h, k)
            at = np.searchsorted(self.hash, mine)
            mine = np.unique(mine[self.hash[np.minimum(at, len(self.hash) - 1)] == mine])
            for a, b in zip(np.searchsorted(self.hash, mine), np.searchsorted(self.hash, mine, "right")):
                hits.update(i for i in self.item[a:b].tolist() if self.run[i] == k)
        out, sets = [], {}
        for i, n in sorted(hits.items()):
            if n >= self.need[i]:
                k = self.run[i]
                if k not in sets:
                    sets[k] = runs_of(words, k)
                found = len(self.shingles[i] & sets[k])
                if found >= self.least * len(self.shingles[i]) - 1e-9:
                    out.append((i, found))
        return out


PAIRS = "doc_id long, item_id long, n_shingles long, n_found long, containment double"


def _pairs(items):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            rows = [(d, items.ids[i], len(items.shingles[i]), found)
                    for d, t in zip(batch.column(0).to_pylist(), batch.column(1))
                    for i, found in items.contained(t.as_py(), hashes)]
            cols = [pa.array([r[j] for r in rows], pa.int64()) for j in range(4)]
            cols.append(pa.array([r[3] / r[2] for r in rows], pa.float64()))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "n_shingles", "n_found", "containment"])
    return run


def _clean(items, at: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            keep = [not items.contained(t.as_py(), hashes) for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def _probe(lengths: list[int]):
    """(doc_id, hash) of every distinct shingle of the given lengths."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = hashes.of((t.as_py() or "").lower().encode().split())
                found = np.unique(np.concatenate([whole_runs(h, k) for k in lengths])).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(found), pa.int64()), pa.array(found)], ["doc_id", "hash"])
    return run


def _verify(least: float):
    def run(batches):
        for batch in batches:
            rows = []
            for d, i, words, k, t, h in zip(*(c.to_pylist() for c in batch.columns)):
                item = runs_of(words, k)
                found = len(item & runs_of((t or "").lower().encode().split(), k))
                if found >= least * len(item) - 1e-9:
                    rows.append((d, i, len(item), found, h))
            cols = [pa.array([r[j] for r in rows], pa.int64()) for j in range(5)]
            cols.insert(4, pa.array([r[3] / r[2] for r in rows], pa.float64()))
            yield pa.RecordBatch.from_arrays(
                cols, ["doc_id", "item_id", "n_shingles", "n_found", "containment", "text_hash"])
    return run


def _joined(docs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Verified pairs, with the hash of the document's text, by joins on the
    sketch hashes."""
    lengths = [r.run for r in sketches.select("run").distinct().collect()]   # at most k values
    items = materialize(sketches.withColumn("item", F.monotonically_increasing_id()))
    hits = (docs.mapInArrow(_probe(lengths), "doc_id long, hash long").distinct()
            .join(items.select("item", "need", F.explode("hashes").alias("hash")), "hash")
            .groupBy("doc_id", "item").agg(F.count(F.lit(1)).alias("hits"), F.first("need").alias("need"))
            .filter("hits >= need").select(F.col("doc_id").alias("d"), "item"))
    rows = (hits.join(items.select("item", "item_id", "words", "run"), "item")
            .join(docs, F.col("d").eqNullSafe(F.col("doc_id")))
            .select("doc_id", "item_id", "words", "run", "text", F.xxhash64("text")))
    return rows.mapInArrow(_verify(least), PAIRS + ", text_hash long")


def _sketch_table(benchmark: DataFrame, k: int, least: float, sizes) -> DataFrame:
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return materialize(rows.mapInArrow(_sketches(k, least, sizes), SKETCH).filter("n_shingles > 0"))


def _small(sketches: DataFrame, most: int) -> bool:
    """The sketches and the words of the items are ``most`` numbers and words
    and ``BROADCAST_BYTES`` at most."""
    letters = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w))
    numbers, size = sketches.agg(F.sum(F.size("hashes") + F.size("words")),
                                 F.sum(8 * F.size("hashes") + letters)).first()
    return (numbers or 0) <= most and (size or 0) <= BROADCAST_BYTES


def contained_items(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT, k: int = SHINGLE,
                    sizes=SIZES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): the items of
    which a document contains ``least`` or more of the distinct ``k``-word
    shingles (lower-case words), verified on the words themselves.

    Sketches of up to ``broadcast_rows`` hashes and words and
    ``BROADCAST_BYTES`` are sent to every task, and documents are streamed past them without a shuffle; larger
    ones are joined on the hash.

    Items without words are found nowhere; an item of fewer than ``k`` words
    is one shingle. Null and empty texts contain nothing; null ids are
    carried; repeated rows (documents or items) give a row each; other
    columns are not read; either table may be empty.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketches = _sketch_table(benchmark, k, least, sizes)
    if _small(sketches, broadcast_rows):
        items = Items(sketches.collect(), least)
        return docs.mapInArrow(_pairs(items), PAIRS)
    return _joined(docs, sketches, least).drop("text_hash")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT, k: int = SHINGLE,
                         sizes=SIZES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without the documents that contain a test item, all columns
    kept; edge cases as in ``contained_items``."""
    sketches = _sketch_table(benchmark, k, least, sizes)
    if _small(sketches, broadcast_rows):
        items = Items(sketches.collect(), least)
        return docs.mapInArrow(_clean(items, docs.columns.index("text")), docs.schema)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    id_, hash_ = (f"found_{name}_{uuid.uuid4().hex}" for name in ("id", "hash"))
    found = _joined(rows, sketches, least).select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    return docs.join(found, same, "left_anti")


SQL = r"""
WITH words AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
    FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') FROM benchmark
), runs AS (
    SELECT kind, id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM words WHERE len(w) >= 5
), shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM runs
), sizes AS (
    SELECT id, COUNT(*) AS n FROM shingles WHERE kind = 'b' GROUP BY id
), hits AS (
    SELECT d.id AS doc_id, b.id AS item_id, COUNT(*) AS found
    FROM shingles d JOIN shingles b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b' GROUP BY ALL
)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, CAST(found AS BIGINT) AS n_found, found / n AS containment
FROM hits JOIN sizes ON item_id = id WHERE found >= 0.8 * n - 1e-9
"""


@query("op5_minhash_containment", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
