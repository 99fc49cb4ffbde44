"""Near-duplicate documents by DartMinHash over weighted word shingles.

Every (element, weight region) throws darts: a Poisson process in rank whose
rate is the region's width, drawn from hashes of the element, so that all
documents see the same darts. A dart counts for a document if its height is
below the element's weight there. Each dart belongs to one coordinate of the
signature, which keeps its earliest dart; two documents agree in a
coordinate with the probability of their weighted Jaccard similarity. Only
darts up to the rank that a document needs are thrown, about k ln k + 2 k in
all, not k per element (Christiani 2020).
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import (WordHashes, connected_components, discard, materialize, mix64, run_hashes)
from roadpulse.llm.registry import query, table

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
BLOCK_BYTES = 4 << 20   # text compared in one task, about: one or two such blocks
SIEVE_BITS, SIEVE_HASHES = 1 << 26, 3


def weighted_shingles(text: str | None, hashes: WordHashes, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles (lower-case words) and how often each occurs.
    A text of fewer words is one shingle, an empty one has none."""
    words = (text or "").lower().encode().split()
    return np.unique(run_hashes(hashes.of(words), k), return_counts=True)


def _unit(x: np.ndarray) -> np.ndarray:
    """Hash to (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """DartMinHash signatures (documents x size) of weighted element sets;
    every set has an element."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(e) for e, _ in sets])
    element = np.concatenate([e for e, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(np.float64)
    total = np.bincount(owner, weight, n)
    # Weight regions of an element: [0, 1), [1, 2), [2, 4), [4, 8) ...
    regions = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    at = np.repeat(np.arange(len(element)), regions)
    region = np.arange(len(at)) - np.repeat(np.cumsum(regions) - regions, regions)
    low = np.where(region == 0, 0.0, 2.0 ** (region - 1.0))
    width = np.where(region == 0, 1.0, low)
    seed = mix64(element[at] + (region.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    owner_at, weight_at = owner[at], weight[at]

    out = np.zeros((n, size), np.uint64)
    todo = np.ones(n, bool)
    reach = (size * math.log(size) + 2 * size) / total   # rank up to which a document's darts are thrown
    while todo.any():
        best = np.full(n * size, np.inf)
        value = np.zeros(n * size, np.uint64)
        live = np.flatnonzero(todo[owner_at])
        rank = np.zeros(len(live))
        dart = 0
        while len(live):
            dart += 0x9E3779B97F4A7C15
            h = mix64(seed[live] + np.uint64(dart & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(_unit(h)) / width[live]
            on = rank <= reach[owner_at[live]]
            live, rank, h = live[on], rank[on], h[on]
            if not len(live):
                break
            spot = mix64(h + np.uint64(0x2545F4914F6CDD1D))
            below = low[live] + width[live] * _unit(spot) <= weight_at[live]
            hit = live[below]
            mine = mix64(spot[below])
            cell = owner_at[hit] * size + (mine % np.uint64(size)).astype(np.int64)
            order = np.lexsort((rank[below], cell))
            cell, ranks, mine = cell[order], rank[below][order], mine[order]
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[:len(cell)]
            cell, ranks, mine = cell[first], ranks[first], mine[first]
            better = ranks < best[cell]
            best[cell[better]], value[cell[better]] = ranks[better], mine[better]
        done = todo & np.isfinite(best.reshape(n, size)).all(1)
        out[done] = value.reshape(n, size)[done]
        todo &= ~done
        reach = reach * 2
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents x bands) hashes of runs of ``rows`` coordinates."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64)[None, :].repeat(len(parts), 0)
    for j in range(rows):
        out = out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j]
    return mix64(out).view(np.int64)


def _bands(bands: int, rows: int, k: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at in range(0, len(ids), 200):
                sets = [weighted_shingles(t.as_py(), hashes, k) for t in batch.column(1)[at:at + 200]]
                some = [i for i, (e, _) in enumerate(sets) if len(e)]
                if not some:
                    continue
                signed = signatures([sets[i] for i in some], bands * rows)
                got = band_hashes(signed, bands, rows)
                size = pc.binary_length(batch.column(1)[at:at + 200]).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + 200][some]), pa.array(list(got), pa.list_(pa.int64())),
                     size.take(pa.array(some))], ["rep", "bands", "size"])
    return run


def _places(rep: str, bits: int) -> Column:
    """A class's places in a sieve of so many bits."""
    return F.array(*[F.pmod(F.xxhash64(rep, F.lit(j)), F.lit(bits)) for j in range(SIEVE_HASHES)])


def _sieve(reps: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of classes, ``SIEVE_BITS`` bits at most however many
    there are (then it lets more through), as 64-bit words."""
    bits = min(SIEVE_BITS, 1 << max(10, math.ceil(math.log2(12 * reps.count() + 1))))
    place = F.explode(_places("rep", bits)).alias("place")
    words = (reps.select(place).groupBy(F.expr("place div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")).collect())
    out = np.zeros(bits // 64, np.int64)
    for r in words:
        out[r.word] = r.bits
    return out.view(np.uint64), bits


def _packed(sieve: np.ndarray):
    """Texts of classes that pass the sieve, as zstd frames: what moves when
    texts are compared."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = np.array(batch.column(2).to_pylist(), np.int64).reshape(-1, SIEVE_HASHES).astype(np.uint64)
            hit = ((sieve[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(1)
            rep, text = (batch.column(k).filter(pa.array(hit)) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [rep, pa.array([pack.compress(t.as_buffer()) for t in text], pa.binary())], ["rep", "text"])
    return run


class _Block:
    """The weighted shingles of some texts, for exact similarities of one text
    to many at once."""

    def __init__(self, texts: list[bytes], k: int):
        unpack, hashes = zstandard.ZstdDecompressor(), WordHashes()
        sets = [weighted_shingles(unpack.decompress(t).decode("utf-8", "replace"), hashes, k) for t in texts]
        self.ends = np.cumsum([len(e) for e, _ in sets])
        vocabulary, self.at = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True)
        self.weight = np.concatenate([w for _, w in sets])
        self.total = np.array([w.sum() for _, w in sets])
        self.row = np.zeros(len(vocabulary), np.int64)   # weights of one text

    def similarities(self, x: int, first: int, last: int) -> np.ndarray:
        """Weighted Jaccard similarities of text ``x`` and texts ``first``
        up to ``last``; every text has a shingle."""
        low = lambda k: self.ends[k - 1] if k else 0
        mine, theirs = slice(low(x), self.ends[x]), slice(low(first), self.ends[last - 1])
        self.row[self.at[mine]] = self.weight[mine]
        least = np.minimum(self.row[self.at[theirs]], self.weight[theirs])
        both = np.add.reduceat(least, np.r_[low(first), self.ends[first:last - 1]] - low(first))
        self.row[self.at[mine]] = 0
        return both / (self.total[x] + self.total[first:last] - both)


def _linked(least: float, k: int):
    """Links that join components, within the rows of one group: of its
    centre and all others, or of all pairs of its blocks ``i`` and ``j``.
    Texts of one component, as given or found here, are not compared."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("home", "ascending"), ("rep", "ascending")])
        rep, component, home = (rows.column(c).to_numpy() for c in ("rep", "component", "home"))
        centre = rows.column("centre").to_numpy()
        n = len(rep)
        names, of = np.unique(component, return_inverse=True)
        found: list[tuple[int, int]] = []
        if n > 1 and len(names) > 1:
            block = _Block(rows.column("text").to_pylist(), k)
            cut = int(np.searchsorted(home, home[0], "right"))   # end of the first block
            if centre.any():
                todo = [(int(x), 0, n) for x in np.flatnonzero(centre)]
            elif cut < n:
                todo = [(x, cut, n) for x in range(cut)]
            else:
                todo = [(x, x + 1, n) for x in range(n - 1)]
            for x, first, last in todo:
                apart = of[first:last] != of[x]
                if not apart.any():
                    continue
                near = np.flatnonzero(apart & (block.similarities(x, first, last) >= least)) + first
                for y in near.tolist():
                    if of[y] != of[x]:
                        found.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
                        of[of == of[y]] = of[x]
        return pa.table([pa.array([int(p[c]) for p in found], pa.int64()) for c in (0, 1)], ["a", "b"])
    return run


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, k: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, component_id, n_links, kept) of every document.

    ``class_id`` is the smallest doc_id with exactly the same text; classes
    are what is compared. Classes are linked where the weighted Jaccard
    similarity of their ``k``-word shingles (weight: occurrences) is
    ``least`` or more; ``component_id`` is the smallest doc_id reachable over
    links, ``n_links`` counts the verified links of the class that were
    needed to find it, and ``kept`` marks one document of each component.

    Candidates share a band of their DartMinHash signatures. Classes are first
    compared with the smallest class of each of their buckets. Buckets that
    this leaves in several components (each set of classes once) then meet
    whole, in pairs of blocks of about ``BLOCK_BYTES`` of text: every pair of
    classes in different components is compared exactly, so no candidate that
    could join two components is left out. Pairs never leave a task: a group
    returns the links that join its components, at most one per row.

    What moves is one compressed text per class and smallest class, and one
    per open bucket and block that it meets. Texts of classes that share no
    bucket do not move: a Bloom filter of at most 8 MB, which goes to every
    task, holds most of them back before the join that decides. Comparing a bucket of n classes
    that do not link takes n^2 / 2 similarities, about half a microsecond each
    for short texts.

    Texts without words (null, empty) are exact copies of each other if
    equal, null and empty count as equal, and have no links. Texts of any
    length are compared whole; a text larger than a block is one of its own. A null doc_id
    is carried: its row is a class of its own with null ids and kept.
    Repeated rows share a class; one doc_id with several texts takes part
    with each row. Other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Two independent 64-bit hashes and the length name a text.
    key = [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(7)).alias("h2"), F.length("text").alias("n")]
    members = materialize(docs.select("doc_id", *key))
    classes = materialize(members.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep")))
    texts = docs.filter(F.col("doc_id").isNotNull())
    signed = texts.mapInArrow(_bands(bands, rows, k), "rep long, bands array<long>, size long")
    reps = classes.filter("rep IS NOT NULL").select("rep").distinct()
    signed = materialize(signed.join(reps, "rep", "left_semi"))
    buckets = signed.select("rep", "size", F.explode("bands").alias("band"))
    shared = (buckets.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high"))
    buckets = materialize(buckets.join(shared, "band").select("band", "rep", "size", "low"))
    # Only the texts of classes that share a bucket are compared.
    compared = materialize(buckets.select("rep").distinct())
    sieve, bits = _sieve(compared)
    texts = materialize(texts.select("doc_id", F.col("text").cast("binary"), _places("doc_id", bits))
                        .mapInArrow(_packed(sieve), "rep long, text binary").join(compared, "rep", "left_semi"))

    def linked(met: DataFrame) -> DataFrame:
        """Links (a, b) found in groups of rows (key, i, j, home, rep, component, centre)."""
        return (met.join(texts, "rep").groupBy("key", "i", "j").applyInArrow(_linked(least, k), "a long, b long")
                .distinct())

    # The smallest class of a bucket, its text in every block of the others.
    star = buckets.filter("rep > low").groupBy("low", "rep").agg(F.max("size").alias("size"))
    blocks = star.groupBy("low").agg(F.ceil(F.sum("size") / BLOCK_BYTES).alias("blocks"))
    row = ["key", F.col("home").alias("i"), F.col("home").alias("j"), "home", "rep", F.col("rep").alias("component"), "centre"]
    others = (star.join(blocks, "low").withColumn("home", F.pmod(F.xxhash64("rep"), F.col("blocks")))
              .select(F.col("low").alias("key"), "home", "rep", F.lit(False).alias("centre")))
    centres = (blocks.withColumn("home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
               .select(F.col("low").alias("key"), "home", F.col("low").alias("rep"), F.lit(True).alias("centre")))
    links = materialize(linked(others.unionByName(centres).select(*row)))

    # Buckets of three classes or more that are not one component: each set of
    # classes once, block by block.
    groups = connected_components(links)
    named = materialize(buckets.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                        .select("band", "rep", "size", F.coalesce("component", "rep").alias("component")))
    opened = (named.groupBy("band").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("bytes"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("s1"),
        F.bit_xor(F.xxhash64("rep", F.lit(3))).alias("s2")).filter("lo < hi AND n > 2")
        .groupBy("n", "s1", "s2", "bytes").agg(F.min("band").alias("band")))
    opened = opened.select("band", F.ceil(F.col("bytes") / BLOCK_BYTES).alias("blocks"))
    met = (named.join(opened, "band").withColumn("home", F.pmod(F.xxhash64("rep"), F.col("blocks")))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .select(F.col("band").alias("key"), F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"),
                   "home", "rep", "component", F.lit(False).alias("centre")))
    all_links = materialize(links.unionByName(linked(met)).distinct())

    final = connected_components(all_links)
    degree = (all_links.select(F.col("a").alias("node")).unionByName(all_links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    of = (classes.join(final.withColumnRenamed("node", "rep"), "rep", "left")
          .join(degree.withColumnRenamed("node", "rep"), "rep", "left")
          .select("h1", "h2", "n", "rep", F.coalesce("component", "rep").alias("component_id"),
                  F.coalesce("n_links", F.lit(0)).alias("n_links")))
    out = materialize(members.join(of, ["h1", "h2", "n"])
                      .select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("class_id"),
                              F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "n_links",
                              F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
    for table_ in (members, classes, signed, buckets, compared, texts, links, groups, named, all_links, final):
        discard(table_)
    return out


def without_near_duplicates(docs: DataFrame, least: float = SIMILARITY, k: int = SHINGLE, bands: int = BANDS,
                            rows: int = ROWS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, its smallest
    doc_id (of rows that share it, one with the smallest text hash), all
    columns kept. Rows without doc_id stay."""
    keep = near_duplicates(docs, least, k, bands, rows).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi").select(*docs.columns)
    one, place = Window.partitionBy("doc_id").orderBy(F.xxhash64("text")), f"place_{uuid.uuid4().hex}"
    kept = kept.withColumn(place, F.row_number().over(one)).filter(F.col(place) == 1).drop(place)
    return kept.unionByName(docs.filter("doc_id IS NULL"))


SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, MIN(doc_id) OVER (PARTITION BY coalesce(text, '')) AS class_id,
           regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents
), classes AS (
    SELECT doc_id AS id, w, least(5, len(w)) AS k FROM texts WHERE doc_id = class_id AND len(w) > 0
), runs AS (
    SELECT id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM classes
), shingles AS (
    SELECT id, array_to_string(w[i:i + k - 1], ' ') AS s, COUNT(*) AS n FROM runs GROUP BY ALL
), sizes AS (
    SELECT id, SUM(n) AS n FROM shingles GROUP BY id
), common AS (
    SELECT a.id AS a, b.id AS b, SUM(least(a.n, b.n)) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM common o JOIN sizes x ON a = x.id JOIN sizes y ON b = y.id
    WHERE o.n >= 0.8 * (x.n + y.n - o.n)
), reach(node, other) AS (
    SELECT DISTINCT class_id, class_id FROM texts
    UNION SELECT node, b FROM reach JOIN links ON other = a
), components AS (
    SELECT node, MIN(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, class_id, component_id, doc_id = component_id AS kept
FROM texts JOIN components ON class_id = node
"""


@query("op4_dart_minhash_near_dedup", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("n_links")
