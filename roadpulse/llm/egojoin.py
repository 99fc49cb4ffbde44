"""Embedding near-duplicates by an epsilon grid order join.

On unit vectors a cosine of at least t is a distance of at most
eps = sqrt(2 - 2 t). Vectors are sorted by their cells of a grid of width eps
on the leading principal dimensions (Boehm et al. 2001). The sequence is cut
into intervals; two intervals whose bounding boxes on those dimensions are
further apart than eps hold no link and are skipped, the others are halved
and joined recursively.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import connected_components, materialize
from roadpulse.llm.registry import query, table

SIMILARITY = 0.93
GRID_DIMS = 6
BLOCK = 2048           # vectors of an interval that travels as one row
LEAF = 256             # vectors of an interval compared at once
PCA_SAMPLE = 10_000    # vectors the principal dimensions are fitted on, about

GROUP = ["label", "dim"]
BLOCKS = ("label string, dim int, part long, block long, reps array<long>, copies array<long>, vectors binary, "
          "low array<double>, high array<double>")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, without overflow."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def leading(x: np.ndarray, basis: np.ndarray, dims: int) -> np.ndarray:
    """Coordinates on the leading dimensions: principal ones if the basis
    fits, else the first (any orthonormal ones give valid bounds)."""
    return x @ basis if basis.shape[0] == x.shape[1] else x[:, :dims]


def principal(sample: list, dims: int) -> np.ndarray:
    """Leading principal directions of the vectors of the commonest length."""
    sizes = [len(v) for v in sample]
    if not sizes:
        return np.zeros((0, 0))
    size = max(set(sizes), key=sizes.count)
    x = unit(np.array([v for v in sample if len(v) == size], np.float64))
    x = x - x.mean(0)
    _, vectors = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(vectors[:, ::-1][:, :dims])


def _cells(basis: np.ndarray, dims: int, eps: float):
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("embedding")
            cells = [np.floor(leading(unit(np.array([v], np.float64)), basis, dims)[0] / eps).astype(np.int32)
                     for v in batch.column(at).to_pylist()]
            yield batch.append_column("cells", pa.array(cells, pa.list_(pa.int32())))
    return run


def _cut(basis: np.ndarray, dims: int, size: int, dtype: str):
    """The sorted rows of a partition as blocks of one label."""
    def run(batches):
        part = TaskContext.get().partitionId()
        n_blocks, key, rows = 0, None, []

        def block():
            nonlocal n_blocks
            vectors = np.array([r[4] for r in rows], dtype)
            y = leading(unit(vectors), basis, dims)
            out = (*key, part, (part << 32) + n_blocks, [r[2] for r in rows], [r[3] for r in rows],
                   vectors.tobytes(), y.min(0).tolist(), y.max(0).tolist())
            n_blocks += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(out, (
                    pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                    pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                ["label", "dim", "part", "block", "reps", "copies", "vectors", "low", "high"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "rep", "copies", "embedding"))):
                if rows and (row[:2] != key or len(rows) == size):
                    yield block()
                    rows = []
                key = row[:2]
                rows.append(row)
        if rows:
            yield block()
    return run


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for links i-j over n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def join_blocks(a, b, same: bool, basis, dims: int, least: float, leaf: int = LEAF):
    """Link counts of the rows of two blocks and a spanning forest.

    a, b: (vectors, copies). Returns (counts of a, counts of b, root): root
    over the rows of a, then those of b, as ``forest`` gives it.
    """
    (xa, wa), (xb, wb) = ((unit(v), np.asarray(w, np.int64)) for v, w in (a, b))
    ya, yb = leading(xa, basis, dims), leading(xb, basis, dims)
    na, nb = len(xa), len(xb)
    count_a, count_b = np.zeros(na, np.int64), np.zeros(nb, np.int64)
    links_i, links_j = [], []
    far = 2 - 2 * least + 1e-9

    def go(i0, i1, j0, j1, self_join):
        if not self_join:
            low = np.maximum(yb[j0:j1].min(0) - ya[i0:i1].max(0), ya[i0:i1].min(0) - yb[j0:j1].max(0))
            if (np.maximum(low, 0) ** 2).sum() > far:
                return
        if max(i1 - i0, j1 - j0) <= leaf:
            hit = xa[i0:i1] @ xb[j0:j1].T >= least
            if self_join:
                np.fill_diagonal(hit, False)
            count_a[i0:i1] += hit @ wb[j0:j1]
            if not self_join:
                count_b[j0:j1] += wa[i0:i1] @ hit
            i, j = np.nonzero(hit)
            if len(i):
                root = forest(i, j + (i1 - i0), i1 - i0 + j1 - j0)
                node = np.flatnonzero(root != np.arange(len(root)))
                place = np.r_[np.arange(i0, i1), na + np.arange(j0, j1)]
                links_i.append(place[node])
                links_j.append(place[root[node]])
            return
        im, jm = (i0 + i1) // 2, (j0 + j1) // 2
        if self_join:
            go(i0, im, j0, jm, True)
            go(i0, im, jm, j1, False)
            go(im, i1, jm, j1, True)
        else:
            for p, q in ((i0, im), (im, i1)):
                for r, s in ((j0, jm), (jm, j1)):
                    if p < q and r < s:
                        go(p, q, r, s, False)

    go(0, na, 0, nb, same)
    if same:   # both halves are the same rows
        count_a = count_a + count_b
        i = np.concatenate(links_i) % na if links_i else np.zeros(0, np.int64)
        j = np.concatenate(links_j) % na if links_j else np.zeros(0, np.int64)
        return count_a, None, forest(i, j, na)
    i = np.concatenate(links_i) if links_i else np.zeros(0, np.int64)
    j = np.concatenate(links_j) if links_j else np.zeros(0, np.int64)
    return count_a, count_b, forest(i, j, na + nb)


def _join(basis: np.ndarray, dims: int, least: float, dtype: str):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                a, b = ((np.frombuffer(r["vectors" + s], dtype).reshape(-1, r["dim"]), r["copies" + s])
                        for s in ("_a", "_b"))
                same = r["block_a"] == r["block_b"]
                count_a, count_b, root = join_blocks(a, b, same, basis, dims, least)
                reps = np.array(r["reps_a"] if same else r["reps_a"] + r["reps_b"], np.int64)
                counts = count_a if same else np.r_[count_a, count_b]
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps[some]), pa.array(reps[root[some]]), pa.array(counts[some])],
                    ["rep", "root", "links"])
    return run


def _apart(low_a: str, high_a: str, low_b: str, high_b: str) -> Column:
    """Squared distance of two bounding boxes."""
    gaps = F.zip_with(F.arrays_zip(F.col(low_a).alias("l"), F.col(high_a).alias("h")),
                      F.arrays_zip(F.col(low_b).alias("l"), F.col(high_b).alias("h")),
                      lambda a, b: F.greatest(F.lit(0.0), b["l"] - a["h"], a["l"] - b["h"]))
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)


def _suffixed(df: DataFrame, suffix: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else c + suffix) for c in df.columns])


def similar_vectors(rows: DataFrame, least: float = SIMILARITY, grid_dims: int = GRID_DIMS, block: int = BLOCK,
                    pca_sample: int = PCA_SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Rows of equal, known label are linked where their cosine is ``least`` or
    more. Equal vectors are compared once, with their number as weight.
    Intervals of the epsilon grid order are paired by their bounding boxes,
    first whole partitions, then blocks, then halves of blocks inside the
    task; link counts and a spanning forest leave it, never the links. The
    principal dimensions, fitted on about ``pca_sample`` vectors, decide how
    much is skipped, not what is found.

    Vectors that are null, empty, all zero, or hold a null or non-finite
    component, and rows without label or vec_id, link with nothing:
    n_links 0, component_id their own vec_id, kept. Vectors of different
    lengths do not link. Repeated rows (equal vec_id, label and vector) are one
    vector and give one row; a vec_id with several different vectors gives a
    row for each, which are one node. Labels of any type are compared as text. Other
    columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    dtype = "<f4" if isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    eps = math.sqrt(2 - 2 * least)
    infinity = F.lit(float("inf"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < infinity), F.lit(False)))
              & F.exists("embedding", lambda x: x != 0))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding")
    keyed = rows.select(
        "vec_id", F.coalesce(usable, F.lit(False)).alias("usable"), "label",
        F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("h1"),
        F.xxhash64("embedding", F.lit(7)).alias("h2"), "embedding")
    key = [*GROUP, "h1", "h2"]
    ids = keyed.drop("embedding").distinct()   # repeated rows are one vector
    copies = ids.filter("usable").groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    classes = materialize(keyed.filter("usable").groupBy(*key).agg(
        F.min("vec_id").alias("rep"), F.first("embedding").alias("embedding")).join(copies, key)
        .select(*key, "rep", "copies", "embedding"))
    share = pca_sample / max(1, classes.count())
    place = F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 30))
    sample = classes.filter(place < int(min(1.0, share) * (1 << 30))).select("embedding")
    basis = principal([r.embedding for r in sample.collect()], grid_dims)

    order = [*GROUP, "cells", "rep"]
    sequence = (classes.select(*GROUP, "rep", "copies", "embedding")
                .mapInArrow(_cells(basis, grid_dims, eps), T.StructType(
                    [*classes.select(*GROUP, "rep", "copies", "embedding").schema,
                     T.StructField("cells", T.ArrayType(T.IntegerType()))]))
                .repartitionByRange(*order).sortWithinPartitions(*order))
    blocks = materialize(sequence.mapInArrow(_cut(basis, grid_dims, block, dtype), BLOCKS))

    boxes = blocks.select(*GROUP, "part", "block", "low", "high")
    dims = range(grid_dims)
    intervals = (boxes.groupBy(*GROUP, "part").agg(
        F.array(*[F.min(F.get("low", F.lit(d))) for d in dims]).alias("low"),
        F.array(*[F.max(F.get("high", F.lit(d))) for d in dims]).alias("high"))
        .withColumn("low", F.filter("low", lambda x: x.isNotNull()))
        .withColumn("high", F.filter("high", lambda x: x.isNotNull())))
    near = _apart("low_a", "high_a", "low_b", "high_b") <= 2 - 2 * least + 1e-9
    pairs = (_suffixed(intervals, "_a", GROUP).join(_suffixed(intervals, "_b", GROUP), GROUP)
             .filter("part_a <= part_b").filter(near).select(*GROUP, "part_a", "part_b"))
    pairs = (pairs.join(_suffixed(boxes, "_a", GROUP), [*GROUP, "part_a"])
             .join(_suffixed(boxes, "_b", GROUP), [*GROUP, "part_b"])
             .filter("block_a <= block_b").filter(near | (F.col("block_a") == F.col("block_b")))
             .select("block_a", "block_b"))
    data = blocks.select("block", "dim", "reps", "copies", "vectors")
    joined = (pairs.join(_suffixed(data, "_a", ["dim"]), "block_a")
              .join(_suffixed(data.drop("dim"), "_b", []), "block_b"))
    links = materialize(joined.mapInArrow(_join(basis, grid_dims, least, dtype), "rep long, root long, links long"))

    degree = links.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (classes.select(*key, "rep", "copies").join(degree, "rep", "left")
             .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*key, F.lit(True).alias("usable"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    return (ids.join(named, [*key, "usable"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
      AND list_max(embedding) < 'infinity' AND list_min(embedding) > '-infinity'
      AND (list_max(embedding) > 0 OR list_min(embedding) < 0)
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(node, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT node, b FROM reach JOIN links ON other = a
), components AS (
    SELECT node, MIN(other) AS component_id FROM reach GROUP BY node
), degree AS (
    SELECT a, COUNT(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, COALESCE(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN components c ON e.vec_id = c.node LEFT JOIN degree d ON e.vec_id = d.a
"""


@query("op9_epsilon_grid_order", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))
