import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import hypershuffle as H
from tests.conftest import SF0001
from tests.llm.helpers import EDGE, docs_of


def gapless(rows, shards, total):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(map(len, slots.values()), reverse=True) == [n for n in H.shard_sizes(total, shards) if n]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_the_query_over_real_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    got = H.op11(spark, SF0001).collect()
    gapless(got, 8, len(docs))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sorted(map(tuple, H.op11(spark, SF0001).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_edge_cases(spark, tmp):
    docs_of(spark, EDGE).write.parquet(f"{tmp}/documents.parquet")
    got = H.op11(spark, tmp).collect()
    gapless(got, 8, len(EDGE))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len((t or "").encode()) + 1) for i, t in EDGE)
    docs_of(spark, []).write.parquet(f"{tmp}/none/documents.parquet")
    assert H.op11(spark, f"{tmp}/none").collect() == []


def test_columns_are_carried_whatever_their_names(spark):
    rows = spark.range(50).select("id", *[F.lit(n).alias(n) for n in ("s", "key", "place", "bucket", "before", "a.b", "Slot")])
    got = H.shuffled_shards(rows, shards=3, bucket_rows=4)
    assert got.columns == ["id", "s", "key", "place", "bucket", "before", "a.b", "shard", "slot"]
    got = got.collect()
    gapless(got, 3, 50)
    assert sorted(r.id for r in got) == list(range(50)) and {r["a.b"] for r in got} == {"a.b"}


def test_a_hot_value_is_dealt_like_all_others(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    got = H.shuffled_shards(rows, shards=4, bucket_rows=100).collect()
    gapless(got, 4, 4000)
    assert all(250 < n < 420 for n in Counter(r.shard for r in got if r.v == 7).values())


def test_the_matrix_has_exact_margins_and_the_law_of_a_uniform_shuffle():
    counts, sizes = [5, 0, 40, 3, 12], [20, 25, 15]
    drawn = np.array([H.communication_matrix(counts, sizes, seed) for seed in range(2000)])
    assert (drawn.sum(2) == counts).all() and (drawn.sum(1) == sizes).all()
    want = np.outer(counts, sizes) / 60
    assert np.abs(drawn.mean(0) - want).max() < 0.15
    c, s, n = 40, 20, 60   # variance of a hypergeometric number
    assert drawn[:, 2, 0].var() == pytest.approx(c * s / n * (1 - s / n) * (n - c) / (n - 1), rel=0.15)
    with pytest.raises(ValueError):
        H.communication_matrix([1], [2], 0)


def test_large_populations_have_the_same_law():
    """Beyond numpy's range rows are taken by coin and the difference is drawn."""
    rng = np.random.default_rng(3)
    good, bad, n = 3 * 10 ** 11, 7 * 10 ** 11, 10 ** 11
    got = np.array([H.drawn(rng, good, bad, n) for _ in range(400)], float)
    deviation = (n * 0.3 * 0.7 * (1 - n / (good + bad))) ** 0.5
    assert abs(got.mean() - n * 0.3) < 4 * deviation / 20 and got.std() == pytest.approx(deviation, rel=0.15)


def test_the_recursion_is_exact_on_small_numbers(monkeypatch):
    from math import comb
    monkeypatch.setattr(H, "EXACT_BELOW", 30)
    rng = np.random.default_rng(9)
    got = Counter(H.drawn(rng, 25, 35, 20) for _ in range(20_000))
    for k in range(4, 14):
        p = comb(25, k) * comb(35, 20 - k) / comb(60, 20)
        assert abs(got[k] / 20_000 - p) < 5 * (p / 20_000) ** 0.5 + 1e-3


def test_places_are_uniform(spark):
    """Every row reaches every shard and every part of it equally often."""
    hits = np.zeros((40, 4))
    for seed in range(12):
        for r in H.shuffled_shards(spark.range(40), shards=4, seed=seed, bucket_rows=5).collect():
            hits[r.id, r.shard] += 1
    chi = ((hits - 3) ** 2 / 3).sum()
    assert 70 < chi < 175   # about 117 degrees of freedom
