"""Near copies, contained items, repeated phrases and similar vectors,
against plain loops."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from roadpulse.llm import dartminhash, decontam, egojoin, phrases
from roadpulse.llm.common import WordHashes, connected_components
from tests.conftest import SF001, SF0001
from tests.llm.helpers import EDGE, LONG, docs_of
from tests.oracle_check import compare, duck


def roots(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def texts(seed, n, words=60, vocabulary=400):
    rng = random.Random(seed)
    return [" ".join(f"v{rng.randrange(vocabulary)}" for _ in range(words)) for _ in range(n)], rng


# Connected components

def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 60)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    links = chain + star + loose + star[:5]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    want = roots(linked, [x for x in links if x[0] != x[1]])
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# op4

def shingles(text):
    words = (text or "").lower().encode().split()
    k = min(5, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else Counter()


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def near_copies(rows, least=0.8):
    classes = {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        classes.setdefault(t or "", i)
    sets = {i: shingles(t) for t, i in classes.items()}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and weighted_jaccard(sets[a], sets[b]) >= least]
    root = roots(ids, links)
    return {i: (classes[t or ""], root[classes[t or ""]]) for i, t in rows if i is not None}


def test_near_duplicates_with_edges(spark):
    base, rng = texts(1, 12)
    rows = list(EDGE)
    for n, t in enumerate(base):
        rows.append((100 + 10 * n, t))
        words = t.split()
        for k in range(1, 6):   # copies with one or two words changed, and exact ones
            copy = list(words)
            for _ in range(k // 2):
                copy[rng.randrange(len(copy))] = "new"
            rows.append((100 + 10 * n + k, " ".join(copy)))
    rows.append((300, LONG + " end"))
    got = dartminhash.near_duplicates(docs_of(spark, rows)).collect()
    want = near_copies(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.class_id, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    kept = dartminhash.without_near_duplicates(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, []).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in want.values()})
    assert ids.count(None) == 1
    assert dartminhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_chain_of_near_copies_stays_together(spark):
    """Neighbours are similar, ends are not: no link may be left out because
    a bucket is compared with one of its texts first."""
    words = texts(2, 1, 100, 5000)[0][0].split()
    rows = []
    for i in range(40):
        if i:
            words = list(words)
            words[(2 * i) % 100] = f"c{i}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in dartminhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in near_copies(rows).items()} == {i: 0 for i in range(40)}


def test_real_documents_near_duplicates(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.class_id, r.component_id) for r in dartminhash.near_duplicates(docs).collect()}
    assert got == near_copies(rows)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(7)
    for _ in range(4):
        n = int(rng.integers(3, 300))
        e = np.unique(rng.integers(0, 2 ** 62, n).astype(np.uint64))
        a = rng.integers(1, 9, len(e))
        b = np.maximum(1, a + rng.integers(-2, 3, len(e)))
        s = dartminhash.signatures([(e, a), (e, b)], 3000)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05


def test_signature_does_not_depend_on_the_batch():
    hashes = WordHashes()
    sets = [dartminhash.weighted_shingles(t, hashes) for t in ("a b c", LONG[:5000], "x " * 500)]
    alone = [dartminhash.signatures([s], 80)[0] for s in sets]
    assert (dartminhash.signatures(sets, 80) == np.array(alone)).all()


# op5

def test_contained_items_match_sql(spark):
    assert compare(spark, duck(SF001), "op5", decontam.op5, decontam.SQL, SF001)[0] == []


def test_contained_items_with_edges(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, ""), (4, "two words"),
             (None, "mu nu xi omicron pi rho sigma"), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
             (6, " ".join(f"long{i}" for i in range(900)))]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    docs = [*EDGE, (20, LONG + " " + items[0][1] + " " + LONG), (21, "has TWO words"), (22, "words two"),
            (None, "x mu nu xi omicron pi rho sigma y"), (23, items[0][1].replace("kappa", "other")),
            (24, " ".join(f"long{i}" for i in range(100, 900))), (25, " ".join(f"long{i}" for i in range(300, 900))),
            (26, items[0][1].replace("epsilon", "other")), (20, "two words again")]
    want, bad = [], set()
    for d, t in docs:
        words = (t or "").lower().split()
        for i, s in items:
            item = (s or "").lower().split()
            k = min(5, len(item))
            if not k:
                continue
            parts = {tuple(item[j:j + k]) for j in range(len(item) - k + 1)}
            found = len(parts & {tuple(words[j:j + k]) for j in range(len(words) - k + 1)})
            if found >= 0.8 * len(parts):
                want.append((d, i, len(parts), found, found / len(parts)))
                bad.add((d, t))
    table = docs_of(spark, docs)
    assert len(want) == 8
    key = str
    for most in (decontam.BROADCAST_ROWS, 0):
        got = decontam.contained_items(table, bench, broadcast_rows=most).collect()
        assert set(map(tuple, got)) == set(want)
        if most:
            assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
        assert decontam.contained_items(docs_of(spark, []), bench, broadcast_rows=most).count() == 0
        assert decontam.contained_items(table, bench.limit(0), broadcast_rows=most).count() == 0
        clean = decontam.without_contaminated(table, bench, broadcast_rows=most)
        assert clean.columns == table.columns
        assert sorted([(r.doc_id, r.text) for r in clean.collect()], key=key) == sorted(
            [x for x in docs if x not in bad], key=key)


# op7

def plain_removal(rows, window=20):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for i, t in order:
        place = (i is None, i or 0)
        words = (t or "").encode().split()
        for s in range(len(words) - window + 1):
            first.setdefault(tuple(words[s:s + window]), (place, s))
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] != ((i is None, i or 0), s):
                gone[s:s + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((i, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_repeated_phrases(spark):
    base, rng = texts(11, 40, 90, 3000)
    passages = texts(12, 5, 55, 3000)[0]
    rows = list(EDGE)
    for n, t in enumerate(base):
        words = t.split()
        cut = rng.randrange(len(words))
        if n % 3:
            words[cut:cut] = rng.choice(passages).split()
        if n % 4 == 0:
            words = words + words[10:45]           # repeats itself
        rows.append((100 + n, "  ".join(words)))
    rows += [(200, "same " * 70), (201, "same " * 45), (202, "ab cd " * 30), (203, base[0]), (204, base[0]),
             (None, passages[0]), (205, base[1] + " more"), (206, " ".join(base[2].split()[:19])),
             (207, " ".join(base[2].split()[:20]))]
    for size in (phrases.BUCKET_BYTES, 4000):
        got = phrases.remove_repeats(docs_of(spark, rows), bucket_bytes=size).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_removal(rows)))
    assert phrases.remove_repeats(docs_of(spark, [])).count() == 0


def test_real_documents_repeated_phrases(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, phrases.remove_repeats(docs).collect())) == sorted(plain_removal(rows))


def test_window_names_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2 ** 62, 200).astype(np.uint64)
    name, _ = phrases.names(h, 20, 5)
    assert len(name) == 181
    assert all(phrases.names(h[i:i + 20], 20, 5)[0][0] == name[i] for i in range(181))


# op9

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType()), T.StructField("rep", T.StringType()),
                        T.StructField("block", T.StringType())])


def plain_vectors(rows, least=0.93):
    def fine(v, label):
        return (label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v))

    good = [(i, np.array(v, float) / np.abs(v).max(), label) for i, v, label in rows if i is not None and fine(v, label)]
    links = [(a[0], b[0]) for n, a in enumerate(good) for b in good[n + 1:]
             if a[2] == b[2] and len(a[1]) == len(b[1])
             and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= least]
    count = Counter(n for x in links for n in x)
    root = roots([r[0] for r in rows if r[0] is not None], links)
    return {i: (count[i], root[i], root[i] == i) for i, _, _ in rows if i is not None}


def vectors(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, (centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.6])).tolist(),
             int(rng.integers(3))) for i in range(n)]


def test_similar_vectors(spark):
    rows = vectors(3, 300)
    rows += [(1000, rows[0][1], rows[0][2]), (1001, rows[0][1], rows[0][2]), (1002, None, 0), (1003, [], 0),
             (1004, [0.0] * 8, 0), (1005, [float("nan")] * 8, 0), (1006, [None] + [1.0] * 7, 0),
             (1007, rows[0][1], None), (1008, [1.0, 0.0], 0), (1009, [2.0, 0.0], 0), (None, rows[0][1], rows[0][2]),
             (1010, [1e300] * 8, 1), (1011, [1e-300] * 8, 1), (1012, [float("inf")] + [1.0] * 7, 1)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    for size, dims in ((egojoin.BLOCK, egojoin.GRID_DIMS), (7, 3)):
        got = egojoin.similar_vectors(table, block=size, grid_dims=dims).collect()
        assert len(got) == len(rows)
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == plain_vectors(rows)
        assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert egojoin.similar_vectors(table.limit(0)).count() == 0


def test_recursion_equals_the_plain_product():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(700, 6))
    x[300:400] = x[5] + rng.normal(size=(100, 6)) * 0.02
    basis = egojoin.principal(x.tolist(), 4)
    y = egojoin.leading(egojoin.unit(x), basis, 4)
    x = x[np.lexsort(np.floor(y[:, ::-1] / 0.37).T)]
    copies = rng.integers(1, 4, len(x))
    u = egojoin.unit(x)
    hit = u @ u.T >= 0.93
    np.fill_diagonal(hit, False)
    count, _, root = egojoin.join_blocks((x, copies), (x, copies), True, basis, 4, 0.93, leaf=32)
    assert (count == hit @ copies).all()
    i, j = np.nonzero(hit)
    assert (egojoin.forest(i, j, len(x)) == root).all()
    a, b, root = egojoin.join_blocks((x[:350], copies[:350]), (x[350:], copies[350:]), False, basis, 4, 0.93, leaf=32)
    assert (a == hit[:350, 350:] @ copies[350:]).all() and (b == copies[:350] @ hit[:350, 350:]).all()


def test_repeated_vectors_and_labels_of_any_type(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (3, [1.0, 0.0], "b"),
            (4, [0.0, 1.0], "3000000000"), (5, [0.0, 2.0], "3000000000"), (6, [0.0, 2.0], None)]
    want = {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (0, 6)}
    got = egojoin.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    got = got.collect()
    assert len(got) == 6 and {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    big = spark.createDataFrame([(4, [0.0, 1.0], 3_000_000_000), (5, [0.0, 2.0], 3_000_000_000)],
                                "vec_id long, embedding array<double>, label long")
    assert [r.n_links for r in egojoin.similar_vectors(big).collect()] == [1, 1]


def test_columns_named_like_an_operator_s_own(spark):
    text = texts(3, 1)[0][0]
    docs = spark.createDataFrame([(1, text, 5, "a", 1.0), (2, text + " end", 6, "b", 2.0), (3, "other", 7, "c", 3.0)],
                                 "doc_id long, text string, _row int, _found_id string, _found_hash double")
    kept = dartminhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r._row for r in kept.collect()) == [5, 7]
    items = spark.createDataFrame([(9, " ".join(text.split()[:20]))], "item_id long, text string")
    for rows in (decontam.BROADCAST_ROWS, 0):
        clean = decontam.without_contaminated(docs, items, broadcast_rows=rows)
        assert clean.columns == docs.columns and [r.doc_id for r in clean.collect()] == [3]


def test_blocks_of_a_bucket_lose_no_link(spark, monkeypatch):
    """Many texts that share buckets but seldom link, in small blocks."""
    rng = random.Random(8)
    base = texts(6, 1, 80, 3000)[0][0].split()
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 3, 6, 12])):
            words[rng.randrange(80)] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    want = near_copies(rows)
    assert 3 < len({c for _, c in want.values()}) < 80
    for size in (dartminhash.BLOCK_BYTES, 4000):
        monkeypatch.setattr(dartminhash, "BLOCK_BYTES", size)
        got = dartminhash.near_duplicates(docs_of(spark, rows)).collect()
        assert {r.doc_id: (r.class_id, r.component_id) for r in got} == want
