"""Substring dedup by repeated-phrase automata.

A window of ``WINDOW`` words is named by the smallest hash among its
``SHINGLE``-word runs: equal windows have equal names wherever they stand,
and neighbouring windows share theirs, so a text falls into segments of one
name each. Names found in two places select the segments that can recur.
Those meet by name in shards; there the recurring windows are confirmed on
their words, compiled into Aho-Corasick automata, and every selected segment
is streamed through them to find each occurrence of each window.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import WordHashes, materialize, run_hashes, shuffle_partitions
from roadpulse.llm.registry import query, table

WINDOW = 20
SHINGLE = 5
SEGMENT = 64                 # windows of a segment at most
AUTOMATON = 20_000           # windows compiled into one automaton, about
BUCKET_BYTES = 16 << 20      # text of a bucket of documents, about
LAST = (1 << 63) - 1         # a null doc_id sorts after all others

KEYS = "p int, buckets binary, keys binary, tags binary"
NOTES = "b int, p int, keys binary, doc_id long, h1 long"
PARTS = ("kind string, b int, doc_id long, n_words long, kept_sha256 string, key long, seg long, words binary, "
         "start long, n_found long, places binary")
FIRSTS = "b int, seg long, at array<int>, doc array<long>, start array<long>"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def names(h: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Name of every window, and the run hashes they are the minima of."""
    runs = run_hashes(h, k)
    low, width, reach = runs, 1, window - k + 1
    while width < reach:
        step = min(width, reach - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    return low, runs


def segments(name: np.ndarray, most: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of the runs of one name."""
    cut = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
    length = np.diff(np.r_[cut, len(name)])
    parts = -(-length // most)
    inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(cut, parts) + inner * most
    return start, np.minimum(most, np.repeat(cut + length, parts) - start)


def code(name: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of a name, and what stands for it there; two names that share
    both only make more candidates."""
    return ((name >> np.uint64(32)) % np.uint64(n_parts)).astype(np.int64), name.astype(np.uint32)


def _keys(window: int, k: int, n_parts: int):
    """Names of every batch by shard, with their bucket and a tag of their
    text. A name that may stand for equal windows of one text comes with two
    tags."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            parts = [(np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
            for b, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                if len(words) < window:
                    continue
                name, runs = names(hashes.of(words), window, k)
                name = np.unique(name)
                value, count = np.unique(runs, return_counts=True)
                twice = name[among(name, value[count > 1])]
                tag = np.uint64(tag & 0xFFFFFFFFFFFFFFFF)
                n = len(name) + len(twice)
                parts.append((np.full(n, b, np.int32), np.r_[name, twice],
                              np.r_[np.full(len(name), tag), np.full(len(twice), ~tag)]))
            bucket, name, tags = (np.concatenate([x[i] for x in parts]) for i in range(3))
            shard, key = code(name, n_parts)
            order = np.lexsort((bucket, shard))
            bucket, shard, key, tags = bucket[order], shard[order], key[order], tags[order]
            ends = np.searchsorted(shard, np.arange(n_parts + 1))
            rows = [(p, *(x[i:j].tobytes() for x in (bucket, key, tags)))
                    for p, (i, j) in enumerate(zip(ends[:-1], ends[1:])) if i < j]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)]],
                ["p", "buckets", "keys", "tags"])
    return run


def among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def recurring(keys: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Sorted keys that come with two tags or more."""
    order = np.lexsort((tags, keys))
    keys, tags = keys[order], tags[order]
    return np.unique(keys[1:][(keys[1:] == keys[:-1]) & (tags[1:] != tags[:-1])])


def _select(shard: pa.Table) -> pa.Table:
    """What recurs of a shard, told to the buckets that asked."""
    bucket, key, tags = (np.concatenate([np.frombuffer(x, t) for x in shard[c].to_pylist()])
                         for c, t in (("buckets", np.int32), ("keys", np.uint32), ("tags", np.uint64)))
    on = among(key, recurring(key, tags))
    asked = np.unique((bucket[on].astype(np.uint64) << np.uint64(32)) | key[on])
    bucket, key = (asked >> np.uint64(32)).astype(np.int32), asked.astype(np.uint32)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else bucket
    n = len(starts)
    return pa.table({"b": pa.array(bucket[starts], pa.int32()),
                     "p": pa.array([shard["p"][0].as_py()] * n, pa.int32()),
                     "keys": pa.array([key[i:j].tobytes() for i, j in zip(starts, np.r_[starts[1:], len(key)])],
                                      pa.binary()),
                     "doc_id": pa.nulls(n, pa.int64()), "h1": pa.nulls(n, pa.int64())})


def selected(words: list[bytes], hashes: WordHashes, known: np.ndarray, window: int, k: int, n_parts: int):
    """(name, first window, windows) of a text's segments whose name recurs."""
    name, _ = names(hashes.of(words), window, k)
    start, length = segments(name)
    shard, key = code(name[start], n_parts)
    on = among((shard.astype(np.uint64) << np.uint64(32)) | key, known)
    return list(zip(name[start[on]].view(np.int64).tolist(), start[on].tolist(), length[on].tolist()))


def _notes(notes: pa.Table) -> tuple[np.ndarray, set]:
    """Names that recur (as shard and key), and the copies of earlier texts."""
    known, copies = [np.zeros(0, np.uint64)], set()
    for p, keys, doc_id, h1 in zip(*(notes[c].to_pylist() for c in ("p", "keys", "doc_id", "h1"))):
        if p >= 0:
            known.append((np.uint64(p) << np.uint64(32)) | np.frombuffer(keys, np.uint32).astype(np.uint64))
        else:
            copies.add((doc_id, h1))
    return np.unique(np.concatenate(known)), copies


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def seg_id(words: bytes) -> int:
    """Names a segment within its bucket."""
    return xxhash.xxh3_64_intdigest(words) - (1 << 63)


def _pick(window: int, k: int, n_parts: int):
    """A bucket's documents: finished ones, those with segments that may
    recur, and each different such segment with its first place."""
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        known, copies = _notes(notes)
        hashes, squeeze, rows, found = WordHashes(), zstandard.ZstdCompressor(), [], {}
        for b, doc_id, h1, text in zip(*(docs[c].to_pylist() for c in ("b", "doc_id", "h1", "text"))):
            words = (text or "").encode().split()
            place = LAST if doc_id is None else doc_id
            copy = len(words) >= window and (place, h1) in copies
            mine = [] if copy or len(words) < window else selected(words, hashes, known, window, k, n_parts)
            if not mine:
                kept = [] if copy else words
                rows.append(("done", b, doc_id, len(words), _digest(kept), *[None] * 4, len(words) - len(kept), None))
                continue
            places = []
            for name, start, length in mine:
                part = b" ".join(words[start:start + length + window - 1])
                at, n = found.get(part, ((LAST, LAST, name), 0))
                found[part] = (min(at, (place, start, name)), n + 1)
                places.append((seg_id(part), start, length))
            rows.append(("doc", b, doc_id, len(words), *[None] * 3, squeeze.compress(b" ".join(words)), None, None,
                         np.array(places, "<i8").tobytes()))
        b = docs["b"][0].as_py() if len(docs) else None
        rows += [("seg", b, place, None, None, name, seg_id(part), part, start, n, None)
                 for part, ((place, start, name), n) in found.items()]
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(),
                 pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                        names=[c.split()[0] for c in PARTS.split(", ")])
    return run


def first_places(parts: list[tuple[bytes, int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """For segments (words, doc, start, times found): the earliest place of
    each of their windows, as runs (first window, doc, start)."""
    ids: dict[bytes, int] = {}
    seqs = [tuple(ids.setdefault(w, len(ids)) for w in words.split()) for words, *_ in parts]
    # Confirm: windows whose words stand in two places.
    times: dict[tuple, int] = defaultdict(int)
    for seq, (_, _, _, n) in zip(seqs, parts):
        for i in range(len(seq) - window + 1):
            times[seq[i:i + window]] += n
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    passages = [w for w, n in times.items() if n > 1]
    for i, w in enumerate(passages):
        automaton.add_word(w, i)
    first: list = [None] * len(passages)
    places: list[list[tuple[int, int]]] = [[] for _ in parts]
    if passages:
        automaton.make_automaton()
        for s, (seq, (_, doc, start, _)) in enumerate(zip(seqs, parts)):
            for end, i in automaton.iter(seq):
                at = end - window + 1
                places[s].append((at, i))
                if first[i] is None or (doc, start + at) < first[i]:
                    first[i] = (doc, start + at)
    out = []
    for found in places:
        runs = []
        for at, i in found:
            doc, start = first[i]
            if runs and runs[-1][3] == at and runs[-1][1] == doc and runs[-1][2] + at - runs[-1][0] == start:
                runs[-1][3] = at + 1
            else:
                runs.append([at, doc, start, at + 1])
        out.append(runs)
    return out


def _locate(window: int, size: int):
    def run(shard: pa.Table) -> pa.Table:
        rows = list(zip(*(shard[c].to_pylist() for c in ("b", "seg", "key", "words", "doc_id", "start", "n_found"))))
        n_groups = 1 + len(rows) * 8 // size
        groups = defaultdict(list)
        for r in rows:
            groups[r[2] % n_groups].append(r)
        out = []
        for group in groups.values():
            found = first_places([(r[3], r[4], r[5], r[6]) for r in group], window)
            out += [(r[0], r[1], runs) for r, runs in zip(group, found) if runs]
        return pa.table({
            "b": pa.array([r[0] for r in out], pa.int32()), "seg": pa.array([r[1] for r in out], pa.int64()),
            "at": pa.array([[x for q in r[2] for x in (q[0], q[3])] for r in out], pa.list_(pa.int32())),
            "doc": pa.array([[q[1] for q in r[2]] for r in out], pa.list_(pa.int64())),
            "start": pa.array([[q[2] for q in r[2]] for r in out], pa.list_(pa.int64()))})
    return run


def _remove(window: int):
    """A bucket's documents without the words of windows found earlier."""
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        firsts = {seg: list(zip(at[::2], at[1::2], doc, start)) for seg, at, doc, start in
                  zip(*(notes[c].to_pylist() for c in ("seg", "at", "doc", "start")))}
        open_up, rows = zstandard.ZstdDecompressor(), []
        for doc_id, packed, places in zip(*(docs[c].to_pylist() for c in ("doc_id", "words", "places"))):
            words = open_up.decompress(packed).split(b" ")
            place = LAST if doc_id is None else doc_id
            change = np.zeros(len(words) + 1, np.int64)
            for seg, s, _ in np.frombuffer(places, "<i8").reshape(-1, 3).tolist():
                for i, j, doc, start in firsts.get(seg, ()):
                    if (doc, start) != (place, s + i):
                        change[s + i] += 1
                        change[s + j - 1 + window] -= 1
            keep = np.cumsum(change[:-1]) == 0
            kept = [w for w, on in zip(words, keep.tolist()) if on]
            rows.append((doc_id, len(words), len(words) - len(kept), _digest(kept)))
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[c.split()[0] for c in RESULT.split(", ")])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = SHINGLE, doc_id: str = "doc_id",
                   text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, without
    the words of windows of ``window`` words that start earlier elsewhere
    (smaller doc_id, or same document, earlier start).

    Documents are dealt into buckets by a hash of doc_id, window names into
    shards by themselves; buckets and shards grow in number with the input,
    and ask and answer each other in packed rows. Copies of a text lose
    everything to the first one and take no further part, so the size of a
    group of copies does not matter. A bucket sends a segment once, however
    often it holds it.

    Null and empty texts have no words; texts shorter than a window keep
    everything. A null doc_id sorts after all others; rows of equal doc_id
    count as one document for "earlier". Other columns are not read; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    place = F.coalesce("doc_id", F.lit(LAST))
    ids = materialize(docs.filter(F.col("text").isNotNull()).select(
        place.alias("doc_id"), F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(7)).alias("h2"),
        F.length("text").alias("n"), F.octet_length("text").alias("size")))
    size = ids.agg(F.sum("size")).first()[0] or 0
    n = max(shuffle_partitions(spark), -(-size // bucket_bytes))

    def bucket(doc_id):
        return F.pmod(F.xxhash64(doc_id), F.lit(n)).cast("int").alias("b")

    docs = docs.select(bucket(place), "doc_id", F.xxhash64("text").alias("h1"), "text")
    keys = docs.select("b", "h1", "text").mapInArrow(_keys(window, k, n), KEYS)
    notes = keys.groupBy("p").applyInArrow(_select, NOTES)
    first = ids.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = (ids.join(first.filter("first < last"), ["h1", "h2", "n"]).filter("doc_id > first")
              .select(bucket("doc_id"), F.lit(-1).alias("p"), F.lit(None).cast("binary").alias("keys"), "doc_id", "h1"))
    notes = notes.unionByName(copies)
    parts = materialize(docs.groupBy("b").cogroup(notes.groupBy("b")).applyInArrow(_pick(window, k, n), PARTS))

    done = parts.filter("kind = 'done'").select("doc_id", "n_words", F.col("n_found").alias("n_removed"),
                                                "kept_sha256")
    shard = F.pmod(F.xxhash64("key"), F.lit(n)).alias("shard")
    segs = parts.filter("kind = 'seg'").select(shard, "b", "seg", "key", "words", "doc_id", "start", "n_found")
    firsts = segs.groupBy("shard").applyInArrow(_locate(window, AUTOMATON), FIRSTS)
    rest = parts.filter("kind = 'doc'").select("b", "doc_id", "words", "places")
    cleaned = rest.groupBy("b").cogroup(firsts.groupBy("b")).applyInArrow(_remove(window), RESULT)
    return done.unionByName(cleaned)


SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, len(w) AS n, unnest(w) AS word FROM words
), starts AS (
    SELECT doc_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos
                                                       ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS words FROM places
), windows AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY words ORDER BY doc_id, pos) AS nth
    FROM starts WHERE pos <= n - 19
), gone AS (
    SELECT DISTINCT doc_id, pos + unnest(range(20)) AS pos FROM windows WHERE nth > 1
), kept AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.pos) AS text, COUNT(*) AS n
    FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op7_repeated_phrases", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
