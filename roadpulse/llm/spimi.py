"""Differences between the sources of a language, from an inverted index that
is built in a single pass.

Every task scans its documents once and keeps postings (language and term;
source; occurrences and documents) in a block. When the block is full it is
cut by hash shards and spilled as a run sorted by term, and an empty block is
begun (Heinz and Zobel 2003). A shard's runs are merged with a heap, a
bounded number at a time, into frequencies; terms that too few documents of
their language hold fall out there.

Sources are compared term by term without a table of all terms by all
sources. The sum over terms of |p - q| is the sum of p plus the sum of q less
twice the sum of min(p, q). Absent terms share one value per source, so the
last sum is known up to corrections for the terms that are there: one per
posting, and one per pair of postings of a term, streamed over the shards.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import discard, materialize, shuffle_partitions
from roadpulse.llm.registry import query, table

LEAST_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000
BLOCK_POSTINGS = 400_000   # a block is full
PART_POSTINGS = 2_048      # postings in one row of a run
MERGE_POSTINGS = 200_000   # postings of merged parts summed up at once, about
FAN_IN = 256               # runs merged at once
SLICE = 4 << 20            # bytes of a text split into words at once
PAIRS = 2_000_000          # pairs of postings expanded at once
CELLS = 8_000_000          # sums of pairs held at once
SHARD_POSTINGS = 200_000   # kept postings of a language compared in one task, about

RUN = "shard int, run long, part int, first binary, postings binary"
RUN_COLUMNS = ["shard", "run", "part", "first", "postings"]
POSTING = ["key", "source", "count", "docs"]
KEPT = "lang binary, term binary, sources array<binary>, counts array<long>"

# A-Z become a-z, all other characters that are no part of a term a blank.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, ``SLICE`` bytes at a time."""
    text = text.translate(TERMS)
    at = 0
    while len(text) - at > SLICE:
        cut = text.find(b" ", at + SLICE)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut
    yield text[at:].split() if at else text.split()


def _sorted(postings: pa.Table) -> pa.Table:
    return postings.take(pc.sort_indices(postings, [("key", "ascending"), ("source", "ascending")]))


def _run_rows(postings: pa.Table, shard: int, run: int, first: int = 0) -> Iterator[pa.RecordBatch]:
    """Sorted postings of a shard as rows of a run, ``PART_POSTINGS`` each,
    packed: sorted keys share most of their bytes."""
    for part, at in enumerate(range(0, len(postings), PART_POSTINGS), first):
        some = postings.slice(at, PART_POSTINGS).combine_chunks()
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(some)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([run], pa.int64()), pa.array([part], pa.int32()),
             pa.array([some.column("key")[0].as_py()], pa.binary()),
             pa.array([out.getvalue().to_pybytes()], pa.binary())], RUN_COLUMNS)


def _spill(shards: int, block_postings: int):
    """Blocks of postings of a task's documents, spilled as sorted runs. The
    empty term stands for a group's documents."""
    def run(batches):
        count, docs = defaultdict(Counter), defaultdict(Counter)
        run_id = TaskContext.get().partitionId() << 24

        def spilled():
            nonlocal run_id
            block = []
            for (lang, source), terms in count.items():
                keys = [lang + b"\0" + term for term in terms]
                block.append(pa.table([
                    pa.array(keys, pa.binary()), pa.array([source], pa.binary()).take(pa.array(np.zeros(len(keys), int))),
                    pa.array(np.fromiter(terms.values(), np.int64, len(keys))),
                    pa.array(np.fromiter(map(docs[lang, source].__getitem__, terms), np.int64, len(keys))),
                    pa.array(np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % shards)], [*POSTING, "shard"]))
            count.clear()
            docs.clear()
            if block:
                whole = pa.concat_tables(block)
                shard = whole.column("shard").to_numpy()
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                for k in range(shards):
                    mine = whole.take(pa.array(order[cuts[k]:cuts[k + 1]])).select(POSTING)
                    yield from _run_rows(_sorted(mine), k, run_id)
            run_id += 1

        held = 0
        for batch in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns)):
                counts, in_docs = count[lang, source], docs[lang, source]
                held -= len(counts)
                seen = {b""}
                for terms in _slices(text):
                    counts.update(terms)
                    seen.update(terms)
                counts[b""] += 1
                in_docs.update(seen)
                held += len(counts)
                if held >= block_postings:
                    yield from spilled()
                    held = 0
        yield from spilled()
    return run


def _merged(runs: pa.Table) -> Iterator[pa.Table]:
    """The postings of all runs of a shard in order, those of one key and
    source added up; a key's postings come in one table.

    A heap holds the next part of every run by its first key. Parts are taken
    in that order; what lies before the first key of all parts still to come
    is complete."""
    parts = defaultdict(list)
    first, packed = runs.column("first"), runs.column("postings")
    for k, (r, p) in enumerate(zip(runs.column("run").to_pylist(), runs.column("part").to_pylist())):
        parts[r].append((p, k))
    waiting = [iter([k for _, k in sorted(mine)]) for mine in parts.values()]
    heap: list[tuple[bytes, int, int]] = []

    def push(run: int) -> None:
        if (k := next(waiting[run], None)) is not None:
            heapq.heappush(heap, (first[k].as_py(), run, k))

    for run in range(len(waiting)):
        push(run)
    held, rows, enough = [], 0, MERGE_POSTINGS
    while heap:
        _, run, k = heapq.heappop(heap)
        push(run)
        held.append(pa.ipc.open_stream(packed[k].as_buffer()).read_all())
        rows += len(held[-1])
        if heap and rows < enough:
            continue
        got = _sorted(pa.concat_tables(held)).combine_chunks()
        keys, source, n, docs = (c.chunk(0) for c in got.columns)
        upto = len(got) if not heap else int(pc.sum(pc.less(keys, pa.scalar(heap[0][0], keys.type))).as_py() or 0)
        held, rows = [got.slice(upto)], len(got) - upto
        enough = max(MERGE_POSTINGS, 2 * rows)
        if upto:
            other = pc.or_(pc.not_equal(keys[1:upto], keys[:upto - 1]), pc.not_equal(source[1:upto], source[:upto - 1]))
            starts = np.r_[0, np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1]
            yield pa.table([keys.take(pa.array(starts)), source.take(pa.array(starts)),
                            *[pa.array(np.add.reduceat(c.to_numpy()[:upto], starts)) for c in (n, docs)]], POSTING)


def _merge_runs(keys: tuple[pa.Scalar, ...], runs: pa.Table) -> pa.Table:
    """One run of several."""
    shard, wave = (k.as_py() for k in keys)
    rows = []
    for postings in _merged(runs):
        rows += _run_rows(postings, shard, wave, len(rows))
    return pa.Table.from_batches(rows)


def _frequencies(least_docs: int):
    """Terms of a shard that enough documents of their language hold, with
    their count by source; and of the empty term the documents by source."""
    def run(runs: pa.Table) -> pa.Table:
        rows = []
        for postings in _merged(runs):
            keys = postings.column("key").combine_chunks()
            if isinstance(keys, pa.ChunkedArray):
                keys = keys.chunk(0)
            counts, docs = (postings.column(c).to_numpy() for c in ("count", "docs"))
            first = np.r_[0, np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1]
            last = np.r_[first[1:], len(keys)]
            enough = np.add.reduceat(docs, first) >= least_docs
            group = pc.equal(pc.binary_slice(keys.take(pa.array(first)), -1), b"\0").to_numpy(zero_copy_only=False)
            for a, b in zip(first[enough | group].tolist(), last[enough | group].tolist()):
                lang, _, term = keys[a].as_py().rpartition(b"\0")
                rows.append((lang, term, postings.column("source")[a:b].to_pylist(), counts[a:b]))
        kinds = (pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
        cols = list(zip(*rows)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["lang", "term", "sources", "counts"])
    return run


def term_frequencies(docs: DataFrame, least_docs: int = LEAST_DOCS, block_postings: int = BLOCK_POSTINGS,
                     fan_in: int = FAN_IN) -> DataFrame:
    """(lang, term, sources, counts), as bytes: the terms that at least
    ``least_docs`` documents of a language hold and how often each source has
    them. A row with the empty term has the sources of a language and their
    documents.

    One scan; blocks of ``block_postings`` postings are spilled as runs cut by
    as many hash shards as Spark shuffles to, and written to the shared
    folder. While a shard has more than ``fan_in`` runs, that many are merged
    into one, so a merge holds a bounded number of slices of blocks however
    many documents a language or source has; the last merge sums up."""
    spark = docs.sparkSession
    shards = shuffle_partitions(spark)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    picked = docs.select(text.alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c)
                                               for c in ("lang", "source")])
    runs = materialize(picked.mapInArrow(_spill(shards, block_postings), RUN))
    while True:
        per_shard = runs.select("shard", "run").distinct().groupBy("shard").count()
        most = per_shard.agg(F.max("count")).first()[0] or 0
        if most <= fan_in:
            break
        wave = F.pmod(F.xxhash64("run"), F.lit(-(-2 * most // fan_in))).alias("wave")
        merged = materialize(runs.withColumn("wave", wave).groupBy("shard", "wave").applyInArrow(_merge_runs, RUN))
        discard(runs)
        runs = merged
    return materialize(runs.groupBy("shard").applyInArrow(_frequencies(least_docs), KEPT))


def _share(count: np.ndarray, total: int, smoothing: int) -> np.ndarray:
    """1 + floor(SCALE * (count + smoothing) / total), exactly: a long
    division by three decimal digits at a time."""
    total = max(1, total)
    rest, out = count.astype(np.int64) + smoothing, np.zeros(len(count), np.int64)
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _compare(smoothing: int, top_terms: int):
    """Of one shard of a language's kept terms: the sum of |p - q| for each
    pair of its sources, and each source's terms furthest above the language."""
    def run(terms: pa.Table, groups: pa.Table) -> pa.Table:
        lang = groups.column("lang")[0].as_py()
        sizes, n_terms, n_lang = (groups.column(c)[0].as_py() for c in ("sizes", "n_terms", "n_lang"))
        sources = [s["source"] for s in sizes]
        place = {s: k for k, s in enumerate(sources)}
        size = [s["n"] + smoothing * n_terms for s in sizes]
        n = len(sources)
        terms = terms.sort_by("term")
        names = terms.column("term").to_pylist()
        lists = terms.column("sources").to_pylist()
        width = np.array([len(x) for x in lists], np.int64)
        source = np.fromiter((place[s] for s in chain.from_iterable(lists)), np.int64, int(width.sum()))
        count = np.fromiter(chain.from_iterable(terms.column("counts").to_pylist()), np.int64, len(source))
        term = np.repeat(np.arange(len(width)), width)
        order = np.lexsort((source, term))
        source, count = source[order], count[order]

        absent = np.array([_share(np.zeros(1, np.int64), d, smoothing)[0] for d in size], np.int64)
        share = np.zeros(len(source), np.int64)
        for s in range(n):
            mine = source == s
            share[mine] = _share(count[mine], size[s], smoothing)
        out = []

        # Terms of a source above its language.
        all_ = np.zeros(len(width), np.int64)
        np.add.at(all_, term, count)
        above = share - _share(all_, n_lang + smoothing * n_terms, smoothing)[term]
        best = np.lexsort((term, -above, source))
        best = best[above[best] > 0]
        first = np.searchsorted(source[best], np.arange(n))
        best = best[np.arange(len(best)) - first[source[best]] < top_terms]
        out += [(lang, sources[source[k]], b"term", names[term[k]], int(above[k])) for k in best.tolist()]

        # Pairs of sources a < b, a block of a at a time.
        whole = absent * len(width)
        np.add.at(whole, source, share - absent[source])
        by_source = [np.sort(share[source == s]) for s in range(n)]
        summed = [np.r_[0, np.cumsum(x)] for x in by_source]
        ends = np.cumsum(width)[term] if len(term) else term

        def alone(s: int, limit: np.ndarray) -> np.ndarray:
            """What the postings of s add to the sum of min(p, limit)."""
            below = np.searchsorted(by_source[s], limit)
            return summed[s][below] + (len(by_source[s]) - below) * limit - len(by_source[s]) * np.minimum(absent[s], limit)

        step = max(1, CELLS // max(1, n))
        for low in range(0, n, step):
            block = slice(low, min(n, low + step))
            both = np.minimum(absent[block, None], absent[None, :]) * len(width)
            for s in range(low, block.stop):
                both[s - low] += alone(s, absent)
            for s in range(n):
                both[:, s] += alone(s, absent[block])
            left = np.flatnonzero((source >= low) & (source < block.stop))
            later = ends[left] - left - 1   # postings of the term after this one
            cuts = np.flatnonzero(np.diff(np.r_[-1, np.cumsum(later) // PAIRS]))
            for a, b in zip(cuts, np.r_[cuts[1:], len(left)]):
                i, times = left[a:b], later[a:b]
                x = np.repeat(i, times)
                y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(times) - times, times)
                p, q, p0, q0 = share[x], share[y], absent[source[x]], absent[source[y]]
                np.add.at(both, (source[x] - low, source[y]), np.minimum(p, q) - np.minimum(p, q0)
                          - np.minimum(p0, q) + np.minimum(p0, q0))
            far = whole[block, None] + whole[None, :] - 2 * both
            out += [(lang, sources[a], b"pair", sources[b], int(far[a - low, b]))
                    for a in range(low, block.stop) for b in range(a + 1, n)]
        kinds = (pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["lang", "source", "part", "item", "value"])
    return run


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
                      smoothing: int = SMOOTHING, block_postings: int = BLOCK_POSTINGS,
                      fan_in: int = FAN_IN) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source).

    Terms are runs of letters A-Z (lower-cased), a-z and all characters from
    U+0080 on. A language keeps the terms that ``least_docs`` of its documents
    hold. With V kept terms, N occurrences of them and c of one term, a group
    or language gives the term p = 1 + floor(10^9 (c + smoothing) /
    (N + smoothing V)). Rows of part ``pair``: each other source of the
    language, value the sum of |p - q| over kept terms (0 without one). Rows of
    part ``term``: kept terms of the group with p above the language's q, value
    p - q, the ``top_terms`` first. ``rank`` counts from 1 by value descending
    and item ascending (UTF-8). All arithmetic is exact up to 9 * 10^15
    occurrences.

    Null text, lang and source count as empty. Repeated rows are documents of
    their own. Texts of any length are split a slice at a time. Other columns
    are not read; an empty table gives no rows. A hot source or language is
    cut by hash of its terms; a task holds some slices of blocks, or one
    shard of a language's kept terms with the language's sources and a block
    of its pairs. The frequencies are one row per kept term; pairs of sources
    leave a task summed up over its terms.
    """
    kept = term_frequencies(docs, least_docs, block_postings, fan_in)
    words = kept.filter("octet_length(term) > 0")
    flat = kept.select("lang", (F.octet_length("term") > 0).alias("word"),
                       F.explode(F.arrays_zip("sources", "counts")).alias("p"))
    n = F.sum(F.when(F.col("word"), F.col("p.counts")).otherwise(0))
    sizes = flat.groupBy("lang", F.col("p.sources").alias("source")).agg(n.alias("n"))
    vocabulary = words.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    per_lang = (sizes.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sizes"),
                                          F.sum("n").alias("n_lang"))
                .join(vocabulary, "lang", "left").na.fill(0, ["n_terms"]))
    postings = words.agg(F.sum(F.size("sources"))).first()[0] or 0
    shards = max(1, -(-postings // SHARD_POSTINGS))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).alias("shard")
    spread = per_lang.select(F.col("lang").alias("lang"), "sizes", "n_lang", "n_terms").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    found = (words.select("*", shard).groupBy("lang", "shard").cogroup(spread.groupBy("lang", "shard"))
             .applyInArrow(_compare(smoothing, top_terms),
                           "lang binary, source binary, part binary, item binary, value long"))
    found = materialize(found.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "part", "item")], "value"))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    turned = pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = (pairs.unionByName(turned).unionByName(found.filter("part = 'term'"))
              .withColumn("rank", F.row_number().over(order)))
    return ranked.filter(f"part = 'pair' OR rank <= {int(top_terms)}")


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), occurrences AS (
    SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS c FROM occurrences GROUP BY lang, term HAVING count(DISTINCT d) >= 30
), langs AS (
    SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS c FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), sizes AS (
    SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c,
           1 + (1000000000::HUGEINT * (coalesce(x.c, 0) + 5)) // (g.n + 5 * l.v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v)::HUGEINT AS q
    FROM sizes g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN counts x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), far AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""


@query("op13_spimi_source_divergence", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))
