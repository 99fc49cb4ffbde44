"""Periodic runs of words, by recompression.

The words of a batch of documents form one string, a unique mark before,
between and after them. Recompression turns it into a run-length grammar:
rounds of block compression (``aaa`` becomes one symbol) and pair compression
(``ab`` becomes one symbol, ``a`` from the left half of the alphabet and
``b`` from the right) alternate until one symbol is left (Jez 2013). Equal
pieces of the string are parsed alike but for a few symbols at their ends, so
the grammar answers how far two places agree, in either direction, by going up
while both places stand at the edge of a symbol and down from the first
difference (I 2017). No suffix array is built.

A run of period q and three periods or more covers three consecutive points of
the grid 0, q, 2q, ...; points whose words agree are candidates, and two such
queries give the exact ends of the run. The grids of all periods together have
n log n points.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import mix64
from roadpulse.llm.registry import query, table

LEAST_WORDS = 24
LEAST_PERIODS = 3
BATCH_WORDS = 200_000    # documents are parsed together up to so many words
TRIES = 4                # alphabets tried for a round of pair compression

RUN = "struct<start:long,length:long,period:long>"
RUNS = f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, collapsed binary"


@dataclass
class Round:
    """One round: the symbols it read and what each became a part of."""
    symbols: np.ndarray   # what the round read
    up: np.ndarray        # place of a symbol's parent in the next round
    child: np.ndarray     # first child of each parent; one more at the end
    block: bool           # block compression (else pair compression)


def _names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal (a, b), from 0 on."""
    key = a.astype(np.int64) * (int(b.max()) + 1) + b
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def _pairs(s: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Where a symbol of the left half meets one of the right half, for the
    best of some splits of the alphabet; one pair at least."""
    best, most = None, 0
    names = np.arange(int(s.max()) + 1, dtype=np.uint64)
    tries = 0
    while tries < TRIES or not most:
        seed += 1
        tries += 1
        right = (mix64(names + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & np.uint64(1)).astype(bool)[s]
        pair = ~right[:-1] & right[1:]
        n = int(pair.sum())
        if n > most:
            best, most = pair, n
    return best, seed


def grammar(text: np.ndarray) -> list[Round]:
    """Rounds of recompression of a string of numbers, down to one symbol."""
    s, rounds, seed = text.astype(np.int32), [], 0
    while len(s) > 1:
        first = np.r_[True, s[1:] != s[:-1]]
        if not first.all():
            starts = np.flatnonzero(first)
            rounds.append(Round(s, (np.cumsum(first) - 1).astype(np.int32),
                                np.r_[starts, len(s)].astype(np.int32), True))
            s = _names(s[starts], np.diff(np.r_[starts, len(s)]))
            if len(s) == 1:
                break
        pair, seed = _pairs(s, seed)
        first = np.r_[True, ~pair]
        starts = np.flatnonzero(first)
        rounds.append(Round(s, (np.cumsum(first) - 1).astype(np.int32),
                            np.r_[starts, len(s)].astype(np.int32), False))
        two = np.r_[pair, False][starts]
        s = _names(s[starts], np.where(two, s[np.minimum(starts + 1, len(s) - 1)].astype(np.int64) + 1, 0))
    return rounds


def agreement(rounds: list[Round], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many symbols of the string agree from places ``a`` and ``b`` on,
    to the right (``step`` 1) or to the left (-1), the places included. Both
    ends of the string must be symbols found nowhere else, and a != b."""
    x, y = a.astype(np.int64), b.astype(np.int64)
    level = np.zeros(len(x), np.int16)

    def edge(r: Round, place: np.ndarray) -> np.ndarray:
        """First (last) child of the parents at ``place``."""
        return (r.child[place] if step > 0 else r.child[place + 1] - 1).astype(np.int64)

    def advance(r: Round, at: np.ndarray) -> np.ndarray:
        """Move the queries ``at`` over what agrees here; which of them did."""
        i, j = x[at], y[at]
        same = r.symbols[i] == r.symbols[j]
        at, i, j = at[same], i[same], j[same]
        move = np.ones(len(at), np.int64)
        if r.block:   # to the end of the shorter rest of a block
            p, q = r.up[i], r.up[j]
            move = np.minimum(r.child[p + 1] - i, r.child[q + 1] - j) if step > 0 \
                else np.minimum(i - r.child[p], j - r.child[q]) + 1
        x[at], y[at] = i + step * move, j + step * move
        return at

    live = np.arange(len(x))
    for depth, r in enumerate(rounds):
        if not len(live):
            break
        level[live] = depth

        def at_edge(at):
            return (edge(r, r.up[x[at]]) == x[at]) & (edge(r, r.up[y[at]]) == y[at])

        even = at_edge(live)
        moved = advance(r, live[~even])
        even = live[even]
        even = even[r.symbols[x[even]] == r.symbols[y[even]]]   # else this is where they differ
        live = np.concatenate([even, moved[at_edge(moved)]])
        x[live], y[live] = r.up[x[live]], r.up[y[live]]
    for depth in range(int(level.max(initial=0)), -1, -1):
        r = rounds[depth]
        here = np.flatnonzero(level >= depth)
        todo = here
        while len(todo):
            todo = advance(r, todo)
        if depth:
            below = rounds[depth - 1]
            x[here], y[here] = edge(below, x[here]), edge(below, y[here])
    return np.abs(x - a)


def _inside(found: list[np.ndarray], low: int, candidates: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Candidates (place, of sorted periods from ``low`` to below twice that)
    that lie with their two next grid points inside a run whose period
    divides theirs: they would give that run again."""
    start, end, period = found
    high = np.minimum(2 * low - 1, (end - start) // 2)
    first = -(-low // period) * period
    times = np.maximum(0, (high - first) // period + 1)
    run = np.repeat(np.arange(len(start)), times)
    multiple = first[run] + (np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)) * period[run]
    width = int(candidates.max(initial=0)) + 1
    key = periods * width + candidates
    near = lambda place: np.clip(place, 0, width)
    a = np.searchsorted(key, multiple * width + near(start[run]))
    b = np.searchsorted(key, multiple * width + near(end[run] - 2 * multiple))
    b = np.maximum(a, b)
    cover = np.bincount(a, minlength=len(key) + 1) - np.bincount(b, minlength=len(key) + 1)
    return np.cumsum(cover[:-1]) > 0


def periodic_runs(text: np.ndarray, longest: int, least: int = LEAST_WORDS,
                  periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of a string of numbers, sorted by
    start and period: maximal stretches of smallest period q that are at
    least ``least`` symbols and ``periods`` (3 or more) periods long. Symbols
    found once end every stretch; the first and the last symbol must be such,
    and no stretch between two of them is longer than ``longest``."""
    if periods < 3:
        raise ValueError("runs of fewer than three periods need not cover three grid points")
    found = [np.zeros(0, np.int64)] * 3
    rounds = None
    low = 1
    while low <= longest // periods:
        places, of = [], []
        for q in range(low, min(2 * low, longest // periods + 1)):
            grid = text[::q]
            hit = grid[:-1] == grid[1:]
            at = np.flatnonzero(hit[:-1] & hit[1:])
            if len(at):
                places.append(at * q)
                of.append(np.full(len(at), q, np.int64))
        if places:
            at, q = np.concatenate(places), np.concatenate(of)
            fresh = ~_inside(found, low, at, q)
            at, q = at[fresh], q[fresh]
            if len(at):
                rounds = rounds if rounds is not None else grammar(text)
                end = at + q + agreement(rounds, at, at + q, 1)
                start = at - agreement(rounds, at - 1, at + q - 1, -1)
                long = end - start >= np.maximum(least, periods * q)
                new = [np.r_[old, x[long]] for old, x in zip(found, (start, end, q))]
                # A stretch that has several periods keeps the smallest.
                order = np.lexsort((new[2], new[1], new[0]))
                new = [x[order] for x in new]
                once = np.r_[True, (new[0][1:] != new[0][:-1]) | (new[1][1:] != new[1][:-1])][:len(order)]
                found = [x[once] for x in new]
        low *= 2
    order = np.lexsort((found[2], found[0]))
    return tuple(x[order] for x in found)


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def _best(runs: list[dict]) -> dict | None:
    """The run of greatest exact length / period, then smallest start, then
    smallest period."""
    best = None
    for r in runs:   # by start, then period
        if best is None or r["length"] * best["period"] > best["length"] * r["period"]:
            best = r
    return best


def _find(least: int, periods: int, batch_words: int):
    def parsed(ids, texts):
        numbers = _Numbers()
        parts, starts, at = [np.full(1, -1)], [], 1
        for words in texts:
            starts.append(at)
            parts += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), np.full(1, -1)]
            at += len(words) + 1
        text = np.concatenate(parts)
        marks = np.flatnonzero(text < 0)
        text[marks] = len(numbers) + np.arange(len(marks))
        start, end, period = periodic_runs(text, max(map(len, texts)), least, periods)
        gone = np.zeros(len(text) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, end, -1)
        gone = np.cumsum(gone) > 0
        first = np.searchsorted(start, starts)
        last = np.r_[first[1:], len(start)]
        rows = []
        for k, words in enumerate(texts):
            a, b, base = first[k], last[k], starts[k]
            runs = [{"start": int(s) - base, "length": int(e - s), "period": int(q)}
                    for s, e, q in zip(start[a:b], end[a:b], period[a:b])]
            kept = words if not runs else [w for w, g in zip(words, gone[base:base + len(words)].tolist()) if not g]
            rows.append((ids[k], len(words), runs, _best(runs), b" ".join(kept)))
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        kinds = (pa.int64(), pa.int64(), pa.list_(run), run, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          ["doc_id", "n_words", "runs", "best", "collapsed"])

    def run(batches):
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (t.as_py() or b"").split()
                if texts and held + len(words) > batch_words:
                    yield parsed(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(words)
                held += len(words) + 1
        if texts:
            yield parsed(ids, texts)
    return run


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS,
              batch_words: int = BATCH_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) of every row.

    ``runs`` are the maximal stretches of words with smallest period q, at
    least ``least`` words and ``periods`` periods long, by start and period;
    ``best`` is the one of greatest length / period (ties: smallest start,
    then smallest period), null without a run. ``collapsed`` (UTF-8) is the text without the
    words that repeat: all that a run contains after its first period, kept
    words joined by one space. Words are what stands between ASCII white
    space, compared byte by byte.

    Nothing is shuffled. Documents are parsed together up to ``batch_words``
    words, a longer one alone: memory is one batch or the longest document
    (about 150 bytes a word). A null or empty text has no words, no run and an
    empty ``collapsed``; a null doc_id is carried; repeated rows are parsed
    once each; overlapping runs each count and a word goes if any of them
    drops it. Other columns are not read; an empty table gives no rows.
    """
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return picked.mapInArrow(_find(least, periods, batch_words), RUNS)


def _periodic_tail(ids: list, texts: pa.Array) -> pa.Array:
    """The contract's periodic tails: words from ``a`` on repeat those from
    ``a`` to ``a + p``."""
    out = []
    for i, t in zip(ids, texts):
        words = (t.as_py() or b"").split()
        n, g = len(words), zlib.crc32(str(i).encode()) // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            tail = words[a:a + p]
            words[a:] = (tail * ((n - a) // p + 1))[:n - a]
        out.append(b" ".join(words))
    return pa.array(out, pa.binary())


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes) with the contract's periodic tails: a tenth of
    the documents, by crc32 of the id, end in a repeated stretch. Rows without
    an id stay as they are."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            hit = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in ids]
            mask = pa.array(hit, pa.bool_())
            new = _periodic_tail([i for i, h in zip(ids, hit) if h], texts.filter(mask))
            place = np.cumsum(hit) - 1
            both = pa.chunked_array([texts, new.cast(texts.type)])
            take = np.where(hit, len(texts) + place, np.arange(len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), both.take(pa.array(take)).combine_chunks()],
                                             ["doc_id", "text"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return picked.mapInArrow(run, "doc_id long, text binary")


@query("op12_recompression_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                   F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
