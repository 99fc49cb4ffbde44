"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions, each with its own binary context tree
over the preceding bytes. A node holds how often each bit followed its
context in the training texts; its Krichevsky-Trofimov estimate is mixed
with the product of its children's weighted probabilities, half and half, up
to ``DEPTH`` bytes (Willems, Shtarkov, Tjalkens 1995). A byte's probability
is the product of the mixtures along its eight paths, and the code length of
a text is minus their log2 per byte.

The tree is counted and evaluated in parts: the contexts that share their
last two bytes are one subtree, the nodes above (at most 65,793 contexts)
are common to all parts.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import WordHashes, id_mod5, materialize, mix64, shuffle_partitions
from roadpulse.llm.registry import query, table

DEPTH = 5                    # context bytes; with the byte itself a gram has 6
START, END = 0xFE, 0xFF      # before and after a text: bytes UTF-8 never has
SHARD_BYTES = 8 << 20        # text whose grams make up a shard, about
HALF = math.log(0.5)

KEYS = "p int, b long, keys binary, counts binary"
ANSWERS = "b long, p int, check long, values binary"


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series after shifting x above 8."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z * (1 / 1188 - z * 691 / 360360))))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the KT probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def grams(text: bytes, depth: int) -> np.ndarray:
    """One number per byte and the end: the ``depth`` bytes before it, the
    last one in the highest place, and the byte itself in the lowest."""
    x = np.frombuffer(bytes([START]) * depth + text + bytes([END]), np.uint8).astype(np.uint64)
    n = len(x) - depth
    out = x[depth:].copy()
    for j in range(1, depth + 1):
        out |= x[depth - j:depth - j + n] << np.uint64(8 * (depth + 1 - j))
    return out


class Level:
    """Nodes of one depth, by context and decision (the byte's bits so far):
    KT counts, weighted probability, weight of the node's own estimate."""

    def __init__(self, node: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        self.node, self.n0, self.n1 = node, n0, n1
        own = log_kt(n0, n1)
        self.weighted = own if below is None else HALF + np.logaddexp(own, below)
        self.own = np.ones(len(node)) if below is None else np.exp(HALF + own - self.weighted)

    def find(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, seen) of nodes."""
        at = np.minimum(np.searchsorted(self.node, node), len(self.node) - 1)
        return at, self.node[at] == node


def decisions(gram: np.ndarray, depth: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams x 8) nodes of depth ``keep`` that the last bytes pass, and the
    bits taken there. A node is the context and a 1 before the bits so far."""
    byte = gram & np.uint64(0xFF)
    # keep = 7 would still fit: 7 context bytes and 8 bits for the decision.
    context = (gram >> np.uint64(8 * (depth + 1 - keep))) if keep else np.zeros(len(gram), np.uint64)
    level = np.arange(8, dtype=np.uint64)
    so_far = (byte[:, None] | np.uint64(0x100)) >> (np.uint64(8) - level)
    bit = (byte[:, None] >> (np.uint64(7) - level)) & np.uint64(1)
    return (context[:, None] << np.uint64(8)) | so_far, bit.astype(bool)


def counted(gram: np.ndarray, count: np.ndarray, depth: int, keep: int):
    """Distinct nodes of depth ``keep`` with their counts of zeros and ones."""
    node, bit = decisions(gram, depth, keep)
    node, place = np.unique(node.ravel(), return_inverse=True)
    weight = np.repeat(count.astype(np.float64), 8)
    ones = np.bincount(place, weight * bit.ravel(), len(node))
    return node, np.bincount(place, weight, len(node)) - ones, ones


def parent(node: np.ndarray, keep: int) -> np.ndarray:
    """The node of depth ``keep - 1`` above: the oldest byte is dropped."""
    return ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(0xFF))


def tree(gram: np.ndarray, count: np.ndarray, depth: int, top: int, below=None) -> list[Level]:
    """Levels ``depth`` down to ``top``, by depth from ``top``. ``below``:
    (nodes, log weighted probabilities) under the deepest of them."""
    levels = []
    for keep in range(depth, top - 1, -1):
        node, n0, n1 = counted(gram, count, depth, keep)
        if below is not None:
            place = np.searchsorted(node, parent(below[0], keep + 1))
            level = Level(node, n0, n1, np.bincount(place, below[1], len(node)))
        else:
            level = Level(node, n0, n1, None)
        below = (node, level.weighted)
        levels.append(level)
    return levels[::-1]


def log_probabilities(gram: np.ndarray, depth: int, levels: list[Level]) -> np.ndarray:
    """ln P of each gram's last byte. ``levels``: by depth from 0. A context
    that training never met passes on its parent's estimate."""
    p = None
    for keep in range(depth, -1, -1):
        node, bit = decisions(gram, depth, keep)
        level = levels[keep]
        if not len(level.node):
            continue
        at, seen = level.find(node)
        n0, n1 = level.n0[at], level.n1[at]
        kt = (np.where(bit, n1, n0) + 0.5) / (n0 + n1 + 1)
        if p is None:
            p = np.where(seen, kt, np.nan)
            continue
        mixed = np.where(np.isnan(p), kt, level.own[at] * kt + (1 - level.own[at]) * p)
        p = np.where(seen, mixed, p)
    if p is None:
        return np.full(len(gram), -8 * math.log(2))
    return np.log(np.where(np.isnan(p), 0.5, p)).sum(1)


# Words and grams are looked up the same way: a batch of documents sends its
# distinct keys to the shards, which answer with a value for each, in order.
# A word's key is its hash, a gram's is itself.

def _lower(text: str | None) -> bytes:
    """UTF-8 with A-Z (and no other letter) in lower case."""
    return (text or "").encode().lower()


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    """(p, b, keys, counts) rows; keys and counts as arrays."""
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2].astype("<u8").tobytes() for r in rows], pa.binary()),
         pa.array([r[3].astype("<i8").tobytes() for r in rows], pa.binary())], ["p", "b", "keys", "counts"])


def _numbered(batches):
    """Batches of a partition with a number that is the same in every pass
    over the same partitions."""
    first = TaskContext.get().partitionId() << 32
    return ((first + i, batch) for i, batch in enumerate(batches))


def _number(batches):
    for b, batch in _numbered(batches):
        yield batch.append_column("b", pa.array([b] * batch.num_rows, pa.int64()))


class Tally:
    """Distinct keys with their counts, merged whenever ``room`` new keys
    have come in, so that memory follows the distinct ones."""

    def __init__(self, room: int = 1 << 20):
        self.room, self.parts, self.size = room, [], 0
        self.key, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(keys)
        self.size += len(keys)
        if self.size >= self.room:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        if self.parts:
            key, count = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.size = [], 0
            self.key, self.count = merged([self.key, key], [self.count, count])
        return self.key, self.count


def tallies(texts, depth: int, hashes: WordHashes) -> tuple[Tally, Tally]:
    """Grams and words of some texts."""
    of_grams, of_words = Tally(), Tally()
    for data in texts:
        of_grams.add(grams(data, depth))
        of_words.add(hashes.of(data.split()))
    return of_grams, of_words


def by_text(texts, depth: int, room: int = 1 << 20):
    """(text number, gram, times) of each text's distinct grams, a number of
    texts at a time and by gram there. The number of a text within its lot
    takes the bits that a gram leaves free, so one plain sort orders a lot."""
    spare = np.uint64(8 * (7 - depth))
    most = 1 << int(spare)
    parts, size, first = [], 0, 0
    for at, data in enumerate(texts):
        parts.append((grams(data, depth) << spare) | np.uint64(at - first))
        size += len(parts[-1])
        if size >= room or len(parts) == most or at == len(texts) - 1:
            both, times = np.unique(np.concatenate(parts), return_counts=True)
            yield first + (both & np.uint64(most - 1)).astype(np.int64), both >> spare, times
            parts, size, first = [], 0, at + 1


def questions(of_grams: Tally, of_words: Tally, depth: int, n: int):
    """(shard, distinct keys) of grams and words."""
    key, _ = of_grams.settle()
    yield from ((p, k) for p, k, _ in _shards(key, key, subtree(key, depth), n, 0))
    key, _ = of_words.settle()
    yield from ((p, k) for p, k, _ in _shards(key, key, key, n, WORD_SHARDS))


def check(key: np.ndarray) -> int:
    return int(key.sum(dtype=np.uint64).view(np.int64))


def _shards(key: np.ndarray, count: np.ndarray, home: np.ndarray, n: int, first: int):
    """(shard, keys, counts) of the shards that have some."""
    shard = (mix64(home) % np.uint64(n)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(n + 1))
    for p, (i, j) in enumerate(zip(ends[:-1], ends[1:])):
        if i < j:
            yield first + p, key[order[i:j]], count[order[i:j]]


def subtree(gram: np.ndarray, depth: int) -> np.ndarray:
    """The two bytes before a gram's last one."""
    return gram >> np.uint64(8 * (depth - 1))


WORD_SHARDS = 1 << 20   # shard numbers of words start here


def _count(depth: int, n: int):
    """Grams and words of a batch's training texts with their counts (b -1),
    and of all its texts, to be asked for, by shard."""
    def run(batches):
        hashes = WordHashes()
        for b, batch in _numbered(batches):
            on = batch.column(0).to_pylist()

            def texts(train):
                return (_lower(t.as_py()) for t, x in zip(batch.column(1), on) if x == train)

            of_grams, of_words = tallies(texts(True), depth, hashes)
            key, count = of_grams.settle()
            rows = [(p, -1, k, c) for p, k, c in _shards(key, count, subtree(key, depth), n, 0)]
            key, count = of_words.settle()
            rows += [(p, -1, k, c) for p, k, c in _shards(key, count, key, n, WORD_SHARDS)]
            for all_, held in zip((of_grams, of_words), tallies(texts(False), depth, hashes)):
                all_.add(held.settle()[0])
            rows += [(p, b, k, k[:0]) for p, k in questions(of_grams, of_words, depth, n)]
            yield _packed(rows)
    return run


def _table(shard: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """(keys, counts) that training has, and (batch, keys) asked for."""
    keys, counts, asked = [], [], []
    for b, k, c in zip(shard["b"].to_pylist(), shard["keys"].to_pylist(), shard["counts"].to_pylist()):
        if b < 0:
            keys.append(np.frombuffer(k, "<u8"))
            counts.append(np.frombuffer(c, "<i8"))
        else:
            asked.append((b, np.frombuffer(k, "<u8")))
    return *merged(keys, counts), asked


TOP = 2
NODES = "depth int, node long, n0 double, n1 double, below double, words long, tokens long"


def _summary(depth: int):
    """What the nodes above a shard's subtrees need of it: counts of depth
    ``TOP`` contexts, summed one level up, with their weighted probabilities;
    of word shards, how many words and tokens there are."""
    def run(shard: pa.Table) -> pa.Table:
        key, count, _ = _table(shard)
        names = [c.split()[0] for c in NODES.split(", ")]
        types = (pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
        if shard["p"][0].as_py() >= WORD_SHARDS:
            rows = [[-1], [0], [0.0], [0.0], [0.0], [len(key)], [int(count.sum())]]
            return pa.table([pa.array(r, t) for r, t in zip(rows, types)], names=names)
        if not len(key):
            return pa.table([pa.array([], t) for t in types], names=names)
        level = tree(key, count, depth, TOP)[0]
        node, place = np.unique(parent(level.node, TOP), return_inverse=True)
        sums = [np.bincount(place, x, len(node)) for x in (level.n0, level.n1, level.weighted)]
        n = len(node)
        cols = [np.full(n, TOP - 1, np.int32), node.astype(np.int64), *sums, np.zeros(n, np.int64),
                np.zeros(n, np.int64)]
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


def top_levels(rows: list) -> list[Level]:
    """Levels 0 and 1 from the summed rows of depth 1."""
    rows = sorted(rows, key=lambda r: r["node"])
    node = np.array([r["node"] for r in rows], np.int64).astype(np.uint64)
    n0, n1, below = (np.array([r[c] for r in rows], np.float64) for c in ("n0", "n1", "below"))
    one = Level(node, n0, n1, below)
    root, place = np.unique(parent(node, 1), return_inverse=True)
    sums = [np.bincount(place, x, len(root)) for x in (n0, n1, one.weighted)]
    return [Level(root, *sums), one]


def _answer(depth: int, above: list[Level]):
    """Training counts of the words (8 bytes each), or ln P of the grams (4
    bytes each), that the batches ask for."""
    def run(shard: pa.Table) -> pa.Table:
        key, count, asked = _table(shard)
        p = shard["p"][0].as_py()
        every = np.unique(np.concatenate([k for _, k in asked])) if asked else key[:0]
        if p >= WORD_SHARDS:
            value = np.zeros(len(every), "<i8")
            if len(key):
                at = np.minimum(np.searchsorted(key, every), len(key) - 1)
                value = np.where(key[at] == every, count[at], 0).astype("<i8")
        else:
            empty = Level(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), None)
            levels = above + (tree(key, count, depth, TOP) if len(key) else [empty] * (depth - TOP + 1))
            value = np.concatenate([log_probabilities(every[i:i + 50_000], depth, levels)
                                    for i in range(0, len(every), 50_000)] or [np.zeros(0)]).astype("<f4")
        return pa.table({
            "b": pa.array([b for b, _ in asked], pa.int64()), "p": pa.array([p] * len(asked), pa.int32()),
            "check": pa.array([check(k) for _, k in asked], pa.int64()),
            "values": pa.array([value[np.searchsorted(every, k)].tobytes() for _, k in asked], pa.binary())})
    return run


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, n_bytes long, bits_per_byte double")


def _score(depth: int, n: int, total: int, distinct: int, end_count: int):
    """A batch's documents by the answers to its questions."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, rows = WordHashes(), []
        texts = [_lower(t.as_py()) for t in docs["text"]]
        of_grams, of_words, words = Tally(), Tally(), []
        for data in texts:
            of_grams.add(grams(data, depth))
            words.append(hashes.of(data.split()))
            of_words.add(words[-1])
        got = {p: (c, v) for p, c, v in zip(*(answers[c].to_pylist() for c in ("p", "check", "values")))}
        parts: dict = {False: [], True: []}
        for p, key in questions(of_grams, of_words, depth, n):
            if got.get(p, (None,))[0] != check(key):
                raise RuntimeError("the documents' partitions changed between two passes; write them out first")
            parts[p >= WORD_SHARDS].append((key, np.frombuffer(got[p][1], "<i8" if p >= WORD_SHARDS else "<f4")))
        table = {}
        for of, found in parts.items():
            key = np.concatenate([k for k, _ in found] or [np.zeros(0, np.uint64)])
            value = np.concatenate([v for _, v in found] or [np.zeros(0)]).astype(np.float64)
            order = np.argsort(key)
            table[of] = key[order], value[order]
        scale = math.log10(total + 0.5 * (distinct + 1))
        scores = np.zeros(len(texts))
        for at, gram, times in by_text(texts, depth):
            value = table[False][1][np.searchsorted(table[False][0], gram)]
            scores += np.bincount(at, value * times, len(texts))
        for doc_id, held, data, h, score in zip(docs["doc_id"].to_pylist(), docs["held_out"].to_pylist(), texts,
                                                words, scores.tolist()):
            c = np.r_[table[True][1][np.searchsorted(table[True][0], h)] if len(h) else [], end_count]
            base = float(np.log10(c + 0.5).sum()) - len(c) * scale
            rows.append((doc_id, held, len(c), int((c > 0).sum()), total, base, score / math.log(10), len(data),
                         -score / math.log(2) / (len(data) + 1)))
        types = (pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.float64())
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                        names=[c.split()[0] for c in SCORES.split(", ")])
    return run


def score_texts(docs: DataFrame, depth: int = DEPTH, held_remainder: int = 1, doc_id: str = "doc_id",
                text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    n_bytes, bits_per_byte) of every whole text.

    The model and the word counts come from all texts whose crc32(doc_id)
    mod 5 is not ``held_remainder``. ``score`` is the model's log10
    probability of the text's lower-cased bytes and its end,
    ``bits_per_byte`` its code length per byte (the end counts as one);
    ``base_score`` is the add-half unigram score of its words and its end.

    Batches of rows count their grams (``depth`` bytes of context and a byte)
    and words before the shuffle, and ask the shards of the tree and of the
    word table for what they hold; neither is ever in one place, only the
    nodes of contexts up to one byte go to all. Batches are made twice from
    the same partitions: ``docs`` must be a table that is read, not a plan
    that may deal its rows differently when it runs again (a check says so).

    Null and empty texts are their end alone. A null doc_id counts as the
    empty text for the fold and is carried; repeated rows are scored, and
    learned, once each; other columns are not read; an empty table gives no
    rows. Without training texts every bit has probability 1/2.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(shuffle_partitions(spark), -(-size // shard_bytes))
    held = id_mod5() == held_remainder
    rows = docs.select((~held).alias("train"), "text", "doc_id", held.alias("held_out"))
    packed = materialize(rows.mapInArrow(_count(depth, n), KEYS))
    nodes = materialize(packed.filter("b < 0").groupBy("p").applyInArrow(_summary(depth), NODES))
    # At most 256 contexts times 255 decisions.
    one = nodes.filter("depth = 1").groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "below")]).collect()
    words = nodes.agg(F.sum("words").alias("v"), F.sum("tokens").alias("t")).first()
    n_train = rows.filter("train").count()
    above = top_levels(one) if one else [Level(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), None)] * TOP
    answers = packed.groupBy("p").applyInArrow(_answer(depth, above), ANSWERS)
    numbered = rows.mapInArrow(_number, T.StructType([*rows.schema, T.StructField("b", T.LongType())]))
    score = _score(depth, n, (words.t or 0) + n_train, (words.v or 0) + (n_train > 0), n_train)
    return numbered.groupBy("b").cogroup(answers.groupBy("b")).applyInArrow(score, SCORES)


@query("op3_context_tree_weighting")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
