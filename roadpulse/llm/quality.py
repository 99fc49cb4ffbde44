"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages with one label. Every passage is encoded;
gated attention (Ilse, Tomczak, Welling 2018) weighs the passages, and the
score is a logistic function of their weighted mean. All weights are learned
together from document labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import WordHashes, id_mod5, labelled_sample
from roadpulse.llm.registry import query, table

PASSAGE = 64             # words
SAMPLE_DOCS = 8_000      # labelled documents a model is fitted on, about
SAMPLE_PASSAGES = 250_000   # passages of all of them; beyond that, fewer documents
THRESHOLD = 0.3
HIDDEN, GATE = 16, 8
EPOCHS, BATCH, RATE, DECAY = 40, 128, 0.01, 1e-4
SEED = 23

WORD_FEATURES = 6


def byte_groups() -> np.ndarray:
    """256 x groups: each lower-case letter, all capitals, all digits, each
    mark, line ends, other white space, bytes beyond ASCII, control bytes."""
    group = np.full(256, -1)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for i, b in enumerate([*range(97, 123), *marks]):
        group[b] = i
    n = 26 + len(marks)
    group[65:91], group[48:58], group[10], group[128:] = n, n + 1, n + 2, n + 4
    group[[9, 11, 12, 13, 32]] = n + 3
    group[group < 0] = n + 5
    return np.eye(n + 6)[group]


GROUPS = byte_groups()
FEATURES = GROUPS.shape[1] + WORD_FEATURES


def passages(text: str | None, hashes: WordHashes, size: int = PASSAGE) -> np.ndarray:
    """Features of every run of ``size`` words (passages x FEATURES): shares
    of byte groups, and how long, how many, how varied and how repeated its
    words are. A text without words is one passage of zeros."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros((1, FEATURES))
    n = -(-len(words) // size)
    x = np.frombuffer(data, np.uint8)
    space = (x == 32) | ((x >= 9) & (x <= 13))
    starts = ~space & np.r_[True, space[:-1]]
    word = np.maximum(np.cumsum(starts) - 1, 0)
    part = word // size
    counts = np.bincount(part * 256 + x, minlength=n * 256).reshape(n, 256)
    total = counts.sum(1)
    h = hashes.of(words)
    at = np.arange(len(h)) // size
    length = np.fromiter(map(len, words), np.float64, len(words))
    in_part = np.bincount(at, minlength=n)
    order = np.lexsort((h, at))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (at[order][1:] != at[order][:-1])]
    distinct = np.bincount(at[order], new, n)
    same = np.r_[False, h[1:] == h[:-1]]
    mean = np.bincount(at, length, n) / in_part
    spread = np.sqrt(np.maximum(0, np.bincount(at, length * length, n) / in_part - mean * mean))
    stats = np.column_stack([mean / 10, spread / 10, in_part / size, distinct / in_part,
                             np.bincount(at, same, n) / in_part, np.log1p(np.full(n, len(words))) / 10])
    return np.hstack([counts @ GROUPS / total[:, None], stats])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Attention:
    """Encoder tanh(X W + b), gated attention w . (tanh(H V) * sigmoid(H U)),
    logit c . sum(a H) + d; X standardised."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    def forward(self, x: np.ndarray, starts: np.ndarray):
        """``starts``: first passage of each document."""
        w = self.w
        x = (x - w["mean"]) / w["std"]
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * g) @ w["w"]
        doc = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        a = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return x, h, t, g, a, z, doc, _sigmoid(z @ w["c"] + w["d"])

    def gradients(self, x, starts, y):
        w = self.w
        x, h, t, g, a, z, doc, p = self.forward(x, starts)
        out = (p - y) / len(y)
        dz = out[:, None] * w["c"]
        dh = a[:, None] * dz[doc]
        da = (h * dz[doc]).sum(1)
        de = a * (da - np.add.reduceat(a * da, starts)[doc])
        dt, dg = de[:, None] * g * w["w"] * (1 - t * t), de[:, None] * t * w["w"] * g * (1 - g)
        dh = (dh + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                "c": z.T @ out, "d": out.sum()}


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Attention:
    """Attention model of labelled bags by Adam on the log loss."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    d = every.shape[1]
    w = {"W": rng.normal(0, d ** -0.5, (d, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "w": rng.normal(0, GATE ** -0.5, GATE), "c": np.zeros(HIDDEN),
         "d": np.array(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))}
    model = Attention(w | {"mean": every.mean(0), "std": every.std(0) + 0.01})
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            mine = [bags[j] for j in order[i:i + BATCH]]
            starts = np.cumsum([0, *map(len, mine)])[:-1]
            step += 1
            rate = RATE * (1 - epoch / epochs) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for k, v in model.gradients(np.concatenate(mine), starts, y[order[i:i + BATCH]]).items():
                v = v + DECAY * model.w[k]
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                model.w[k] = model.w[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def _whole(sizes: list[tuple[int, int, int]], most: int) -> list[int]:
    """The places of the first documents of (place, label, passages) that
    have ``most`` passages together, and the first one of each label. A
    document that does not fit is left out and the next ones are tried."""
    kept, labels, total = [], set(), 0
    for place, label, n in sorted(sizes):
        if total + n <= most or label not in labels:
            labels.add(label)
            kept.append(place)
            total += n
    return kept


def _bags(size: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            out = [passages(t.as_py(), hashes, size).astype("<f4").tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), *batch.columns[1:]], ["bag", "label", "place"])
    return run


def _score(weights: dict, size: int, threshold: float):
    def run(batches):
        model, hashes = Attention(weights), WordHashes()
        for batch in batches:
            score, count, top, weight = [], [], [], []
            for t in batch.column(2):
                x = passages(t.as_py(), hashes, size)
                *_, a, _, _, p = model.forward(x, np.array([0]))
                score.append(float(p[0]))
                count.append(len(x))
                top.append(int(np.argmax(a)))
                weight.append(float(a.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()),
                 pa.array([int(s >= threshold) for s in score], pa.int32()), pa.array(count, pa.int64()),
                 pa.array(top, pa.int64()), pa.array(weight, pa.float64())],
                ["doc_id", "held_out", "score", "predicted", "n_passages", "top_passage", "top_weight"])
    return run


def fit_quality(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, passage: int = PASSAGE,
                sample_passages: int = SAMPLE_PASSAGES) -> dict[str, np.ndarray]:
    """Weights of the attention model (see ``Attention``), learned as
    ``score_quality`` says."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = labelled_sample(docs, labels, "quality", sample_docs, SEED)
    place = F.xxhash64("doc_id", F.lit(SEED + 2))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+"))
    sizes = [tuple(r) for r in sample.select(place, "label", F.greatest(F.lit(1), F.ceil(words / passage))).collect()]
    kept = _whole(sizes, sample_passages)
    sample = sample.withColumn("place", place)
    if len(kept) < len(sizes):
        chosen = sample.sparkSession.createDataFrame([(p,) for p in kept], "place long")   # sample_docs rows at most
        sample = sample.join(F.broadcast(chosen), "place", "left_semi")
    rows = sample.select("text", "label", "place").mapInArrow(_bags(passage), "bag binary, label int, place long").collect()
    rows.sort(key=lambda r: (r.place, r.bag))   # however the sample was dealt
    y = np.array([r.label for r in rows], np.float64)
    if len(set(y)) == 2:
        weights = fit([np.frombuffer(r.bag, "<f4").reshape(-1, FEATURES).astype(np.float64) for r in rows], y).w
    else:
        flat = float(np.clip(y.mean() if len(y) else 1.0, 1e-9, 1 - 1e-9))
        weights = fit([np.zeros((1, FEATURES))], np.array([1.0]), epochs=0).w
        weights["d"] = np.log(flat / (1 - flat))
    return weights


def score_quality(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, passage: int = PASSAGE,
                  threshold: float = THRESHOLD, sample_passages: int = SAMPLE_PASSAGES) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages, top_passage,
    top_weight) of every document.

    The model is fitted on about ``sample_docs`` labelled documents, chosen
    by a hash of doc_id, held-out ones (crc32(doc_id) mod 5 = 0) never, and on
    all passages of each. If they have more than ``sample_passages`` together,
    fewer documents are taken, by a hash again, one of each label at least.
    Scoring reads the whole text; ``top_passage`` has the most attention.

    The fit does not depend on how the tables are partitioned; ties of the
    hash are taken in the order of the bags. Texts of any length are scored
    whole. A null or empty text is one passage of zeros. Without labels of both
    classes the score is the share of label 1 (1 without labels). Repeated
    rows get a row each, a null doc_id is carried, an empty table gives no
    rows, other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    weights = fit_quality(docs, labels, sample_docs, passage, sample_passages)
    return docs.select("doc_id", (id_mod5() == 0).alias("held_out"), "text").mapInArrow(
        _score(weights, passage, threshold),
        "doc_id long, held_out boolean, score double, predicted int, n_passages long, top_passage long, "
        "top_weight double")


@query("op2_attention_mil_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
