"""Toxicity: gradient-boosted trees over dense features, isotonic calibration."""

from __future__ import annotations

import math
import re
from collections import namedtuple

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import id_mod5, labelled_sample, materialize
from roadpulse.llm.registry import query, table

SAMPLE_DOCS = 20_000     # labelled documents a model is fitted on, about
LEXICON_WORDS = 4_000    # words of the learned lexicon, at most
MIN_DOCS = 3             # documents a lexicon word occurs in
MIN_LOG_ODDS = 1.5
THRESHOLD = 0.5
SEED = 17

# Second-person pronouns of the corpus languages.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous "
                "votre vos ti tú usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!", "oieastasi")
# What ``features`` returns, in order.
FEATURES = ("n_hits", "hit_rate", "max_odds", "sum_odds", "odds_rate", "you_rate", "near_you",
            "capitals", "punctuation", "symbols", "obfuscated", "masked_hits", "repeats", "log_words")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[^\W\d_][\d@$!*._-]+[^\W\d_]")


def tokens(text: str) -> list[str]:
    """Lower-case words without the marks around them."""
    return [w.strip("""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~""") for w in WORD.findall(text.lower())]


def unmask(word: str) -> str:
    """A word with look-alike signs as letters and marks inside dropped."""
    return "".join(LETTERS.findall(word.translate(LEET)))


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    text = text or ""
    words = tokens(text)
    n = len(words) or 1
    chars = len(text) or 1
    hits, near, masked, obfuscated, odds = 0, 0, 0, 0, []
    last_you, waiting = -99, []
    for i, w in enumerate(words):
        if w in YOU:
            last_you = i
            near += sum(i - h <= 5 for h in waiting)
            waiting = []
        score = lexicon.get(w)
        if score is None and not w.isalpha() and MASKED.search(w):
            obfuscated += 1
            score = lexicon.get(unmask(w))
            masked += score is not None
        if score is not None:
            hits += 1
            odds.append(score)
            if i - last_you <= 5:
                near += 1
            else:
                waiting.append(i)
    # Words spelled with gaps: runs of single letters.
    for run in re.findall(r"(?<!\w)(?:\w[ .*_-]){2,}\w(?!\w)", text.lower()):
        score = lexicon.get("".join(LETTERS.findall(run.translate(LEET))))
        if score is not None:
            masked += 1
            hits += 1
            odds.append(score)
    letters = sum(map(len, LETTERS.findall(text))) or 1
    capitals = sum(1 for c in text if c.isupper())
    marks = sum(text.count(c) for c in "!?.,;:")
    signs = chars - letters - marks - text.count(" ")
    you = sum(w in YOU for w in words)
    repeats = len(re.findall(r"(\w)\1{2,}", text))
    return [float(hits), hits / n, max(odds, default=0.0), sum(odds), sum(odds) / n, you / n, float(near),
            capitals / letters, marks / chars, signs / chars, obfuscated / n, float(masked), repeats / n,
            math.log1p(len(words))]


def _scan(lexicons: list[dict[str, float]], fold: str | None, text: str, out: str):
    """Appends the features by the fold's lexicon to every batch."""
    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index(text))
            folds = batch.column(names.index(fold)).to_pylist() if fold else [0] * len(texts)
            rows = [features(t.as_py(), lexicons[f]) for t, f in zip(texts, folds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.list_(pa.float64()))],
                                             [*names, out])
    return run


def _words(batches):
    """(word, fold, label) once per document."""
    for batch in batches:
        words, folds, labels = [], [], []
        for fold, text, label in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            seen = {w for t in tokens(text or "") for w in (t, unmask(t)) if len(w) > 2}
            words += seen
            folds += [fold] * len(seen)
            labels += [label] * len(seen)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(folds, pa.int32()),
                                          pa.array(labels, pa.int32())], ["word", "fold", "label"])


def learn_lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """Word -> log-odds of toxic documents: learned on fold 0, on fold 1, and
    on both."""
    size = {(r.fold, r.label): r.n for r in
            sample.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = materialize(
        sample.mapInArrow(_words, "word string, fold int, label int").groupBy("word")
        .agg(*[F.count(F.when((F.col("fold") == f) & (F.col("label") == y), 1)).alias(f"c{f}{y}")
               for f in (0, 1) for y in (0, 1)])
        .filter(F.col("c01") + F.col("c11") >= MIN_DOCS))
    out = []
    for folds in ((0,), (1,), (0, 1)):
        clean, toxic = (sum(size.get((f, y), 0) for f in folds) for y in (0, 1))
        c, t = (sum(F.col(f"c{f}{y}") for f in folds) for y in (0, 1))
        odds = F.log(((t + 0.25) / (toxic + 0.5)) / ((c + 0.25) / (clean + 0.5)))
        top = (counts.filter(t >= MIN_DOCS).select("word", odds.alias("odds"), t.alias("t"))
               .filter(F.col("odds") >= MIN_LOG_ODDS)
               .orderBy((F.col("odds") * F.log1p("t")).desc(), "word").limit(LEXICON_WORDS))
        out.append({r.word: r.odds for r in top.collect()})
    return out


FLAT = namedtuple("FLAT", "score")
MODEL = namedtuple("MODEL", "lexicon trees curve")


def _vectors(rows: DataFrame, lexicons: list[dict[str, float]], fold: str | None, text: str) -> DataFrame:
    """``rows`` with the feature vector ``_x``."""
    schema = T.StructType([*rows.schema, T.StructField("_features", T.ArrayType(T.DoubleType()))])
    return (rows.mapInArrow(_scan(lexicons, fold, text, "_features"), schema)
            .withColumn("_x", array_to_vector("_features")).drop("_features"))


def _margin(trees, rows: DataFrame) -> DataFrame:
    return (trees.transform(rows).withColumn("_margin", vector_to_array("_raw")[1])
            .drop("_x", "_raw", "_probability", "_prediction"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS):
    """Lexicon, trees and calibration from a bounded sample of labelled
    documents, or a flat score where a class has fewer than five."""
    sample = labelled_sample(docs, labels, "toxic", sample_docs, SEED)
    known = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(known.get(0, 0), known.get(1, 0)) < 5:
        return FLAT(float(known.get(1, 0) / max(1, sum(known.values()))))
    by_fold = learn_lexicons(sample)
    # Fold 0 is described by the lexicon of fold 1, and the other way round.
    train = materialize(_vectors(sample, by_fold[1::-1], "fold", "text").drop("text").withColumn(
        "part", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(SEED + 2)), F.lit(3))))
    learner = GBTClassifier(featuresCol="_x", labelCol="label", predictionCol="_prediction", maxIter=25, maxDepth=4,
                            stepSize=0.2, seed=SEED, minInstancesPerNode=5)
    learner.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    trees = learner.fit(train.filter("part > 0").coalesce(4))
    shown = _margin(trees, train.filter("part = 0")).select("_margin", F.col("label").cast("double"))
    curve = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_score").fit(shown.coalesce(4))
    return MODEL(by_fold[2], trees, curve)


def with_toxicity(docs: DataFrame, model, score: str, text: str = "text") -> DataFrame:
    """``docs`` with a calibrated toxicity ``score`` from 0 to 1."""
    if isinstance(model, FLAT):
        return docs.withColumn(score, F.lit(model.score))
    scored = model.curve.transform(_margin(model.trees, _vectors(docs, [model.lexicon], None, text)))
    return (scored.withColumn(score, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_score"))))
            .select(*docs.columns, score))


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A bounded sample of labelled documents (``sample_docs``; held-out ones,
    crc32(doc_id) mod 5 = 0, never) gives a lexicon of toxic words, the
    trees and the calibration. Lexicon features of training documents come
    from the other half's lexicon, so the trees meet them as for new texts.
    The trees' margin is calibrated by isotonic regression on a third of the
    sample that the trees do not see. Features see the whole text.

    A null or empty text is scored like any other (no words). Without
    labels of both classes the score is the share of toxic labels, 0 if
    there are none. Repeated rows get a row each, a null doc_id is carried
    (and held out as the empty text would be), an empty table gives no rows,
    other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    model = fit_toxicity(docs, labels, sample_docs)
    return with_toxicity(docs, model, "score").select(
        "doc_id", (id_mod5() == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more, all
    columns kept; edge cases as in ``score_toxicity``."""
    # Whole rows in one column: the names of theirs cannot meet the model's.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    scored = with_toxicity(rows, fit_toxicity(docs, labels, sample_docs), "toxicity")
    return scored.filter(F.col("toxicity") < threshold).select("row.*")


@query("op10_boosted_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
