"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of a learned lexicon of words and word stems, how near
its words stand to second-person words, and rates of capitals, punctuation and
obfuscated spellings. Lexicon, trees and calibration are fitted on three disjoint
parts of a sample of at most ``SAMPLE`` labelled rows; features and scores cover
every whole text. Lexicon and model are small and bounded, so they are broadcast.

Defined cases: a null text counts as empty and is scored like any other; a label
that is null, or of an id that no document has, is not used; of several labels of
one id the largest holds; a row without an id is never trained on; with labels of
one kind only, or none, every score is their share of ones; an empty table gives an
empty result; repeated rows are scored each. Texts of any length are scored whole.
The rows given to a scorer keep their columns, but for one of the name of the score,
which is replaced, and names that begin with ``toxic_``, which are the scorer's own:
put rows that have such into a struct, as the pipeline does.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import body, hashed_sample, materialize

#: Labelled rows that lexicon, trees and calibration are fitted on, at most.
SAMPLE = 20_000
#: Entries of the lexicon, at most, and candidates for it that are counted in clean texts.
LEXICON, CANDIDATES = 2_000, 50_000
#: Letters of a stem.
STEMS = (4, 5, 6)
#: Least log odds of an entry, and the least share of toxic texts that have it.
LEAST_ODDS, LEAST_SHARE, LEAST_TEXTS = 2.5, 0.005, 3
#: Words looked at on either side for a second person.
NEAR = 8
ROUNDS, DEPTH = 20, 3

# Second-person words of the languages handled.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur ya "
    "tu te toi ton ta tes vous votre vos "
    "du dich dir dein deine deinen deiner ihr euch euer eure "
    "tú ti tuyo tuya usted ustedes vosotros vuestro os".split()
)
_WORD = re.compile(r"\w+")
_MASKED = re.compile(r"[^\W_]+(?:[@$!*#.\-_0-9]+[^\W_]+)+")
# Quick to look for; without a match there is no masked or shouted word.
_MASK, _SHOUT = re.compile(r"[@$!*#.\-_0-9][^\W_]"), re.compile(r"[A-Z]{3}")
_RUN = re.compile(r"[!?*#$%&@]{2,}")
_SPELLING = str.maketrans("013457@$!", "oieastasi")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SQUEEZED = re.compile(r"(.)\1{2,}")

FEATURES = (
    "word_density",
    "word_weight",
    "word_hits",
    "stem_density",
    "stem_hits",
    "distinct",
    "strongest",
    "second_person",
    "proximity",
    "capitals",
    "shouted",
    "punctuation",
    "punctuation_runs",
    "hidden_density",
    "masked",
    "length",
)


def terms(words: set[str]) -> set[str]:
    """Words, and their stems marked by a star."""
    stems = {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}
    return words | stems


def plain_spelling(token: str) -> str:
    """A token with figures and signs read as the letters they stand for."""
    spelled = _NOT_LETTERS.sub("", token.lower().translate(_SPELLING))
    return _SQUEEZED.sub(r"\1", spelled)


class Lexicon:
    def __init__(self, entries: dict[str, float]):
        self.entries = entries
        self.known: dict[str, tuple[float, float]] = {}

    def weights(self, word: str) -> tuple[float, float]:
        """The weight of a word and of its best stem, zero if not listed."""
        got = self.known.get(word)
        if got is None:
            get = self.entries.get
            stem = max((get(f"{word[:n]}*", 0.0) for n in STEMS if len(word) > n), default=0.0)
            got = get(word, 0.0), stem
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[word] = got
        return got

    def features(self, text: str) -> list[float]:
        lower = text.lower()
        words = _WORD.findall(lower)
        counts = Counter(words)
        total = max(1, len(words))
        word_hits = stem_hits = distinct = second = 0
        weight = strongest = 0.0
        listed = set()
        for word, n in counts.items():
            own, stem = self.weights(word)
            if own:
                word_hits += n
                weight += own * n
            if stem:
                stem_hits += n
            if own or stem:
                distinct += 1
                strongest = max(strongest, own, stem)
                listed.add(word)
            if word in SECOND_PERSON:
                second += n
        near = 0.0
        if listed and second:
            near = _nearness(words, listed)
        masked = _MASKED.findall(text) if _MASK.search(text) else []
        hidden = sum(
            1 for token in masked if token.lower() not in listed and self.entries.get(plain_spelling(token))
        )
        size = max(1, len(text))
        letters = max(1, sum(map(len, words)))
        data = np.frombuffer(text.encode(), np.uint8)
        upper = np.count_nonzero((data >= 65) & (data <= 90))
        shouted = 0
        if upper > 2 and _SHOUT.search(text):
            shouted = sum(1 for w in _WORD.findall(text) if len(w) > 2 and w.isupper())
        signs = sum(map(text.count, "!?"))
        runs = len(_RUN.findall(text))
        return [
            word_hits / total,
            weight / total,
            math.log1p(word_hits),
            stem_hits / total,
            math.log1p(stem_hits),
            math.log1p(distinct),
            strongest,
            second / total,
            near,
            upper / letters,
            shouted / total,
            signs / size,
            runs / total,
            math.log1p(hidden),
            len(masked) / total,
            math.log1p(len(words)),
        ]


def _nearness(words: list[str], listed: set[str]) -> float:
    """The mean closeness of listed words to the nearest second person."""
    persons = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
    hits = np.array([i for i, w in enumerate(words) if w in listed])
    after = np.searchsorted(persons, hits)
    right = np.abs(persons[np.minimum(after, len(persons) - 1)] - hits)
    left = np.abs(persons[np.maximum(after - 1, 0)] - hits)
    apart = np.minimum(left, right)
    return float(np.where(apart <= NEAR, 1 / (1 + apart), 0).mean())


def _term_counts(wanted=None):
    """Texts with each term, by label; only ``wanted`` terms if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for text, label in zip(batch.column("body").to_pylist(), batch.column("label").to_pylist()):
                found = terms(set(_WORD.findall(text.lower())))
                found = found if wanted is None else found & wanted.value
                seen.update((term, label) for term in found)
        rows = [(term, label, n) for (term, label), n in seen.items()]
        columns = [list(c) for c in zip(*rows)] or [[], [], []]
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array(columns[0], pa.string()),
                "label": pa.array(columns[1], pa.int32()),
                "n": pa.array(columns[2], pa.int64()),
            }
        )

    return run


_COUNTS = "term string, label int, n long"


def fit_lexicon(texts: DataFrame) -> dict[str, float]:
    """Terms much more frequent in toxic texts, with their log odds."""
    spark = texts.sparkSession
    sizes = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    found = (
        texts.where("label = 1")
        .mapInArrow(_term_counts(), _COUNTS)
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "term")
        .limit(CANDIDATES)
    )
    in_toxic = {r["term"]: r["n"] for r in found.collect()}
    wanted = spark.sparkContext.broadcast(frozenset(in_toxic))
    counted = texts.where("label = 0").mapInArrow(_term_counts(wanted), _COUNTS)
    in_clean = {
        r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()
    }

    def odds(term: str) -> float:
        a, b = in_toxic[term], in_clean.get(term, 0)
        return math.log((a + 0.5) / (toxic - a + 1)) - math.log((b + 0.5) / (clean - b + 1))

    scored = sorted(((odds(t), t) for t in in_toxic), key=lambda x: (-x[0], x[1]))
    return {t: s for s, t in scored[:LEXICON] if s >= LEAST_ODDS}


def feature_column(spark, entries: dict[str, float]):
    shared = spark.sparkContext.broadcast(entries)
    held: list[Lexicon] = []

    @F.arrow_udf(T.ArrayType(T.DoubleType(), False))
    def features(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Lexicon(shared.value))
        rows = [held[0].features(text.as_py()) for text in texts]
        flat = np.array(rows, np.float64).reshape(-1)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return features


class Scorer:
    """Lexicon, trees and calibration, or a constant where labels have one kind only."""

    def __init__(self, constant: float | None, features=None, trees=None, steps=None):
        self.constant, self.features, self.trees, self.steps = constant, features, trees, steps

    def raw(self, rows: DataFrame, text: str | Column) -> DataFrame:
        """``rows`` with ``toxic_raw``, the uncalibrated probability."""
        with_features = rows.withColumn("toxic_features", array_to_vector(self.features(body(text))))
        scored = self.trees.transform(with_features)
        return scored.withColumn("toxic_raw", vector_to_array("toxic_probability")[1]).drop(
            "toxic_features", "toxic_margin", "toxic_probability", "toxic_prediction"
        )

    def score(self, rows: DataFrame, text: str | Column, out: str = "score") -> DataFrame:
        if self.constant is not None:
            return rows.withColumn(out, F.lit(float(self.constant)))
        scored = self.steps.transform(self.raw(rows, text))
        # The calibration has steps; within one the uncalibrated order decides.
        mixed = F.lit(0.998) * F.col("toxic_step") + F.lit(0.002) * F.col("toxic_raw")
        mixed = F.least(F.lit(1.0), F.greatest(F.lit(0.0), mixed))
        return scored.withColumn(out, mixed).drop("toxic_raw", "toxic_step")


def fit(docs: DataFrame, labels: DataFrame, training: Column, label_col: str = "toxic") -> Scorer:
    """Learn from the labelled rows of ``docs`` where ``training`` (of ``doc_id``) holds."""
    spark = docs.sparkSession
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.max(label_col) > 0).cast("int").alias("label"))
        .where(training)
    )
    known = materialize(hashed_sample(known, "doc_id", SAMPLE), "toxic-labels")
    # At most SAMPLE rows of two numbers.
    texts = docs.select("doc_id", body("text").alias("body")).join(F.broadcast(known), "doc_id")
    texts = texts.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10)))
    texts = materialize(texts, "toxic-sample")
    shares = texts.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not shares[0] or shares[1] in (0, shares[0]):
        return Scorer(shares[1] / shares[0] if shares[0] else 0.0)
    entries = fit_lexicon(texts.where("part < 5").dropDuplicates(["body"]))
    features = feature_column(spark, entries)
    fitted = texts.where("part >= 5").withColumn("toxic_features", array_to_vector(features("body")))
    fitted = materialize(fitted.select("part", "body", "label", "toxic_features"), "toxic-features")
    for some in ("part < 8", "part >= 8"):
        kinds = fitted.where(some).agg(F.min("label"), F.max("label")).first()
        if kinds[0] == kinds[1]:
            # Too few rows to set some apart: all serve for both.
            fitted = fitted.withColumn("part", F.explode(F.array(F.lit(5), F.lit(9))))
            break
    kinds = fitted.agg(F.min("label"), F.max("label")).first()
    if kinds[0] == kinds[1]:
        return Scorer(shares[1] / shares[0])
    learner = GBTClassifier(
        featuresCol="toxic_features",
        labelCol="label",
        predictionCol="toxic_prediction",
        maxIter=ROUNDS,
        maxDepth=DEPTH,
        stepSize=0.3,
        seed=7,
    )
    learner.setProbabilityCol("toxic_probability").setRawPredictionCol("toxic_margin")
    trees = learner.fit(fitted.where("part < 8"))
    scorer = Scorer(None, features, trees)
    calibration = materialize(
        scorer.raw(fitted.where("part >= 8").select("body", "label"), "body").select(
            "toxic_raw", F.col("label").cast("double").alias("label")
        ),
        "toxic-calibration",
    )
    scorer.steps = IsotonicRegression(
        featuresCol="toxic_raw", labelCol="label", predictionCol="toxic_step"
    ).fit(calibration)
    return scorer
