"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features (all rates, so text length does not drive them): density of learned insult words
weighted by their log-odds, density of a fixed lexicon, second-person density, insults close to a second-person
word, capitals, words in capitals, punctuation, exclamation marks and obfuscation (symbols or digits inside
words).  Words are compared after folding case and the usual digit and symbol
substitutions, so ``1d1ot`` counts as ``idiot``.

Fitting uses a bounded sample of labelled rows: word counts on one half give a lexicon, MLlib fits the
trees on the features of documents of the other half, and on the rest of that an isotonic regression maps the trees'
margins to probabilities.  Scoring is one pass: an Arrow function makes the features, the trees and the calibration run in the JVM.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket.llm.common import arrow_map, cut, extend, slices, span_hashes, text_crc, utf8, word_spans

#: Insults of the fixed lexicon.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "trash", "scum", "clown", "pathetic", "worthless", "disgusting",
    "idiota", "estúpido", "basura", "imbécil", "crétin", "débile", "dumm", "trottel", "arschloch",
)
#: Second-person words.
SECOND_PERSON = (
    "you", "your", "yours", "youre", "yourself", "u", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "vous", "votre", "ton", "usted", "ustedes", "vosotros", "ti",
)

FEATURES = (
    "learned_density", "lexicon_density", "insult_share", "second_person", "proximity", "capitals",
    "capital_words", "punctuation", "exclamations", "obfuscation", "log_words",
)
_DDL = "features array<double>"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
for _from, _to in zip(b"013457@$", b"oieastas", strict=True):
    _FOLD[_from] = _to
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = _LETTER[0x80:] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
# Inside a word these disguise a letter; an apostrophe, a hyphen or a full stop does not.
_DISGUISE = _PUNCTUATION.copy()
_DISGUISE[list(b"'-./:,_&")] = False
_DISGUISE[0x30:0x3A] = True
NEAR = 3


def _word_hashes(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array([w.lower() for w in words], pa.string()))
    data = _FOLD[data]
    return span_hashes(data, *word_spans(data, offsets, _LETTER)[:2])


def _member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted ``known``, or -1."""
    if not len(known) or not len(hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


class Lexicon:
    """Learned words with weights, and the fixed lists, as sorted hashes."""

    def __init__(self, learned: dict[str, float]):
        words = sorted(learned)
        hashes = _word_hashes(words)
        order = np.argsort(hashes)
        self.learned, self.weights = hashes[order], np.array([learned[w] for w in words])[order]
        self.fixed, self.person = np.sort(_word_hashes(list(LEXICON))), np.sort(_word_hashes(list(SECOND_PERSON)))

    def features(self, column: pa.Array) -> np.ndarray:
        """One row of ``FEATURES`` per text; zeros for a text without words."""
        raw, offsets = utf8(column)
        docs = len(offsets) - 1
        data = _FOLD[raw]
        start, end, doc = word_spans(data, offsets, _LETTER)
        hashes = span_hashes(data, start, end)
        place = _member(hashes, self.learned)
        weight = np.where(place >= 0, self.weights[place] if len(self.weights) else 0.0, 0.0)
        insult = (place >= 0) | (_member(hashes, self.fixed) >= 0)
        person = _member(hashes, self.person) >= 0
        near = np.zeros(len(hashes), bool)
        for k in range(1, NEAR + 1):
            same = doc[k:] == doc[:-k]
            near[k:] |= same & person[:-k]
            near[:-k] |= same & person[k:]
        inside = np.zeros(len(raw), bool)
        if len(raw) > 2:
            inside[1:-1] = _DISGUISE[raw[1:-1]] & _LETTER[raw[:-2]] & _LETTER[raw[2:]]
        upper = np.concatenate(([0], np.cumsum(_UPPER[raw])))
        shout = (end - start > 1) & (upper[end] - upper[start] == end - start)

        def by_doc(flags: np.ndarray) -> np.ndarray:
            return np.bincount(doc, flags, docs) if len(doc) else np.zeros(docs)

        def by_byte(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(flags)))
            return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

        n = by_doc(np.ones(len(doc)))
        words, size = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)
        return np.stack(
            [
                by_doc(weight) / words,
                by_doc(_member(hashes, self.fixed) >= 0) / words,
                by_doc(insult) / words,
                by_doc(person) / words,
                by_doc(insult & near) / words,
                by_byte(_UPPER[raw]) / size,
                by_doc(shout) / words,
                by_byte(_PUNCTUATION[raw]) / size,
                by_byte(raw == ord("!")) / words,
                by_byte(inside) / words,
                np.log1p(n),
            ],
            axis=1,
        )


def _featurise(lexicon):
    def function(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = lexicon.value.features(batch.column("text"))
        flat = pa.array(rows.ravel(), pa.float64())
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), flat)]

    return function


def with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with the array ``features``, in the order of ``FEATURES``."""
    return extend(docs, _featurise(docs.sparkSession.sparkContext.broadcast(lexicon)), _DDL, limit=2 << 20)


def _distinct_words(batches):
    for batch in slices(batches, "text", 2 << 20):
        raw, offsets = utf8(batch.column("text"))
        data = _FOLD[raw]
        start, end, doc = word_spans(data, offsets, _LETTER)
        lower = [data[s:e].tobytes().decode("utf-8", "replace").lower() for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        toxic = batch.column("toxic").to_pylist()
        seen = sorted(set(zip(doc.tolist(), lower, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for _, w in seen], pa.string()), pa.array([toxic[d] for d, _ in seen], pa.int32())],
            ["word", "toxic"],
        )


def learn_lexicon(sample: DataFrame, words: int = 400, min_docs: int = 4) -> dict[str, float]:
    """The ``words`` words with the highest log-odds of standing in a toxic document, and those log-odds.

    ``sample`` has text and toxic (0 or 1).  Only words at least e times likelier are taken, from ``min_docs`` toxic documents on.
    """
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return {}
    counted = arrow_map(sample.select("text", F.col("toxic").cast("int").alias("toxic")), _distinct_words, "word string, toxic int")
    per = counted.groupBy("word").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("both")
    )
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("both") - F.col("a") + 0.5) / (n0 + 1.0))
    top = per.filter(F.col("a") >= min_docs).select("word", odds.alias("odds")).filter("odds >= 1")
    return {r["word"]: r["odds"] for r in top.orderBy(F.desc("odds"), "word").limit(words).collect()}


class Classifier:
    """The fitted lexicon, trees and calibration; ``score`` adds ``score`` to a DataFrame with ``text``."""

    def __init__(self, lexicon: Lexicon, trees, calibration, constant: float | None = None):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def margins(self, featured: DataFrame) -> DataFrame:
        parts = featured.select("*", *[F.col("features")[i].alias(f"_f{i}") for i in range(len(FEATURES))])
        vector = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(FEATURES))], outputCol="_x").transform(parts)
        found = self.trees.transform(vector).withColumn("_margin", vector_to_array("_raw")[1])
        return found.drop("_x", "_raw", "_probability", "_class", "features", *[f"_f{i}" for i in range(len(FEATURES))])

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``score``; a text without words (null, too) is scored from zero features like any other.

        Repeated rows and null ids are scored row by row; an empty table gives none.
        """
        docs = docs.drop("score", "features")
        if self.constant is not None:
            return docs.withColumn("score", F.lit(self.constant))
        # The steps' own names begin with an underscore: such columns of the documents stand aside.
        aside = {c: f"own{c}" for c in docs.columns if c.startswith("_")}
        docs = docs.withColumnsRenamed(aside)
        margins = self.margins(with_features(docs, self.lexicon))
        scored = self.calibration.transform(margins)
        own = 1 / (1 + F.exp(-2 * F.col("_margin")))
        # Documents on one isotonic step still rank by their margin, through a hundredth of the score.
        calibrated = F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0))
        scored = scored.withColumn("score", 0.99 * calibrated + 0.01 * own).drop("_score", "_margin")
        return scored.withColumnsRenamed({new: old for old, new in aside.items()})


def _hash(text: Column) -> Column:
    """A number from 0 to 1 that depends on the text alone (null: empty)."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(1 << 30)) / float(1 << 30)


def _share(keyed: DataFrame, rows: int, *same: str) -> float:
    n = keyed.agg(F.approx_count_distinct(F.xxhash64(*same), 0.01)).head()[0]
    # The count is within some per cent, so a table of about ``rows`` is taken whole.
    return 1.0 if n <= 1.1 * rows else rows / n


def training_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` different (text, toxic) rows by hash of the text, with that hash ``_h``; all when they are fewer."""
    usable = labelled.filter("toxic IN (0, 1)").select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    keyed = usable.withColumn("_h", _hash(F.col("text")))
    return keyed.filter(F.col("_h") < _share(keyed, rows, "text", "toxic")).dropDuplicates(["_h", "text", "toxic"])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """:func:`training_sample` of ``docs`` (doc_id, text) joined to ``labels`` (doc_id, toxic), chosen before any text moves.

    Documents and labels meet as narrow rows (id, hash of the text); the ids that were chosen, about ``rows``, are
    broadcast back to the texts.  A null id has no label.
    """
    text = F.coalesce("text", F.lit(""))
    keys = docs.select("doc_id", F.xxhash64(text).alias("_k"), _hash(F.col("text")).alias("_h"))
    usable = labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropDuplicates()
    keyed = cut(keys.join(usable, "doc_id"))
    # Copies of a text need one of their ids; the others give the same rows.
    chosen = keyed.filter(F.col("_h") < _share(keyed, rows, "_k", "toxic")).groupBy("_k", "toxic").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_k"), _hash(F.col("text")).alias("_h"))
    return texts.join(F.broadcast(cut(chosen)), ["doc_id", "_k"]).select("text", "toxic", "_h").dropDuplicates(["_h", "text", "toxic"])


def train(labelled: DataFrame, rows: int = 20_000, trees: int = 20, depth: int = 3) -> Classifier:
    """Fit on at most about ``rows`` labelled rows (text, toxic), chosen by hash of the text.

    Rows whose label is null are left out.  With one class only, or no row, the score is constant.
    Equal rows count once, and copies of a text fall on one side of the fit and calibration split.
    """
    return fit(training_sample(labelled, rows), trees, depth)


def train_joined(docs: DataFrame, labels: DataFrame, rows: int = 20_000, trees: int = 20, depth: int = 3) -> Classifier:
    """:func:`train` on ``docs`` and the ``labels`` of their ids."""
    return fit(labelled_sample(docs, labels, rows), trees, depth)


def fit(sample: DataFrame, trees: int = 20, depth: int = 3) -> Classifier:
    """Fit on all rows of a bounded sample (text, toxic)."""
    sample = cut(sample)
    classes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return Classifier(Lexicon({}), None, None, float(next(iter(classes), 0)))
    # Copies share a hash and so a part.  The trees see words learned from other documents only; the
    # lexicon used from then on is learned from all of the sample.
    part = F.abs(F.xxhash64("text", F.lit(1)) % 10)
    half = Lexicon(learn_lexicon(sample.filter(part < 5).select("text", "toxic")))
    lexicon = Lexicon(learn_lexicon(sample.select("text", "toxic")))
    others = sample.filter(part >= 5).withColumn("_fit", part < 8)
    featured = cut(with_features(others, half).drop("text"))
    if featured.select("toxic").distinct().count() < 2:
        return Classifier(lexicon, None, None, float(classes.get(1, 0) / sum(classes.values())))
    made = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(FEATURES))], outputCol="_x").transform(
        featured.select("*", *[F.col("features")[i].alias(f"_f{i}") for i in range(len(FEATURES))])
    )
    gbt = GBTClassifier(
        featuresCol="_x", labelCol="toxic", predictionCol="_class",
        maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=5, seed=7,
    )
    gbt.set(gbt.rawPredictionCol, "_raw")
    gbt.set(gbt.probabilityCol, "_probability")
    model = gbt.fit(made.filter("_fit").select("_x", F.col("toxic").cast("double").alias("toxic")))
    calibrating = featured.filter("NOT _fit")
    held = calibrating if calibrating.select("toxic").distinct().count() == 2 else featured
    margins = Classifier(lexicon, model, None).margins(held).select("_margin", F.col("toxic").cast("double").alias("toxic"))
    isotonic = IsotonicRegression(featuresCol="_margin", labelCol="toxic", predictionCol="_score").fit(margins)
    return Classifier(lexicon, model, isotonic)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(text_crc(doc_id) % 5 == 0, F.lit(False))


