"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters look at a text and fire or not. There are mined lexicon voters (a word, or a beginning of
words, that toxic sample texts hold far more often: once, or in a share of their words), lexicons of common insults by language, and
patterns (address with an insult, threats, masked words, shouting, strings of exclamation
marks). The labels of the sample are one more voter, which may err.

The label model has a hidden true label per text and per voter how often it fires on toxic and
on clean texts. It is fitted by expectation maximisation on the votes alone, starting from the
labels. Correlations of voters, given the hidden label, are estimated as well: a voter that says
what others say (a word and its beginning) counts by its share of them. The posterior labels
then train a logistic regression on the same signals, and that scores all texts.

The sample is bounded: at most ``TOXIC`` and ``CLEAN`` labelled and ``UNLABELLED`` other texts, by
smallest hash of the id, none of them held out. Only votes and counts of the sample come to the
driver, no texts; the model is a few hundred numbers. All texts are scored, whole, in one scan.

Null and empty texts fire no voter and get the score of such texts. A null id is never held out
and never learnt from. Rows that share an id are scored row by row; a label that is given
several times counts by its mean, null labels not at all. Without a toxic or without a clean label
every score is the share of toxic labels, 0 if there are none. Empty tables give an empty result.
Further columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.llm import arrays
from codeprep.staging import stage

FOLDS, HELD_OUT = 4, 2
TOXIC, CLEAN, UNLABELLED = 3000, 5000, 1000
TERMS = 400
LEAST_TEXTS, LEAST_SHARE = 4, 0.015  # of the toxic sample, so that no few near copies make a term
BEGINNINGS = (3, 4, 5, 6, 7)  # bytes
# A term fires from so many occurrences, and so many per word of the text.
LEVELS = ((1, 0.0), (2, 0.006))
SURE, LEAST_RATIO = 2.6, 0.5
THRESHOLD = 0.3

# Common insults; a voter each.
LEXICONS = {
    "en": "idiot stupid moron loser pathetic worthless trash scum dumbass bastard jerk imbecile",
    "de": "idiot dumm trottel arschloch vollidiot abschaum versager wertlos depp miststück",
    "fr": "idiot imbécile crétin connard salaud minable abruti ordure débile",
    "es": "idiota imbécil estúpido basura gilipollas patético inútil escoria tonto",
}
PATTERNS = (
    rb"(?i)\byou(?:'re| are)?(?: such)?(?: an?)? (?:\w+ )?(?:idiot|moron|loser|clown|trash|scum)",
    rb"(?i)\b(?:kill yourself|go die|shut up|go to hell|hate you|nobody likes you)\b",
    rb"\b[A-Za-z][*#@$%]{2,}[A-Za-z]*\b",
    rb"\b[A-Z]{4,}(?: [A-Z]{3,}){2,}",
    rb"[!?]{3,}",
)
_PATTERN = [re.compile(p) for p in PATTERNS]

_PASSES = 12


def _spans(words: arrays.Words, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their beginnings, and the word each belongs to."""
    every = np.arange(len(words.starts))
    hashes, of = [words.hashes[0]], [every]
    length = words.ends - words.starts
    for n in BEGINNINGS:
        some = np.flatnonzero(length >= n)
        value = np.zeros(len(some), np.uint64)
        for i in range(n):
            value = value * np.uint64(257) + data[words.starts[some] + i].astype(np.uint64) + np.uint64(1)
        hashes.append(arrays.mix(value * np.uint64(arrays.STEPS[0]) + np.uint64(n)))
        of.append(some)
    return np.concatenate(hashes), np.concatenate(of)


def _lexicon_hashes() -> list[np.ndarray]:
    out = []
    for words in LEXICONS.values():
        data, offsets = arrays.utf8(pa.array([words]))
        out.append(arrays.find_words(data, offsets, arrays.ALPHANUMERIC).hashes[0])
    return out


class Voters:
    """Which voters fire on each text: mined terms at a level, then lexicons, then patterns."""

    def __init__(self, terms: np.ndarray, levels: np.ndarray):
        lexicons = _lexicon_hashes()
        words = np.concatenate([terms, *lexicons])
        levels = np.concatenate([levels, np.zeros(len(words) - len(terms), np.int64)])
        voter = np.concatenate(
            [np.arange(len(terms)), *[np.full(len(h), len(terms) + i) for i, h in enumerate(lexicons)]]
        )
        order = np.argsort(words, kind="stable")
        self.words, self.levels, self.voter = words[order], levels[order], voter[order]
        self.count = len(terms) + len(lexicons) + len(PATTERNS)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def fire(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pairs (text, voter)."""
        data = arrays.lower_ascii(raw)
        words = arrays.find_words(data, offsets, arrays.ALPHANUMERIC)
        hashes, of = _spans(words, data)
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        owners = words.owners()[of[some]]
        hashes = hashes[some]
        low = np.searchsorted(self.words, hashes, side="left")
        entries = len(self.words)
        pairs = []
        # A word may be in several lexicons, a term at several levels.
        while len(low):
            hit = low < entries
            hit[hit] = self.words[low[hit]] == hashes[hit]
            hashes, owners, low = hashes[hit], owners[hit], low[hit]
            pairs.append(owners * entries + low)
            low = low + 1
        key, times = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]), return_counts=True)
        text, entry = key // max(entries, 1), key % max(entries, 1)
        level = self.levels[entry]
        least = np.array([n for n, _ in LEVELS])[level]
        rate = np.array([r for _, r in LEVELS])[level]
        fired = (times >= least) & (times >= rate * words.counts[text])
        texts, voters = [text[fired]], [self.voter[entry[fired]]]
        first_pattern = self.count - len(PATTERNS)
        flat, bounds = raw.tobytes(), offsets.tolist()
        for i, pattern in enumerate(_PATTERN):
            found = [t for t, (a, b) in enumerate(zip(bounds, bounds[1:])) if pattern.search(flat, a, b)]
            texts.append(np.array(found, np.int64))
            voters.append(np.full(len(found), first_pattern + i))
        pair = np.unique(np.concatenate(texts) * self.count + np.concatenate(voters))
        return pair // self.count, pair % self.count


@dataclass
class LabelModel:
    """Firing rates of the voters on toxic and clean texts, their shares, and the prior."""

    toxic: np.ndarray
    clean: np.ndarray
    share: np.ndarray
    prior: float

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        yes = self.share * np.log(self.toxic / self.clean)
        no = self.share * np.log((1 - self.toxic) / (1 - self.clean))
        return np.log(self.prior / (1 - self.prior)) + votes @ (yes - no) + no.sum()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_labels(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[LabelModel, np.ndarray]:
    """Label model and posterior of each text. Labels are 1, 0, or -1 where there is none.

    ``weights`` restore the shares that sampling by label changed.
    """
    known = labels >= 0
    prior = float(np.clip(weights[labels == 1].sum() / weights[known].sum(), 1e-4, 0.9))
    posterior = np.where(labels == 1, 0.97, np.where(labels == 0, 0.03 * prior, prior))
    model = None
    for _ in range(_PASSES):
        w1, w0 = posterior * weights, (1 - posterior) * weights
        toxic = (w1 @ votes + 0.5 * prior) / (w1.sum() + 1)
        clean = (w0 @ votes + 0.05) / (w0.sum() + 1)
        toxic, clean = np.clip(toxic, 1e-6, 1 - 1e-6), np.clip(clean, 1e-6, 1 - 1e-6)
        # How the votes vary together among toxic and among clean texts.
        covariance = (
            (votes * w1[:, None]).T @ votes
            + (votes * w0[:, None]).T @ votes
            - w1.sum() * np.outer(toxic, toxic)
            - w0.sum() * np.outer(clean, clean)
        )
        deviation = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = np.abs(covariance / np.outer(deviation, deviation))
        correlation[correlation < 0.2] = 0
        np.fill_diagonal(correlation, 1)
        prior = float(np.clip(w1.sum() / weights.sum(), 1e-4, 0.9))
        model = LabelModel(toxic, clean, 1 / correlation.sum(axis=1), prior)
        odds = model.log_odds(votes)
        # The given label is a voter too.
        hit = np.clip((w1 * (labels == 1)).sum() / max((w1 * known).sum(), 1e-9), 0.6, 0.995)
        false = np.clip((w0 * (labels == 1)).sum() / max((w0 * known).sum(), 1e-9), 0.001, 0.4)
        odds += np.where(labels == 1, np.log(hit / false), 0)
        odds += np.where(labels == 0, np.log((1 - hit) / (1 - false)), 0)
        posterior = _sigmoid(odds)
    return model, posterior


def fit_classifier(votes: np.ndarray, target: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with a small penalty, by accelerated gradient steps."""
    n, m = votes.shape
    weights = weights / weights.sum()
    x = np.concatenate([votes, np.ones((n, 1))], axis=1)
    penalty = np.full(m + 1, 1e-4)
    penalty[-1] = 0
    step = 4 / (float((weights[:, None] * x * x).sum(axis=0).sum()) + 1e-3)
    beta = np.zeros(m + 1)
    momentum = beta.copy()
    for i in range(600):
        slope = x.T @ (weights * (_sigmoid(x @ momentum) - target)) + penalty * momentum
        new = momentum - step * slope
        momentum = new + i / (i + 3) * (new - beta)
        beta = new
    return beta[:-1], float(beta[-1])


def fold(row_id: Column) -> Column:
    return F.crc32(row_id.cast("string")) % FOLDS


def _ids_and_labels(documents: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """The sample's ids with label (1, 0, -1) and weight; at most TOXIC + CLEAN + UNLABELLED rows."""
    learnt = fold(F.col(id_col)) != HELD_OUT
    given = (
        labels.filter(learnt & F.col("toxic").isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
    )
    given = stage(given, "labels")
    ids = documents.filter(learnt).select(F.col(id_col).alias("id")).distinct()
    others = ids.join(given, "id", "left_anti").withColumn("label", F.lit(-1))
    by_hash = [F.xxhash64("id"), F.col("id")]
    sample = others.orderBy(*by_hash).limit(UNLABELLED).withColumn("weight", F.lit(1.0))
    for label, most in ((1, TOXIC), (0, CLEAN)):
        rows = given.filter(F.col("label") == label)
        total = rows.count()
        # Each label keeps the share that it has among all labels.
        weight = F.lit(total / max(1, min(total, most)))
        sample = sample.unionByName(rows.orderBy(*by_hash).limit(most).withColumn("weight", weight))
    return stage(sample, "sample-ids")


def _text_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each text that reach a level, with the text's label."""
    for rows, raw, offsets in arrays.slices(batches, "text"):
        data = arrays.lower_ascii(raw)
        words = arrays.find_words(data, offsets, arrays.ALPHANUMERIC)
        hashes, of = _spans(words, data)
        owner = words.owners()[of]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(hashes)))
        hashes, owner = hashes[at], owner[at]
        for level, (least, rate) in enumerate(LEVELS):
            reached = (times >= least) & (times >= rate * words.counts[owner])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[reached].view(np.int64)),
                    pa.array(np.full(int(reached.sum()), level, np.int32)),
                    rows.column("label").take(pa.array(owner[reached])),
                ],
                names=["term", "level", "label"],
            )


def mine_terms(sample: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and levels of the ``TERMS`` terms that tell most surely for toxic texts.

    Sure is what of the logarithm of the ratio of shares is left ``SURE`` standard errors lower.
    """
    counts = (
        sample.filter("label >= 0").select("text", "label")
        .mapInArrow(_text_terms, "term bigint, level int, label int")
        .groupBy("term", "level")
        .agg(F.sum("label").alias("in_toxic"), F.sum(1 - F.col("label")).alias("in_clean"))
        .filter(F.col("in_toxic") >= max(LEAST_TEXTS, LEAST_SHARE * toxic))
    )
    a, b = F.col("in_toxic") + 0.5, F.col("in_clean") + 0.5
    ratio = F.log(a / F.lit(toxic + 1.0)) - F.log(b / F.lit(clean + 1.0))
    surely = ratio - SURE * F.sqrt(1 / a + 1 / b)
    top = (
        counts.withColumn("surely", surely).filter(F.col("surely") > LEAST_RATIO)
        .orderBy(F.col("surely").desc(), "term", "level").limit(TERMS).collect()
    )
    terms = np.array([r.term for r in top], np.int64).view(np.uint64)
    return terms, np.array([r.level for r in top], np.int64)


def _votes_of(voters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in arrays.slices(batches, "text"):
            text, voter = voters.value.fire(raw, offsets)
            fired = arrays.list_array(
                pa.array(voter.astype(np.int32)), np.bincount(text, minlength=rows.num_rows)
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column("label"), rows.column("weight"), fired], names=["label", "weight", "fired"]
            )

    return run


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray
    bias: float


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    spark = documents.sparkSession
    ids = _ids_and_labels(documents, labels, id_col)
    # The ids are a bounded table. A text that is there several times counts once.
    sample = stage(
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(ids), "id")
        .groupBy("text", "label")
        .agg(F.max("weight").alias("weight")),
        "sample",
    )
    count = {r.label: r for r in sample.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    if 1 not in count or 0 not in count:
        share = 1.0 if 1 in count else 0.0
        return Model(Voters(np.zeros(0, np.uint64), np.zeros(0, np.int64)), None, share)
    voters = Voters(*mine_terms(sample, count[1].n, count[0].n))
    sent = spark.sparkContext.broadcast(voters)
    rows = (
        sample.select("text", "label", "weight")
        .mapInArrow(_votes_of(sent), "label int, weight double, fired array<int>")
        .collect()
    )
    rows.sort()
    votes = np.zeros((len(rows), voters.count))
    for i, row in enumerate(rows):
        votes[i, row.fired] = 1
    label = np.array([r.label for r in rows])
    weight = np.array([r.weight for r in rows])
    _, posterior = fit_labels(votes, label, weight)
    weights, bias = fit_classifier(votes, posterior, weight)
    return Model(voters, weights, bias)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` per row."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for rows, raw, offsets in arrays.slices(batches, text_col):
            if known.weights is None:
                scores = np.full(rows.num_rows, known.bias)
            else:
                text, voter = known.voters.fire(raw, offsets)
                total = np.bincount(text, known.weights[voter], minlength=rows.num_rows)
                scores = _sigmoid(total + known.bias)
            yield pa.RecordBatch.from_arrays([rows.column(id_col), pa.array(scores)], names=["id", "score"])

    schema = T.StructType(
        [T.StructField("id", documents.schema[id_col].dataType), T.StructField("score", T.DoubleType())]
    )
    return documents.select(id_col, text_col).mapInArrow(run, schema)


def toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    scored = score(documents, fit(documents, labels, id_col, text_col), id_col, text_col)
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, scored and filtered in one scan; texts do not move."""
    model = fit(documents, labels, id_col, text_col)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for rows, raw, offsets in arrays.slices(batches, text_col):
            if known.weights is None:
                toxic = np.full(rows.num_rows, known.bias >= THRESHOLD)
            else:
                text, voter = known.voters.fire(raw, offsets)
                total = np.bincount(text, known.weights[voter], minlength=rows.num_rows)
                toxic = _sigmoid(total + known.bias) >= THRESHOLD
            yield rows.filter(pa.array(~toxic))

    return documents.mapInArrow(run, documents.schema)
