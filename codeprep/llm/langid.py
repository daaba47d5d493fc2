"""Language of texts by string kernels: n-gram presence, Nystroem landmarks, ridge regression.

The blended-spectrum kernel of two texts is the number of distinct runs of 1 to ``LONGEST`` bytes
that both hold, divided by the root of the product of their own numbers. Landmarks are texts of
the training sample, as many of each language. With K the kernel matrix of the landmarks, a text's
kernel values times K^(-1/2) are its Nystroem features; one kernel ridge regression per language,
against the rest, is fitted on the features of the sample. All linear steps after the kernel
values are one matrix, from landmarks to languages. Texts are scored in batches: a sparse
presence matrix of the landmarks' n-grams times that matrix's product with their own presence.

The sample is bounded: at most ``SAMPLE`` texts of each language and about ``TOTAL`` of all, by
smallest hash of the id, none of them held out. Their n-grams, of the whole texts, come to the
driver; texts do not. All texts are predicted, whole.

A prediction is the language with the largest regression value; its score is its share in the
softmax over the languages, or 1 if there is one. Null, empty or letterless texts are ``und`` with
score 0, as all are if nothing can be learnt. Null ids are never held out and never learnt from.
Rows that share an id are predicted row by row. Empty tables give an empty result. Further
columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.llm import arrays
from codeprep.staging import stage

FOLDS, HELD_OUT = 5, 0
LONGEST = 3
SAMPLE, TOTAL, FEWEST = 300, 2400, 20
LANDMARKS = 40  # of each language
RIDGE = 1e-3
SHARPNESS = 8.0

_LETTER = re.compile(r"[^\W\d_]")


def _codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) pairs; an n-gram is a number below 2^24 + 2^16 + 2^8."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    left = offsets[1:][owner] - np.arange(n)
    # White space, digits and signs of ASCII are one byte, and capitals are small letters.
    plain = _FOLD[data].astype(np.int64)
    base, parts, owners, code = 0, [], [], np.zeros(n, np.int64)
    for length in range(1, LONGEST + 1):
        shifted = plain[length - 1 :]
        code = code[: len(shifted)] * 256 + shifted
        ok = left[: len(code)] >= length
        parts.append(code[ok] + base)
        owners.append(owner[: len(code)][ok])
        base += 256**length
    key = np.concatenate(owners) * base + np.concatenate(parts)
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return key // base, key % base


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[:0x41] = 0x20
_FOLD[0x5B:0x61] = 0x20
_FOLD[0x7B:0x80] = 0x20


class Model:
    """``grams``: the landmarks' n-grams; ``weights``: one row per n-gram, one column per language."""

    def __init__(self, languages, grams, weights, bias):
        self.languages, self.grams, self.weights, self.bias = languages, grams, weights, bias
        size = sum(256**n for n in range(1, LONGEST + 1))
        self.size = size

    def table(self) -> np.ndarray:
        """Row of each n-gram, or -1; made once in a worker."""
        if not hasattr(self, "_table"):
            self._table = np.full(self.size, -1, np.int32)
            self._table[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        return self._table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def values(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Regression values, texts by languages."""
        texts = len(offsets) - 1
        owner, gram = _codes(data, offsets)
        own = np.bincount(owner, minlength=texts)
        row = self.table()[gram]
        known = row >= 0
        owner, row = owner[known], row[known]
        # The presence matrix is sparse: its product is a sum of rows per text.
        out = np.zeros((texts, len(self.languages)))
        if len(owner):
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            out[owner[begin]] = np.add.reduceat(self.weights[row], begin, axis=0)
        return out / np.sqrt(np.maximum(own, 1))[:, None] + self.bias

    def predict(self, data, offsets) -> tuple[np.ndarray, np.ndarray]:
        values = self.values(data, offsets) * SHARPNESS
        share = np.exp(values - values.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = np.argmax(values, axis=1)
        return best, share[np.arange(len(best)), best]


def fit_model(texts: list[np.ndarray], langs: list[str], landmarks: np.ndarray) -> Model:
    """Ridge regressions on Nystroem features, from the n-grams of each text.

    ``landmarks`` marks the texts that are some.
    """
    languages = sorted(set(langs))
    own = np.array([len(t) for t in texts])
    owner, gram = np.repeat(np.arange(len(texts)), own), np.concatenate(texts).astype(np.int64)
    own = np.maximum(own, 1)
    place = np.cumsum(landmarks) - 1
    of_landmark = landmarks[owner]
    grams = np.unique(gram[of_landmark])
    # Presence of the landmarks' n-grams, scaled: landmarks by n-grams.
    marks = np.zeros((int(landmarks.sum()), len(grams)), np.float32)
    marks[place[owner[of_landmark]], np.searchsorted(grams, gram[of_landmark])] = 1
    marks /= np.sqrt(own[landmarks])[:, None]
    # Kernel of all texts with the landmarks, text by text: their n-grams among the landmarks'.
    at = np.searchsorted(grams, gram)
    at[at == len(grams)] = 0
    known = grams[at] == gram
    bounds = np.searchsorted(owner[known], np.arange(len(texts) + 1))
    column = at[known]
    kernel = np.stack(
        [marks[:, column[a:b]].sum(axis=1) for a, b in zip(bounds, bounds[1:])]
    ).astype(np.float64) / np.sqrt(own)[:, None]
    among = kernel[landmarks]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    target = np.array([[1.0 if lang == one else -1.0 for one in languages] for lang in langs])
    centre = features.mean(axis=0)
    x = features - centre
    mean = target.mean(axis=0)
    beta = np.linalg.solve(x.T @ x + RIDGE * len(x) * np.eye(x.shape[1]), x.T @ (target - mean))
    weights = marks.T.astype(np.float64) @ (root @ beta)
    return Model(languages, grams, weights, mean - centre @ beta)


def fold(row_id: Column) -> Column:
    return F.crc32(row_id.cast("string")) % FOLDS


def fit(documents: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model | None:
    """Model from the sample, which alone comes to the driver, its texts cut."""
    learnt = documents.filter(
        (fold(F.col(id_col)) != HELD_OUT) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    )
    ids = stage(
        learnt.select(
            F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("hash")
        ),
        "language-ids",
    )
    languages = ids.agg(F.count_distinct("lang")).first()[0]
    if not languages:
        return None
    most = max(FEWEST, min(SAMPLE, TOTAL // languages))
    first = Window.partitionBy("lang").orderBy("hash", "id")
    chosen = ids.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most)
    # A row per sampled text, at most ``most`` of each language.
    rows = (
        documents.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen.select("id", "lang", "place")), ["id", "lang"])
        .select("lang", "place", "text")
        .mapInArrow(_grams_of, "lang string, place int, grams binary")
        # Of the texts of one id the smallest counts, whatever the partitions.
        .groupBy("lang", "place").agg(F.min("grams").alias("grams"))
        .orderBy("lang", "place")
        .collect()
    )
    texts = [np.frombuffer(r.grams, "<i4") for r in rows]
    landmarks = np.array([r.place <= min(LANDMARKS, most // 2) for r in rows])
    if not sum(map(len, texts)):
        return None
    return fit_model(texts, [r.lang for r in rows], landmarks)


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in arrays.slices(batches, "text", 1 << 20):
        owner, gram = _codes(data, offsets)
        bounds = np.searchsorted(owner, np.arange(rows.num_rows + 1))
        grams = [gram[a:b].astype("<i4").tobytes() for a, b in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang"), rows.column("place"), pa.array(grams, pa.binary())],
            names=["lang", "place", "grams"],
        )


def predict_language(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Per document: id, held_out, lang_pred, score."""
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, id_col, text_col, lang_col))
    schema = T.StructType(
        [
            T.StructField("id", documents.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for rows, data, offsets in arrays.slices(batches, text_col, 1 << 20):
            texts = rows.column(text_col).to_pylist()
            letter = np.array([bool(t) and _LETTER.search(t) is not None for t in texts])
            names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
            if known is not None:
                best, share = known.predict(data, offsets)
                names = np.where(letter, np.array(known.languages, object)[best], "und")
                scores = np.where(letter, share, 0.0)
            yield pa.RecordBatch.from_arrays(
                [rows.column(id_col), pa.array(names.tolist(), pa.string()), pa.array(scores)],
                names=["id", "lang_pred", "score"],
            )

    return documents.select(id_col, text_col).mapInArrow(run, schema).select(
        F.col("id").alias(id_col),
        F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
