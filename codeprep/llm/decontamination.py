"""Which documents hold passages of a benchmark: winnowed fingerprints, joined and extended.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
one window. Of the ``window - gram + 1`` word grams of a window the one with the smallest hash
is kept (all of them if they tie), in documents as in items. Both sides keep the same gram of
a shared window, so a join on kept hashes misses none. Each kept gram carries the words around
it that any window over it can reach; a joined pair is extended over equal words to both sides
and counts if the match is a whole window. Items shorter than ``window`` have one gram, the
item itself, and documents then keep all grams of those lengths.

Documents are read once and not moved. A bitmap of the benchmark's kept hashes, of a fixed
size, is sent to all tasks and only lets through grams that may join; it grows less selective
with the benchmark, never wrong.

Null or empty texts have no words and hit nothing. Items without an id take no part; items
with the same id count as one. Rows that repeat, or share an id, are judged row by row; a null
id is kept. Empty tables give an empty result or one without hits. Further columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.llm import arrays, bitmaps
from codeprep.staging import stage

WINDOW = 13
GRAM = 5

_GRAM_TYPE = pa.struct(
    [
        ("size", pa.int32()),
        ("hash", pa.int64()),
        ("pos", pa.int32()),
        ("left", pa.int32()),
        ("words", pa.string()),
    ]
)
_GRAM_DDL = "array<struct<size:int,hash:bigint,pos:int,left:int,words:string>>"


def kept_grams(words: arrays.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that begin a kept gram, and the hashes of all grams."""
    hashes = arrays.grams(words.hashes[0], gram)
    spread = window - gram + 1
    left = words.left()
    if len(words.starts) < window:
        return np.zeros(0, np.int64), hashes
    lowest = hashes[: len(hashes) - spread + 1].copy()
    for i in range(1, spread):
        np.minimum(lowest, hashes[i : len(hashes) - spread + 1 + i], out=lowest)
    # Windows that leave their text are not windows.
    lowest[left[: len(lowest)] < window] = 0
    chosen = np.zeros(len(hashes), bool)
    for i in range(spread):
        inside = slice(i, i + len(lowest))
        chosen[inside] |= (hashes[inside] == lowest) & (lowest != 0)
    return np.flatnonzero(chosen), hashes


def _emit(
    batches: Iterator[pa.RecordBatch],
    id_col: str,
    text_col: str,
    window: int,
    gram: int,
    shorter: list[int] | None,
    bits: np.ndarray | None,
) -> Iterator[pa.RecordBatch]:
    """Per text its id, number of words and kept grams with the words around them.

    Without ``shorter`` the texts are items: each of fewer than ``window`` words is one gram.
    """
    for rows, raw, offsets in arrays.slices(batches, text_col):
        data = arrays.lower_ascii(raw)
        words = arrays.find_words(data, offsets, arrays.ALPHANUMERIC)
        owners, left = words.owners(), words.left()
        begins, sizes, hashes = [], [], []
        at, all_grams = kept_grams(words, window, gram)
        if bits is not None:
            at = at[bitmaps.held(bits, all_grams[at])]
        begins.append(at)
        sizes.append(np.full(len(at), gram))
        hashes.append(all_grams[at])
        if shorter is None:
            lengths = sorted({int(n) for n in words.counts if 0 < n < window})
        else:
            lengths = shorter
        for n in lengths:
            short = arrays.grams(words.hashes[0], n)
            ok = left[: len(short)] >= n
            if shorter is None:
                ok &= words.counts[owners[: len(short)]] == n
            at = np.flatnonzero(ok)
            if bits is not None:
                at = at[bitmaps.held(bits, short[at])]
            begins.append(at)
            sizes.append(np.full(len(at), -n))
            hashes.append(short[at])
        begin, size, value = map(np.concatenate, (begins, sizes, hashes))
        order = np.argsort(owners[begin], kind="stable") if len(begin) else begin
        begin, size, value = begin[order], size[order], value[order]
        owner = owners[begin]
        reach = np.where(size > 0, window - gram, 0)
        low = np.maximum(begin - reach, words.first[owner])
        high = np.minimum(begin + np.abs(size) + reach, words.first[owner + 1])
        flat = data.tobytes()
        s, e = words.starts, words.ends
        around = [
            b" ".join([flat[s[i] : e[i]] for i in range(a, b)]).decode("utf-8", "replace")
            for a, b in zip(low.tolist(), high.tolist())
        ]
        grams = pa.StructArray.from_arrays(
            [
                pa.array(size, pa.int32()),
                pa.array(value.view(np.int64)),
                pa.array(begin - words.first[owner], pa.int32()),
                pa.array(begin - low, pa.int32()),
                pa.array(around, pa.string()),
            ],
            fields=list(_GRAM_TYPE),
        )
        per_text = np.bincount(owner, minlength=rows.num_rows) if len(owner) else np.zeros(rows.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(id_col),
                pa.array(words.counts, pa.int64()),
                arrays.list_array(grams, per_text),
            ],
            names=["id", "n_words", "grams"],
        )


def _texts_with_grams(df, id_col, text_col, window, gram, shorter=None, bits=None) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("id", df.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("grams", T.DataType.fromDDL(_GRAM_DDL)),
        ]
    )

    def run(batches):
        known = bits.value if bits is not None else None
        return _emit(batches, id_col, text_col, window, gram, shorter, known)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def _extend(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            found = []
            for row, size, pos, dleft, dwords, cls, ileft, iwords in zip(
                pairs["row"], pairs["size"], pairs["pos"], pairs["left"], pairs["words"],
                pairs["cls"], pairs["item_left"], pairs["item_words"],
            ):
                a, b = dwords.split(" "), iwords.split(" ")
                if size < 0:
                    if a == b:
                        found.append((row, pos, pos - size, cls))
                    continue
                if a[dleft : dleft + size] != b[ileft : ileft + size]:
                    continue
                back = 0
                while back < min(dleft, ileft) and a[dleft - back - 1] == b[ileft - back - 1]:
                    back += 1
                ahead, most = size, min(len(a) - dleft, len(b) - ileft)
                while ahead < most and a[dleft + ahead] == b[ileft + ahead]:
                    ahead += 1
                if back + ahead >= window:
                    found.append((row, pos - back, pos + ahead, cls))
            yield pd.DataFrame(found, columns=["row", "start", "stop", "cls"])

    return run


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted ids as text) and contaminated.

    A document is contaminated if it has hit words and they are a twentieth or more of all.
    """
    spark = documents.sparkSession
    items = benchmark.filter(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("words_of")
    )
    # Items of one text are one class until the end.
    classes = items.groupBy("words_of").agg(F.min("item").alias("cls"))
    members = stage(items.join(classes, "words_of").select("cls", "item").distinct(), "items")
    fingerprints = stage(
        _texts_with_grams(classes, "cls", "words_of", window, gram)
        .select(F.col("id").alias("cls"), F.explode("grams").alias("g"))
        .select("cls", "g.size", "g.hash", F.col("g.left").alias("item_left"), F.col("g.words").alias("item_words"))
        .distinct(),
        "fingerprints",
    )
    # Lengths below the window: fewer than ``window`` numbers.
    shorter = [-r[0] for r in fingerprints.filter("size < 0").select("size").distinct().collect()]
    bits = spark.sparkContext.broadcast(bitmaps.bitmap(fingerprints, "hash"))
    texts = stage(
        _texts_with_grams(documents, id_col, text_col, window, gram, sorted(shorter), bits)
        .withColumn("row", F.monotonically_increasing_id()),
        "document-grams",
    )
    pairs = (
        texts.filter(F.size("grams") > 0)
        .select("row", F.explode("grams").alias("g"))
        .select("row", "g.*")
        .join(fingerprints, ["size", "hash"])
        .select("row", "size", "pos", "left", "words", "cls", "item_left", "item_words")
    )
    found = stage(
        pairs.mapInPandas(_extend(window), "row bigint, start int, stop int, cls string").distinct(),
        "hits",
    )
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        found.groupBy("row", "start")
        .agg(F.max("stop").alias("stop"))
        .withColumn("done", F.coalesce(F.max("stop").over(before), F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "done"))).alias("n_hit"))
    )
    of_items = (
        found.select("row", "cls").distinct()
        .join(members, "cls")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return (
        texts.select("row", F.col("id").alias(id_col), "n_words")
        .join(hit, "row", "left")
        .join(of_items, "row", "left")
        .select(
            id_col,
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
        )
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Documents without the contaminated ones; rows are told apart by a hash of id and text.

    Further columns may have any name and type.
    """
    key = F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col)))
    named = F.struct(key.alias("hash"), F.col(id_col).alias("id")).alias("key")
    found = find_contamination(documents.select(named, F.col(text_col).alias("body")), benchmark, "key", "body")
    bad = stage(found.filter("contaminated").select("key.*").distinct(), "contaminated")
    return bitmaps.parted(documents, key, [F.col(id_col)], bad)[1]
