"""Corpus vocabulary, token ids and padded batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.operators.ranking import number_rows
from codeprep.operators.splitting import SEED, shuffle_key
from codeprep.sources.instructions import ORDER
from codeprep.staging import stage
from codeprep.workers import batches_of, reachable

# Reserved ids, sequence limit, batch rows, padding step, label padding.
PAD_ID = 0
UNKNOWN_ID = 1
END_ID = 2
FIRST_ID = 3
MAX_TOKENS = 4096
BATCH_ROWS = 4
PAD_MULTIPLE = 8
LABEL_PAD = -100

# A token is a run of word characters or one other visible character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{Z}\t-\r\x1c-\x1f\x85]"

# The first tokens of a vocabulary are broadcast, up to this many tokens and bytes.
MAX_BROADCAST_TOKENS = 500_000
MAX_BROADCAST_BYTES = 32_000_000

# Bytes of text that a task gets from Spark and translates together.
SLICE_BYTES = 8 << 20

# Tokens that the summary of a task holds at least.
LEAST_CAPACITY = 1 << 16

ROWS_PER_SHARD = 10_000

_LOOKED_UP = ("input_ids", "open", "block", "rest")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def _most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """Tokens at least as frequent as the ``size``-th one; ties may add more.

    Counts tokens by their frequency: few different values, however many tokens.
    """
    before = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    least = (
        counts.groupBy("n")
        .agg(F.count("*").alias("size"))
        .withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .filter(F.col("before") < size)
        .agg(F.min("n"))
    )
    return counts.filter(F.col("n") >= least.scalar())


def _lines(texts: DataFrame, *ids: str) -> DataFrame:
    """``ids`` and ``lines``, the tokens of each text, each on a line: no token holds a line end."""
    if "lines" in texts.columns:
        return texts.select(*ids, "lines")
    return texts.select(*ids, F.array_join(tokens(F.col("text")), "\n").alias("lines"))


def tokenise(texts: DataFrame, ids: Sequence[str] = ORDER) -> DataFrame:
    """The tokens of the column ``text``, written once: for ``fit_vocab`` and ``encode``, which else
    would each make the texts and find their tokens.
    """
    return stage(_lines(texts, *ids), "token-lines")


def _split_lines(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts, and how many each has."""
    # An empty text would be split into one empty line.
    full = pc.fill_null(pc.not_equal(lines, ""), False)
    split = pc.split_pattern(lines.filter(full), "\n")
    sizes = np.zeros(len(lines), np.int64)
    sizes[full.to_numpy(zero_copy_only=False)] = pc.list_value_length(split).to_numpy()
    return pc.list_flatten(split), sizes


def _slice_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences per token in each slice of the texts."""
    for rows in _slices(batches, "lines"):
        counted = _split_lines(rows.column("lines"))[0].value_counts()
        yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["token", "n"])


def count_tokens(texts: DataFrame) -> DataFrame:
    """Occurrences per token of the column ``text``; counted in slices, then in tasks, before the shuffle.

    Run the jobs that need it inside ``batches_of``, as ``fit_vocab`` does.
    """
    reachable(texts.sparkSession)
    counted = _lines(texts).mapInArrow(_slice_counts, "token string, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _summaries(capacity: int):
    """Misra-Gries summary of the tokens of a task: at most ``capacity`` tokens with a lower
    bound of their count, and under the empty token how much any count may be above it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = pd.Series(dtype=np.int64), 0
        for rows in _slices(batches, "lines"):
            counted = _split_lines(rows.column("lines"))[0].value_counts()
            new = pd.Series(counted.field("counts").to_numpy(), counted.field("values").to_pylist())
            held = held.add(new, fill_value=0).astype(np.int64)
            if len(held) > capacity:
                cut = int(np.partition(held.to_numpy(), -capacity - 1)[-capacity - 1])
                held, over = held[held > cut] - cut, over + cut
        held[""] = over
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.index.tolist(), pa.string()), pa.array(held.to_numpy())], names=["token", "n"]
        )

    return run


def _count_frequent(texts: DataFrame, size: int, capacity: int) -> DataFrame:
    """Exact counts of tokens that hold the ``size`` most frequent ones.

    Summaries of the tasks are added up; a token that may be among the most frequent by its
    bounds is counted, all others are not, so what is shuffled does not grow with the number of
    different tokens. If the bounds leave room for a token that no summary holds, all are counted.
    """
    reachable(texts.sparkSession)
    summary = _summaries(capacity)
    summed = stage(
        _lines(texts).mapInArrow(summary, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n")),
        "token-summary",
    )
    over = (summed.filter("token = ''").agg(F.max("n").alias("n")).first().n) or 0
    found = summed.filter("token != ''")
    if not over:
        return found
    least = _most_frequent(found, size).agg(F.min("n").alias("n"), F.count("*").alias("size")).first()
    if least.size < size or least.n <= over:
        return stage(count_tokens(texts), "token-counts")
    likely = stage(found.filter(F.col("n") + over >= least.n).select("token"), "likely-tokens")
    weight = likely.agg(F.count("*").alias("n"), F.sum(F.octet_length("token")).alias("bytes")).first()
    if weight.n <= MAX_BROADCAST_TOKENS and weight.bytes <= MAX_BROADCAST_BYTES:
        likely = F.broadcast(likely)
    every = _lines(texts).select(F.explode(F.split("lines", "\n")).alias("token"))
    return stage(every.join(likely, "token").groupBy("token").agg(F.count("*").alias("n")), "token-counts")


def fit_vocab(texts: DataFrame, max_size: int | None = None, capacity: int | None = None) -> DataFrame:
    """Token, count and id; ids run from 3 by falling count, then by token.

    Ids come from a distributed sort, so the vocabulary may be of any size.
    With ``max_size`` only the most frequent tokens are sorted and get an id, and
    only tokens that may be among them are counted; a task keeps ``capacity``
    tokens to tell which.
    """
    with batches_of(texts.sparkSession, SLICE_BYTES):
        if max_size:
            room = capacity or max(LEAST_CAPACITY, 4 * max_size)
            counts = _most_frequent(_count_frequent(texts, max_size, room), max_size)
        else:
            counts = count_tokens(texts)
        ranked = number_rows(counts, [F.desc("n"), F.asc("token")], "rank")
    vocab = ranked.select("token", "n", (F.col("rank") + FIRST_ID).alias("id"))
    return vocab.filter(F.col("id") < FIRST_ID + max_size) if max_size else vocab


def _frequent(vocab: DataFrame) -> DataFrame:
    """First tokens of the vocabulary, as many as the limits for a broadcast allow.

    They are ``MAX_BROADCAST_TOKENS`` at most, and so is what the running sum sees.
    """
    upto = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        vocab.filter(F.col("id") < FIRST_ID + MAX_BROADCAST_TOKENS)
        .select("token", "id", F.sum(F.octet_length("token")).over(upto).alias("bytes"))
        .filter(F.col("bytes") <= MAX_BROADCAST_BYTES)
        .drop("bytes")
    )


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows in runs of about ``SLICE_BYTES`` of a text column; the text that reaches them ends a run."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        sizes = sizes.astype(np.int64)
        run = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)


def _places(known: pa.Array, names: pa.Array) -> np.ndarray:
    """Where each of ``names`` stands in ``known``, or -1. Only the names are hashed: those of one slice."""
    found = pc.index_in(known, value_set=names)
    at = np.full(len(names), -1, np.int32)
    at[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
    return at


def _look_up(frequent: Broadcast, ids: Sequence[str]):
    """Ids of the tokens of each text, which stand on a line each.

    A token that is not frequent gets -1 - its place among those of its slice, which the first
    row of the slice lists once each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_ids = frequent.value
        block = TaskContext.get().partitionId() << 32
        for rows in _slices(batches, "lines"):
            flat, sizes = _split_lines(rows.column("lines"))
            kinds = flat.dictionary_encode()
            at = _places(known, kinds.dictionary)
            new = at < 0
            number = np.where(new, -np.cumsum(new), known_ids[at]).astype(np.int32)
            values = number[kinds.indices.to_numpy()]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            rest = pa.array([None] * rows.num_rows, pa.list_(pa.string()))
            lowest = np.zeros(rows.num_rows, bool)
            if new.any():
                listed = kinds.dictionary.filter(pa.array(new))
                first = pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed)
                rest = pa.concat_arrays([first, rest.slice(1)])
                lowest[sizes > 0] = np.minimum.reduceat(values, offsets[:-1][sizes > 0]) < 0
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(c) for c in ids],
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    pa.array(lowest),
                    pa.array(np.full(rows.num_rows, block, np.int64)),
                    rest,
                ],
                names=[*ids, *_LOOKED_UP],
            )
            block += 1

    return run


def _fill(rows: pa.Table, found: pa.Table) -> pa.Table:
    """Rows of one slice with the ids of its other tokens in their places."""
    number = np.zeros(len(found), np.int32)
    number[found["place"].to_numpy()] = found["id"].to_numpy()
    lists = rows["input_ids"].combine_chunks()
    values = lists.flatten().to_numpy().copy()
    open_ = values < 0
    values[open_] = number[-1 - values[open_]]
    sizes = pc.list_value_length(lists).to_numpy()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    filled = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    return rows.drop_columns(["block"]).set_column(rows.column_names.index("input_ids"), "input_ids", filled)


def encode(
    texts: DataFrame,
    vocab: DataFrame,
    ids: Sequence[str] = ORDER,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Token ids of the column ``text`` per row, cut on the right to ``max_tokens``.

    The end id is appended before the cut, so a cut row loses it. Labels repeat
    the ids. ``ids`` identify a row; the text is not kept. ``vocab`` is what
    ``fit_vocab`` returns. Both take what ``tokenise`` returns as well.

    The most frequent tokens of the vocabulary are sent to all tasks, which
    translate the texts in slices. A slice names each of its other tokens once;
    only these names are dealt out by token, joined with the rest of the
    vocabulary and brought back to the rows of their slice. A token has at most
    one row per slice, so none of them is a hot key. Without a rest of the
    vocabulary nothing moves.
    """
    reachable(texts.sparkSession)
    frequent = _frequent(vocab).orderBy("id").toArrow()  # of checked size
    # One id more, as the place -1 of a token that is not found must be one, too.
    known = frequent["token"].combine_chunks(), np.append(frequent["id"].to_numpy(), UNKNOWN_ID).astype(np.int32)
    last = int(known[1][-2]) if len(frequent) else FIRST_ID - 1
    fields = texts.select(*ids).schema.fields
    array = T.ArrayType(T.IntegerType())
    kinds = (array, T.BooleanType(), T.LongType(), T.ArrayType(T.StringType()))
    schema = T.StructType([*fields, *map(T.StructField, _LOOKED_UP, kinds)])
    sent = texts.sparkSession.sparkContext.broadcast(known)
    # The cut is made before the tokens are sent to Python.
    first = _lines(texts, *ids).withColumn("lines", F.substring_index("lines", "\n", max_tokens))
    with batches_of(texts.sparkSession, SLICE_BYTES):
        looked_up = stage(first.mapInArrow(_look_up(sent, tuple(ids)), schema), "token-ids")
    unknown = F.lit(UNKNOWN_ID)
    rare = vocab.filter(F.col("id") > last).select("token", "id")
    if rare.isEmpty():
        in_place = F.transform("input_ids", lambda x: F.when(x < 0, unknown).otherwise(x))
        done = looked_up.select(*ids, F.when(F.col("open"), in_place).otherwise(F.col("input_ids")).alias("input_ids"))
    else:
        asked = looked_up.select(F.col("block").alias("of"), F.posexplode("rest").alias("place", "token"))
        answers = asked.join(rare, "token", "left").select(
            "of", "place", F.coalesce(F.col("id").cast("int"), unknown).alias("id")
        )
        columns = [*ids, "input_ids"]
        open_ = looked_up.filter("open").select(*columns, "block")
        filled = (
            open_.groupBy("block").cogroup(answers.groupBy("of"))
            .applyInArrow(_fill, T.StructType([*fields, T.StructField("input_ids", array)]))
        )
        done = looked_up.filter("NOT open").select(columns).unionByName(filled)
    return (
        done.select(
            *ids,
            (F.size("input_ids") >= max_tokens).alias("was_truncated"),
            F.slice(F.array_append("input_ids", F.lit(END_ID)), 1, max_tokens).alias("input_ids"),
        )
        .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
        .withColumn("labels", F.col("input_ids"))
    )


def shard_count(n_rows: int, rows_per_shard: int = ROWS_PER_SHARD) -> int:
    return max(1, -(-n_rows // rows_per_shard))


def _in_shards(rows: DataFrame, n_shards: int, batch_rows: int) -> DataFrame:
    """Adds ``shard``, and ``batch`` inside the shard."""
    shard = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") % n_shards
    in_shard = Window.partitionBy("shard").orderBy("key")
    return rows.withColumn("shard", shard).withColumn(
        "batch", F.floor((F.row_number().over(in_shard) - 1) / batch_rows)
    )


def _in_one_set(rows: DataFrame, batch_rows: int) -> DataFrame:
    """Adds ``batch``, numbered over all rows in hash order: only the last one may be short."""
    numbered = number_rows(rows, [F.col("key")], "place")
    return numbered.withColumn("batch", F.floor(F.col("place") / batch_rows)).drop("place")


def padded_batches(
    encoded: DataFrame,
    n_shards: int | None = None,
    seed: int = SEED,
    ids: Sequence[str] = ORDER,
    batch_rows: int = BATCH_ROWS,
    multiple: int = PAD_MULTIPLE,
) -> DataFrame:
    """Group rows in batches and pad each to its longest row, rounded up to ``multiple``.

    Rows stand in order of a hash of their ids, and batches follow each other in this order:
    of all of them only the last one may be short, and they are the same under any
    partitioning. Only ids, hashes and lengths are sorted and numbered; a batch that a border
    of the sort cuts gets its width where its rows meet. Then each row joins its batch.

    With ``n_shards`` the rows are first dealt to shards by the same hash, and batches form
    inside a shard, every one small and equally full; the last batch of each may be short. Take
    ``n_shards`` from the number of training workers.
    """
    slim = encoded.select(*ids, shuffle_key(seed, ids).alias("key"), F.size("input_ids").alias("n"))
    if n_shards is None:
        place, batched = ["batch"], _in_one_set(slim, batch_rows)
    else:
        place, batched = ["shard", "batch"], _in_shards(slim, n_shards, batch_rows)
    longest = F.max("n").over(Window.partitionBy(*place))
    width = (F.ceil(longest / multiple) * multiple).cast("int")
    widths = batched.withColumn("width", width).select(*place, "width", *[F.col(c).alias(f"_{c}") for c in ids])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ids]
    missing = F.col("width") - F.size("input_ids")

    def padded(values: Column, filler: int) -> Column:
        return F.concat(values, F.array_repeat(F.lit(filler), missing))

    return (
        encoded.select(*ids, "input_ids")
        .join(widths, same)
        .select(
            *place,
            "width",
            *ids,
            padded(F.col("input_ids"), PAD_ID).alias("input_ids"),
            padded(
                F.array_repeat(F.lit(1), F.size("input_ids")), 0
            ).alias("attention_mask"),
            padded(F.col("input_ids"), LABEL_PAD).alias("labels"),
        )
    )
