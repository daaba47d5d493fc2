"""Periodic runs of words: stretches that repeat themselves with some period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
and a length of at least ``max(LEAST, 2 * q)`` that no neighbouring word extends keeping q.

Every word of a run occurs in it twice at least. So a word that occurs only once in a segment
of the text is in no run there and splits it; the parts are looked at again, as their words
may have become rare in them, until nothing changes. Most texts fall apart. A segment is known
to be stable without counting: a word is rare in it if its neighbours of the same kind stand
outside. After a split the largest part only looks at the words whose neighbours went with the
others, so a text of n words costs n log n at most.

What survives is scanned by lags, one octave [Q, 2Q) at a time. A run of such a period matches
itself over at least Q words (6 in the first octave), which hold an aligned block of Q / 2
words; only the blocks at multiples of their size are compared with the places at all the
lags. Blocks are told by exact names (equal names, equal words), doubled from octave to octave
as long as any block repeats. Matches are extended both ways by the same names.

Null texts have no words, nor have empty ones. Repeated rows get the same result each, rows
without an id too. Of stretches with the same bounds the smallest period counts; runs stand by
start, then period. Further columns are kept as they are; those named like a result
(``n_words``, ``runs``, ``collapsed``) are replaced. An empty table gives an empty result. A
text of any length is in one task, at some hundred bytes a word of its longest segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeprep.llm import arrays

# Fixed values of the definition: shortest run, and repetitions of its period.
LEAST = 12
TIMES = 2

# Comparisons of blocks held at once.
_CELLS = 1 << 22

_FIELDS = ("start", "length", "period")
_RUN_TYPE = pa.list_(pa.struct([(name, pa.int64()) for name in _FIELDS]))


def word_numbers(words: list) -> np.ndarray:
    """Equal words get equal numbers."""
    numbers: dict = {}
    return np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words))


def neighbours(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the same word before and after each place; -1 and the length if there is none."""
    size = len(numbers)
    order = np.argsort(numbers, kind="stable")
    same = numbers[order[1:]] == numbers[order[:-1]]
    before, after = np.full(size, -1), np.full(size, size)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def surviving_segments(numbers: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Segments of ``least`` words or more in which every word occurs twice or more."""
    before, after = neighbours(numbers)
    found, open_ = [], [(0, len(numbers), None)]
    while open_:
        low, high, doubtful = open_.pop()
        if high - low < least:
            continue
        at = np.arange(low, high) if doubtful is None else doubtful
        rare = at[(before[at] < low) & (after[at] >= high)]
        if not len(rare):
            found.append((low, high))
            continue
        edges = np.concatenate([[low - 1], rare, [high]])
        sizes = np.diff(edges) - 1
        largest = int(np.argmax(sizes))
        for i in np.flatnonzero(sizes >= least).tolist():
            a, b = int(edges[i]) + 1, int(edges[i + 1])
            if i == largest:
                # Only words with a neighbour in the other parts can have become rare.
                lost = np.concatenate([after[low:a], before[b:high]])
                open_.append((a, b, np.unique(lost[(lost >= a) & (lost < b)])))
            else:
                open_.append((a, b, None))
    return sorted(found)


def _block_names(numbers: np.ndarray) -> list[np.ndarray]:
    """Names of the blocks of 1, 2, 4, ... words at each place, while any block repeats."""
    names = [numbers]
    while (size := 1 << len(names)) <= len(numbers):
        last, half = names[-1], size >> 1
        pairs = last[: len(numbers) - size + 1] * (len(numbers) + 1) + last[half : len(numbers) - half + 1]
        kinds, name = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(pairs):
            break
        names.append(name)
    return names


def _extend(names: list[np.ndarray], at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 place around ``at`` up to which words match those ``lag`` further on."""
    size = len(names[0])
    low, high = at.copy(), at.copy()
    for level in reversed(range(len(names))):
        step, name = 1 << level, names[level]
        fits = high + lag + step <= size
        here = np.where(fits, high, 0)
        high += step * (fits & (name[here] == name[np.where(fits, high + lag, 0)]))
        fits = low >= step
        here = np.where(fits, low - step, 0)
        low -= step * (fits & (name[here] == name[np.where(fits, here + lag, 0)]))
    return low, high


def _octaves(levels: int, size: int) -> Iterator[tuple[int, int, int]]:
    """Level of the compared blocks, and first and last+1 lag."""
    for level in range(1, levels):
        low = 1 if level == 1 else 2 << level
        high = min(4 << level, size // TIMES + 1)
        if low < high:
            yield level, low, high


def _scan_lags(numbers: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, end, period) of the runs of a segment; some with a multiple of their period.

    Blocks inside a run whose period divides the lag are passed over: such a stretch is a run
    that was found with its smallest period.
    """
    size = len(numbers)
    names = _block_names(numbers)
    found = np.zeros((0, 3), np.int64)
    # Longest run found so far over each place.
    first, last, period = np.zeros(size, np.int64), np.zeros(size, np.int64), np.ones(size, np.int64)
    for level, low, high in _octaves(len(names), size):
        block, name = 1 << level, names[level]
        new = []
        together = max(1, _CELLS * block // size)
        for lag_low in range(low, high, together):
            lags = np.arange(lag_low, min(high, lag_low + together))
            places = np.arange(0, len(name) - lag_low, block)
            other = places[:, None] + lags
            ok = other < len(name)
            same = ok & (name[places][:, None] == name[np.where(ok, other, 0)])
            # Blocks that follow each other in one match lead to one stretch.
            p, q = np.nonzero(same & ~np.concatenate([np.zeros_like(same[:1]), same[:-1]]))
            at, lag = places[p], lags[q]
            known = (at + lag + block <= last[at]) & (lag % period[at] == 0)
            at, lag = at[~known], lag[~known]
            if not len(at):
                continue
            start, stop = _extend(names, at, lag)
            enough = stop + lag - start >= np.maximum(least, TIMES * lag)
            new.append(np.stack([start, stop + lag, lag], axis=1)[enough])
        if not new:
            continue
        rows = np.unique(np.concatenate(new), axis=0)
        found = np.concatenate([found, rows])
        # Of the same bounds the smallest period comes last.
        for start, stop, lag in rows[np.lexsort((-rows[:, 2], rows[:, 1] - rows[:, 0]))].tolist():
            here = start + np.flatnonzero(last[start:stop] - first[start:stop] <= stop - start)
            first[here], last[here], period[here] = start, stop, lag
    return found


def find_runs(words: list, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    numbers = word_numbers(words)
    parts = []
    for low, high in surviving_segments(numbers, least):
        _, inside = np.unique(numbers[low:high], return_inverse=True)
        parts.append(_scan_lags(inside, least) + np.array([low, low, 0]))
    if not parts:
        return np.zeros((0, 3), np.int64)
    found = np.concatenate(parts)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    bounds = found[:, :2]
    smallest = np.ones(len(found), bool)
    smallest[1:] = (bounds[1:] != bounds[:-1]).any(axis=1)
    found = found[smallest]
    found[:, 1] -= found[:, 0]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(words: list, runs: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def with_runs(documents: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Documents with ``n_words``, ``runs`` (start, length, period) and ``collapsed``.

    ``collapsed`` holds the words, joined by one space, that are left when each run keeps only
    its first period. ``least`` is 5 or more: shorter runs hold no block to compare.
    """
    if least < 5:
        raise ValueError(f"a run has 5 words at least, not {least}")
    new = ("n_words", "runs", "collapsed")
    others = documents.drop(*new)
    run_type = T.StructType([T.StructField(name, T.LongType()) for name in _FIELDS])
    schema = T.StructType(
        [
            *others.schema.fields,
            T.StructField("n_words", T.LongType(), False),
            T.StructField("runs", T.ArrayType(run_type), False),
            T.StructField("collapsed", T.StringType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.slices(batches, text_col):
            flat, bounds = data.tobytes(), offsets.tolist()
            sizes, runs, texts = [], [], []
            for low, high in zip(bounds, bounds[1:]):
                words = flat[low:high].split()
                found = find_runs(words, least)
                sizes.append(len(words))
                runs.append([dict(zip(_FIELDS, r)) for r in found.tolist()])
                texts.append(b" ".join(kept_words(words, found)))
            columns = [
                pa.array(sizes, pa.int64()),
                pa.array(runs, _RUN_TYPE),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=[*rows.schema.names, *new])

    return others.mapInArrow(run, schema)


def longest(runs: Column) -> Column:
    """The run of greatest length, of several the one of smallest start, then period; or null."""
    return F.array_min(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("least"), r["start"], r["period"], r.alias("run")))
    )["run"]


def listed(runs: Column) -> Column:
    """A line ``start,length,period`` per run."""

    def line(r: Column) -> Column:
        return F.concat(F.concat_ws(",", *[r[name].cast("string") for name in _FIELDS]), F.lit("\n"))

    return F.array_join(F.transform(runs, line), "")


def with_cycles(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and texts, of which a tenth, by a hash of the id, repeat a stretch of their own words.

    With h the crc32 of the id and g = floor(h / 10): where h ends in 0 and there are n > 0
    words, each word i >= a becomes word a + (i - a) % p, for a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those without an id, stay. Further
    columns go.
    """
    hashed = F.crc32(F.col(id_col).cast("string"))
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = documents.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.floor(hashed / 10).alias("g"),
        F.when(hashed % 10 == 0, words).alias("words"),
    )
    size = F.when(F.size("words") > 0, F.size("words"))
    placed = chosen.select("id", "text", "g", "words", size.alias("n"), (F.col("g") % size).alias("a"))
    period = F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1
    cycled = F.expr(
        "array_join(transform(sequence(0, n - 1), i -> "
        "element_at(words, cast(1 + if(i < a, i, a + (i - a) % p) as int))), ' ')"
    )
    return placed.withColumn("p", period).select(
        F.col("id").alias(id_col), F.when(F.col("n").isNotNull(), cycled).otherwise(F.col("text")).alias(text_col)
    )
