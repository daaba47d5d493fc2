"""Removal of passages that an earlier document has, found through difference-cover anchors.

A window is ``WINDOW`` consecutive words. ``COVER`` is a difference cover modulo ``PERIOD``:
any two residues can both be shifted into it by one number below the period. Runs of
``ANCHOR`` words are hashed only where their place in the text is in the cover. Wherever two
documents share a window, there is one shift below the period for which both have an anchor,
and ``PERIOD + ANCHOR - 1 <= WINDOW``, so the anchor lies inside the window: no shared window is
missed, with a fifth of all places hashed.

Anchors whose hash occurs under two or more ids are extended: every window around them is
hashed, with 128 bits, and windows of one hash are compared by document. The smallest document
of each such window keeps it; in the others its words go. A document has one row per different
anchor or window, told by its first place; the others are found again by their hash. So work
follows the text, not the pairs of documents that share it, and a passage in a third of all
documents has one row in each. Rows with equal hashes stand together in sorted partitions and
are read as a stream, so no group is held in memory.

Whole copies need no anchors: of documents with one text all but the smallest id lose the words
of all their windows, which is every word if there are ``WINDOW`` of them. Only texts with
anchors in common are moved, once.

Null texts have no words. A null id comes after all ids; rows that share an id are not earlier
than each other, whether they repeat or not. Empty tables give an empty result. Further columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeprep.llm import arrays
from codeprep.staging import stage

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = 20
LAST = 2**63 - 1

_MARKS = "doc bigint, tag binary, pos int"


def _documents(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts under a number that orders them and a tag of 96 bits that tells rows of one id apart."""
    return documents.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("doc"),
        F.unhex(F.substring(F.md5(F.coalesce(F.col(text_col), F.lit(""))), 1, 24)).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def _anchors_of(words: arrays.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and word at which it begins, of every anchor of texts that have a window."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    hashes = arrays.grams(words.hashes[0], ANCHOR)
    owner = words.owners()[: len(hashes)]
    pos = np.arange(len(hashes)) - words.first[owner]
    count = words.counts[owner]
    at = np.flatnonzero(cover[pos % PERIOD] & (pos + ANCHOR <= count) & (count >= WINDOW))
    return owner[at], hashes[at], at


def _firsts(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the first use of each hash in each text."""
    if not len(owner):
        return np.zeros(0, np.int64)
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    # lexsort is stable, so the first of equals is the earliest.
    return np.sort(order[new])


def _like(owner: np.ndarray, hashes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which entries have the hash of a chosen entry of their text."""
    key = arrays.mix(hashes ^ arrays.mix(owner.astype(np.uint64) + np.uint64(1)))
    return np.isin(key, key[chosen])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and first place of every anchor."""
    for rows, data, offsets in arrays.slices(batches, "text"):
        words = arrays.find_words(data, offsets, arrays.NON_SPACE)
        owner, hashes, at = _anchors_of(words)
        first = _firsts(owner, hashes)
        owner = owner[first]
        yield _rows(rows, owner, hashes[first], at[first] - words.first[owner])


def _places(column: pa.Array, words: arrays.Words) -> np.ndarray:
    """Words at which the places in a list column lie."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    return flat + np.repeat(words.first[:-1], sizes)


def _rows(rows, owner, hashes, pos, more=()) -> pa.RecordBatch:
    take = pa.array(owner)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hashes.view(np.int64)),
            *[pa.array(h.view(np.int64)) for h in more],
            rows.column("doc").take(take),
            rows.column("tag").take(take),
            pa.array(pos.astype(np.int32)),
        ],
        names=["hash", *["check"] * len(more), "doc", "tag", "pos"],
    )


def _stream_groups(batches: Iterator[pa.RecordBatch], keys: list[str], later_only: bool) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by the keys and ``doc``: rows of groups of two or more documents.

    With ``later_only`` not those of the smallest document. Holds a batch, and of a group that
    goes on into the next batch the key, the smallest document and its rows.
    """
    out = pa.schema([("doc", pa.int64()), ("tag", pa.binary()), ("pos", pa.int32())])
    held: list[pa.RecordBatch] = []  # rows of the smallest document of the unfinished group
    last_key, last_doc, shared = None, None, False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key = [batch.column(k).to_numpy() for k in keys]
        doc = batch.column("doc").to_numpy()
        payload = pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("tag"), batch.column("pos")], schema=out
        )
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
        goes_on = last_key is not None and all(k[0] == v for k, v in zip(key, last_key))
        new[0] = not goes_on
        group = np.cumsum(new)  # 0 for rows of the group that goes on
        begins = np.flatnonzero(new)
        first_doc = np.empty(group[-1] + 1, np.int64)
        first_doc[0] = last_doc if goes_on else 0
        first_doc[1:] = doc[begins]
        later = doc != first_doc[group]
        has_later = np.zeros(group[-1] + 1, bool)
        has_later[group[later]] = True
        if goes_on:
            has_later[0] |= shared
        keep = later if later_only else has_later[group]
        if not later_only:
            if goes_on and has_later[0]:
                yield from held
                held = []
            if not goes_on or group[-1] > 0:
                held = []
            # The last group may get its second document in the next batch; none comes after null ids.
            if not has_later[-1] and first_doc[-1] != LAST:
                held.append(payload.filter(pa.array(group == group[-1])))
        chosen = np.flatnonzero(keep)
        if len(chosen):
            yield payload.take(pa.array(chosen))
        last_key, last_doc, shared = [k[-1] for k in key], first_doc[-1], bool(has_later[-1])


def _shared(rows: DataFrame, keys: list[str], later_only: bool) -> DataFrame:
    return (
        rows.repartition(F.col(keys[0]))
        .sortWithinPartitions(*keys, "doc")
        .mapInArrow(lambda batches: _stream_groups(batches, keys, later_only), _MARKS)
    )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes and first place of every window that holds an anchor like those in ``places``."""
    for rows, data, offsets in arrays.slices(batches, "text"):
        words = arrays.find_words(data, offsets, arrays.NON_SPACE, 2)
        owner, hashes, at = _anchors_of(words)
        if not len(at):
            continue
        anchors = at[_like(owner, hashes, np.searchsorted(at, _places(rows.column("places"), words)))]
        begins = words.first[words.owners()[anchors]]
        # An anchor is in the windows that begin up to WINDOW - ANCHOR words before it.
        change = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(change, np.maximum(anchors - (WINDOW - ANCHOR), begins), 1)
        np.add.at(change, anchors + 1, -1)
        at = np.flatnonzero((np.cumsum(change[:-1]) > 0) & (words.left() >= WINDOW))
        owner = words.owners()[at]
        one, two = (arrays.grams(h, WINDOW)[at] for h in words.hashes)
        first = _firsts(owner, one)
        yield _rows(rows, owner[first], one[first], (at - words.first[owner])[first], [two[first]])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its words, how many go, and the digest of those that stay, joined by a space.

    All windows go from a text with ``copy``, else those that begin at ``starts``. Texts with
    ``places`` and without ``starts`` are still to be decided and pass with their text.
    """
    for rows, data, offsets in arrays.slices(batches, "text"):
        copy, starts = rows.column("copy").to_pylist(), rows.column("starts")
        some = len(starts.flatten()) > 0
        words = arrays.find_words(data, offsets, arrays.NON_SPACE, int(some))
        flat = data.tobytes()
        removed, digests = [], []
        gone_from = np.zeros(0, np.int64)
        if some:
            # The windows like those that begin at ``starts``.
            whole = np.flatnonzero(words.left() >= WINDOW)
            hashes = arrays.grams(words.hashes[0], WINDOW)[whole]
            chosen = np.searchsorted(whole, _places(starts, words))
            gone_from = whole[_like(words.owners()[whole], hashes, chosen)]
        change = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(change, gone_from, 1)
        np.add.at(change, gone_from + WINDOW, -1)
        goes = np.cumsum(change[:-1]) > 0
        decided = [c or s.is_valid or not p.is_valid for c, s, p in zip(copy, starts, rows.column("places"))]
        for i in range(rows.num_rows):
            a, b = words.first[i], words.first[i + 1]
            if not decided[i]:
                removed.append(None)
                digests.append(None)
                continue
            gone = np.full(b - a, b - a >= WINDOW) if copy[i] else goes[a:b]
            n = int(gone.sum())
            removed.append(n)
            s, e = words.starts[a:b], words.ends[a:b]
            if n:
                s, e = s[~gone], e[~gone]
            kept = b" ".join([flat[x:y] for x, y in zip(s.tolist(), e.tolist())])
            digests.append(hashlib.sha256(kept).hexdigest())
        undecided = pa.array([None if d else i for i, d in enumerate(decided)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc"),
                rows.column("tag"),
                rows.column("text").take(undecided),
                rows.column("places").take(undecided),
                pa.array(words.counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=["doc", "tag", "text", "places", "n_words", "n_removed", "kept_sha256"],
        )


_KEPT = (
    "doc bigint, tag binary, text string, places array<int>, n_words bigint, n_removed bigint, "
    "kept_sha256 string"
)
_NO_PLACES = "cast(null as array<int>)"


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_removed, kept_sha256."""
    texts = _documents(documents, id_col, text_col)
    # All but the smallest id of each text.
    digest = texts.select("doc", "tag", F.md5("text").alias("digest"))
    smallest = digest.groupBy("digest").agg(F.min("doc").alias("smallest"), F.max("doc").alias("largest"))
    copies = (
        digest.join(smallest.filter("smallest < largest"), "digest")
        .filter("doc > smallest")
        .select("doc", "tag", F.lit(True).alias("copy"), F.expr(_NO_PLACES).alias("places"))
    )
    anchors = texts.mapInArrow(_anchors, "hash bigint, doc bigint, tag binary, pos int")
    places = (
        _shared(anchors, ["hash"], later_only=False)
        .groupBy("doc", "tag").agg(F.lit(False).alias("copy"), F.collect_set("pos").alias("places"))
    )
    marks = (
        stage(copies.unionByName(places), "marks")
        .groupBy("doc", "tag").agg(F.max("copy").alias("copy"), F.first("places", True).alias("places"))
    )
    # The one time that all texts move: they meet their marks. Most are done with that.
    met = stage(
        texts.join(marks, ["doc", "tag"], "left")
        .select("doc", "tag", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "places", F.expr(_NO_PLACES).alias("starts"))
        .mapInArrow(_kept, _KEPT),
        "marked-texts",
    )
    candidates = met.filter("places IS NOT NULL").select("doc", "tag", "text", "places")
    windows = candidates.mapInArrow(_windows, "hash bigint, check bigint, doc bigint, tag binary, pos int")
    starts = stage(
        _shared(windows, ["hash", "check"], later_only=True)
        .groupBy("doc", "tag").agg(F.collect_set("pos").alias("starts")),
        "repeats",
    )
    extended = (
        candidates.join(starts, ["doc", "tag"], "left")
        .select(
            "doc", "tag", "text", F.lit(False).alias("copy"), "places",
            F.coalesce("starts", F.expr("cast(array() as array<int>)")).alias("starts"),
        )
        .mapInArrow(_kept, _KEPT)
    )
    done = met.filter("places IS NULL").unionByName(extended)
    return done.select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias(id_col), "n_words", "n_removed", "kept_sha256"
    )
