"""Byte-level BPE with the tokenizers library, each distinct piece of text encoded once.

A byte-level tokenizer first splits a text by a pattern: one space goes with the word after it,
and letters, digits, other signs and white space never share a token. Texts are cut at some of
these places, and the ids of a text are the ids of its pieces in turn. A worker keeps the ids
of the pieces it has met, in arrays of a bounded size, so frequent words are encoded once per
worker and not once per use. New pieces that are a space and a word are encoded many at a time,
joined; the bytes that each token stands for tell where a piece ends.

Pieces are compared by a hash of 64 bits; pieces of over ``LONGEST`` bytes are encoded each time.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from codeprep.llm import arrays

LONGEST = 48
MOST_KNOWN = 600_000
RUN = 200

_encoders: dict[str, Encoder] = {}


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PRINTABLE = np.zeros(256, bool)
_PRINTABLE[0x21:0x7F] = True
_SIGN = _PRINTABLE & ~_LETTER
_SIGN[0x30:0x3A] = False
# First bytes of letters of two bytes, whatever follows: Latin and Cyrillic without signs.
_LEAD = np.zeros(256, bool)
_LEAD[[0xC3, 0xC4, 0xC5, 0xD0]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: texts; single spaces and line ends between two characters that are no
    space; characters after such line ends; signs after letters.
    """
    n = len(data)
    begins = np.zeros(n + 1, bool)
    if n > 2:
        latin = np.zeros(n, bool)  # last byte of a letter U+00C0 to U+00FF
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        letter_before = _LETTER[data] | latin
        before = _PRINTABLE[data] | latin
        after = _PRINTABLE[data] | _LEAD[data]
        begins[1:n] |= letter_before[:-1] & _SIGN[data[1:]]
        line = np.zeros(n, bool)
        line[1:] = before[:-1] & (data[1:] == 0x0A)
        begins[1 : n - 1] |= (data[1:-1] == 0x20) & before[:-2] & after[2:]
        begins[:n] |= line
        begins[1:n] |= line[:-1] & after[1:]
    begins[offsets] = True
    begins[n] = False
    # A line end that opens a text has no character before it in the text.
    inner = offsets[:-1][offsets[:-1] < n - 1]
    opens = inner[data[inner] == 0x0A]
    unsafe = opens[~np.isin(opens + 1, offsets)] + 1
    begins[unsafe] = False
    return np.flatnonzero(begins)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = [token.content.encode() for token in special.values()]
        # A character of a byte-level token stands for one byte.
        self.token_bytes = np.array(
            [
                len(special[i].content.encode()) if i in special else len(self.tokenizer.id_to_token(i) or "")
                for i in range(size)
            ]
        )
        self.forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per worker and file."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16 if self.width == 2 else np.uint32)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.array(list(chain.from_iterable(lists)), self.ids.dtype), counts

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces of a space and letters, joined into longer texts."""
        texts = [b"".join(words[i : i + RUN]).decode() for i in range(0, len(words), RUN)]
        flat, _ = self._encode(texts)
        ends = np.cumsum([len(w) for w in words])
        upto = np.cumsum(self.token_bytes[flat])
        stop = np.searchsorted(upto, ends) + 1
        if len(words) and (stop[-1] != len(flat) or not np.array_equal(upto[stop - 1], ends)):
            return self._encode([w.decode() for w in words])
        return flat, np.diff(stop, prepend=0)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        # bytes.isalpha knows ASCII letters; é and the like go the slower way.
        plain = np.fromiter(
            (p[:1] == b" " and p[1:].isalpha() for p in pieces), bool, len(pieces)
        )
        accented = np.flatnonzero(~plain)
        odd = [i for i in accented.tolist() if not _is_word(pieces[i])]
        plain[:] = True
        plain[odd] = False
        words = [pieces[i] for i in np.flatnonzero(plain)]
        some, n_some = self._encode_words(words)
        rest, n_rest = self._encode([pieces[i].decode() for i in odd])
        hashes = np.concatenate([hashes[plain], hashes[odd]])
        flat, counts = np.concatenate([some, rest]), np.concatenate([n_some, n_rest])
        begin = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, flat])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, counts])[order]

    def encode(
        self, batch: pa.RecordBatch, id_col: str, text_col: str, end_id: int | None
    ) -> Iterator[tuple[int | None, np.ndarray]]:
        """``(document id, ids)`` per row."""
        for rows, data, offsets in arrays.slices(iter([batch]), text_col):
            ids, bounds = self.encode_texts(data, offsets, end_id)
            for doc_id, a, b in zip(rows.column(id_col).to_pylist(), bounds, bounds[1:]):
                yield doc_id, ids[a:b]

    def _with_special(self, flat: bytes, offsets: np.ndarray) -> np.ndarray:
        """Texts that hold a special token's string; the library looks for it before it splits."""
        found = set()
        for word in self.special:
            at = flat.find(word)
            while at >= 0:
                found.add(int(np.searchsorted(offsets, at, side="right")) - 1)
                at = flat.find(word, at + 1)
        return np.array(sorted(found), np.int64)

    def encode_texts(
        self, data: np.ndarray, offsets: np.ndarray, end_id: int | None
    ) -> tuple[np.ndarray, list[int]]:
        texts = len(offsets) - 1
        flat = data.tobytes()
        starts = cuts(data, offsets)
        whole = self._with_special(flat, offsets)
        for text in whole:
            inside = (starts > offsets[text]) & (starts < offsets[text + 1])
            starts = starts[~inside]
        ends = np.append(starts[1:], len(data))
        if not len(data):
            starts = ends = np.zeros(0, np.int64)
        first = np.searchsorted(starts, offsets)
        hashes = arrays.hash_spans(data, starts, ends)
        short = ends - starts <= LONGEST
        short[np.isin(starts, offsets[whole])] = False
        hashes[~short] = 0
        distinct, example, use = np.unique(hashes, return_index=True, return_inverse=True)
        new = short[example]
        new &= ~np.isin(distinct, self.known, assume_unique=True)
        if len(self.known) + int(new.sum()) > MOST_KNOWN:
            self.forget()
            new = short[example]
        at = example[new]
        if len(at):
            spans = zip(starts[at].tolist(), ends[at].tolist())
            self._learn(distinct[new], [flat[a:b] for a, b in spans])
        if not len(self.known):
            begin = count = np.zeros(len(hashes), np.int64)
        else:
            place = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
            begin, count = self.begin[place][use], self.count[place][use]
        pool = self.ids
        long = np.flatnonzero(~short)
        if len(long):
            more, counts = self._encode(
                [flat[a:b].decode() for a, b in zip(starts[long].tolist(), ends[long].tolist())]
            )
            begin[long] = len(pool) + np.cumsum(counts) - counts
            count[long] = counts
            pool = np.concatenate([pool, more])
        return _gather(pool, begin, count, first, texts, end_id)


def _is_word(piece: bytes) -> bool:
    """A space and letters up to U+00FF, so that a space after it begins another piece."""
    text = piece.decode()
    return text[:1] == " " and text[1:].isalpha() and text.isprintable() and max(text) <= "\u00ff"


def _gather(pool, begin, count, first, texts, end_id) -> tuple[np.ndarray, list[int]]:
    """The pieces' ids in order, with the end id after each text."""
    upto = np.concatenate([[0], np.cumsum(count)])
    total = int(upto[-1])
    source = np.repeat(begin - upto[:-1], count) + np.arange(total)
    ids = pool[source]
    bounds = upto[first]
    if end_id is None:
        return ids, bounds.tolist()
    out = np.empty(total + texts, pool.dtype)
    ends = bounds[1:] + np.arange(texts)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    out[ends] = end_id
    return out, [0, *(ends + 1).tolist()]
