import random
import re

import numpy as np
import pyarrow as pa
import pytest

from codeprep.llm import arrays

TEXTS = ["Hello, wörld 12 the", None, "", "the Hello a\tb the " * 20, "ünï", "x" * 300 + " the", " \n "]


@pytest.mark.parametrize("segment", [64, 1 << 20])
@pytest.mark.parametrize(
    ("alphabet", "pattern"),
    [
        (arrays.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
        (arrays.NON_SPACE, r"[^\x20\x09-\x0D]+"),
    ],
)
def test_words_and_their_hashes(monkeypatch, segment, alphabet, pattern):
    monkeypatch.setattr(arrays, "SEGMENT_BYTES", segment)
    data, offsets = arrays.utf8(pa.array(TEXTS))
    data = arrays.lower_ascii(data)
    words = arrays.find_words(data, offsets, alphabet, 2)
    found = [bytes(data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
    expected = [re.findall(pattern, (t or "").lower()) for t in TEXTS]
    assert found == [w for ws in expected for w in ws]
    assert words.counts.tolist() == [len(ws) for ws in expected]
    for hashes in words.hashes:
        by_word = {}
        for word, value in zip(found, hashes.tolist()):
            assert by_word.setdefault(word, value) == value
        assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("size", [1, 2, 5, 13, 20, 50])
def test_grams_depend_on_their_words_alone(size):
    rng = random.Random(size)
    words = np.array([rng.choice([3, 5, 8]) for _ in range(400)], np.uint64)
    grams = arrays.grams(words, size)
    assert len(grams) == len(words) - size + 1
    by_words = {}
    for i, value in enumerate(grams.tolist()):
        assert by_words.setdefault(tuple(words[i : i + size].tolist()), value) == value
    assert len(set(by_words.values())) == len(by_words)


def test_slices_hold_all_rows_and_long_texts_stand_alone():
    texts = ["a" * n for n in (10, 20, 5000, 3, 0, 7)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    got = [rows.column("t").to_pylist() for rows, _, _ in arrays.slices(iter([batch]), "t", 100)]
    assert [t for part in got for t in part] == texts
    assert [texts[2]] in got


def test_hash_spans_agrees_for_equal_spans():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    one, two, three = arrays.hash_spans(data, np.array([0, 3, 6]), np.array([3, 6, 9])).tolist()
    assert one == two != three
