import hashlib
import random
import zlib

import numpy as np
import pytest

from codeprep.llm import periodic
from codeprep.llm.queries import op11_periodic_runs

DOCS = "doc_id bigint, text string, n_words string, runs int"


def brute_runs(words, least=12):
    """All (start, length, period), by trying every period at every place."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_digests(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None, sha(lines), sha(kept),
    )


def some_words(rng):
    """Few or many kinds of words, with planted repetitions, some nested."""
    kinds = rng.choice([1, 2, 3, 8, 50])
    words = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(90))]
    for _ in range(rng.randrange(4)):
        at, size = rng.randrange(len(words) + 1), rng.randint(1, 20)
        piece = [f"w{rng.randrange(kinds)}" for _ in range(size)]
        if rng.random() < 0.4:
            piece = piece * 3 + ["x"]
        words[at:at] = (piece * 5)[: rng.randint(size, 5 * size)]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = some_words(rng)
        for least in (12, 5, 7):
            got = [tuple(r) for r in periodic.find_runs(words, least).tolist()]
            assert got == brute_runs(words, least), (words, least)


def test_segments_hold_all_runs_and_no_rare_word():
    rng = random.Random(9)
    for _ in range(200):
        numbers = periodic.word_numbers(some_words(rng))
        segments = periodic.surviving_segments(numbers)
        for low, high in segments:
            _, counts = np.unique(numbers[low:high], return_counts=True)
            assert counts.min() >= 2 and high - low >= 12
        for start, length, _ in brute_runs(numbers.tolist()):
            assert any(low <= start and start + length <= high for low, high in segments)


def test_long_texts_of_every_shape():
    n = 60_000
    assert periodic.find_runs(["a"] * n).tolist() == [[0, n, 1]]
    assert periodic.find_runs(list("abc") * (n // 3)).tolist() == [[0, n, 3]]
    assert len(periodic.find_runs([f"w{i}" for i in range(n)])) == 0
    half = [f"w{i}" for i in range(n // 2)]
    assert periodic.find_runs(half + half).tolist() == [[0, n, n // 2]]
    # Each word twice and never in a run: one word goes after the other.
    peeled = [f"w{i // 2 if i % 2 else i // 2 + 2}" for i in range(n)]
    assert len(periodic.find_runs(peeled)) == 0
    rng = random.Random(1)
    assert len(periodic.find_runs([f"w{rng.randrange(40)}" for _ in range(n)])) == 0


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(some_words(rng)), "a", 0) for i in range(200)]
    rows += [(i, " ".join(f"u{j}" for j in range(rng.randrange(60))), "a", 0) for i in range(200, 300)]
    rows += [(None, "a " * 20, None, None), (400, None, None, None), (401, "", "", 1), (402, "é\t" * 13 + "\nb", "a", 1)]
    rows += [rows[0], rows[0], (402, "other", "a", 1)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted([brute_digests(r[0], r[1]) for r in rows], key=repr)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 15


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 6 + "c", "mine", 7)], DOCS)
    out = periodic.with_runs(docs)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    row = out.first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (13, [(0, 12, 2)], "a b c")
    assert periodic.with_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.with_runs(docs, least=4)
