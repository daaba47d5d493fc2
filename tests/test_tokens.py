import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codeprep.operators import tokens
from codeprep.workers import BATCH_BYTES

TOKEN = re.compile(r"\w+|[^\w\s]")


def corpus(n=60, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é_1", "中文", "😀", "==", "(", "x" * 80]
    texts = [" ".join(rng.choice(words[: rng.randrange(1, 46)]) for _ in range(rng.randrange(30)))
             for _ in range(n)]
    return texts + ["", " \n", "hot " * 200]


def table(spark, texts, parts=3):
    rows = [(i % 2, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_rank int, row_idx long, text string").repartition(parts)


def py_vocab(texts, size=None):
    counts = Counter(t for text in texts for t in TOKEN.findall(text))
    order = sorted(counts, key=lambda t: (-counts[t], t.encode()))
    return {t: (counts[t], i + 3) for i, t in enumerate(order[:size])}


def py_encode(text, vocab, limit):
    return ([vocab[t][1] if t in vocab else 1 for t in TOKEN.findall(text)] + [2])[:limit]


@pytest.mark.parametrize("size", [None, 1, 10, 1000])
def test_vocab(spark, size):
    texts = corpus()
    got = tokens.fit_vocab(table(spark, texts), size).collect()
    assert {r.token: (r.n, r.id) for r in got} == py_vocab(texts, size)
    assert len(got) == len(py_vocab(texts, size))


@pytest.mark.parametrize("size, capacity", [(1, 1), (5, 6), (5, 12), (10, 20), (40, 44), (30, 1000)])
def test_bounded_vocab(spark, monkeypatch, size, capacity):
    """Whatever the summaries of the tasks hold, the vocabulary is exact."""
    monkeypatch.setattr(tokens, "SLICE_BYTES", 300)
    rng = random.Random(size * capacity)
    # Frequent words, and many that occur once.
    texts = [" ".join([f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(40)] + [f"once{i}" , "x"]) for i in range(120)]
    got = tokens.fit_vocab(table(spark, texts + ["", None], 5), size, capacity).collect()
    assert {r.token: (r.n, r.id) for r in got} == py_vocab(texts, size)


def test_bounded_vocab_shuffles_no_more_with_more_tokens(spark, monkeypatch):
    written = {}
    stage = tokens.stage

    def kept(df, name):
        written[name] = stage(df, name)
        return written[name]

    monkeypatch.setattr(tokens, "stage", kept)
    texts = [" ".join(["the"] * 30 + ["of"] * 20 + [f"once{i}_{j}" for j in range(50)]) for i in range(100)]
    got = tokens.fit_vocab(table(spark, texts, 3), 2, 20).collect()
    assert [(r.token, r.n, r.id) for r in sorted(got, key=lambda r: r.id)] == [("the", 3000, 3), ("of", 2000, 4)]
    assert written["token-summary"].count() <= 3 * 21
    assert written["likely-tokens"].count() <= 20 and written["token-counts"].count() <= 20


@pytest.mark.parametrize("size", [None, 10])
@pytest.mark.parametrize("most, chars", [(500_000, 32_000_000), (5, 1000), (500_000, 50), (5, 10)])
@pytest.mark.parametrize("limit", [4096, 10])
def test_encode(spark, monkeypatch, size, most, chars, limit):
    monkeypatch.setattr(tokens, "MAX_BROADCAST_TOKENS", most)
    monkeypatch.setattr(tokens, "MAX_BROADCAST_BYTES", chars)
    texts = corpus()
    vocab = tokens.fit_vocab(table(spark, texts), size)
    rows = tokens.encode(table(spark, texts), vocab, max_tokens=limit).collect()
    assert len(rows) == len(texts)
    expected = py_vocab(texts, size)
    for r in rows:
        text = texts[r.row_idx]
        assert r.input_ids == py_encode(text, expected, limit)
        assert r.labels == r.input_ids and r.attention_mask == [1] * len(r.input_ids)
        assert r.was_truncated == (len(TOKEN.findall(text)) + 1 > limit)


@pytest.mark.parametrize("n_shards", [1, 3])
def test_batches(spark, n_shards):
    texts = corpus()
    vocab = tokens.fit_vocab(table(spark, texts))

    def build(parts):
        encoded = tokens.encode(table(spark, texts, parts), vocab)
        return sorted(map(tuple, tokens.padded_batches(encoded, n_shards).collect()))

    rows = build(1)
    assert rows == build(17)
    assert sorted(r[4] for r in rows) == list(range(len(texts)))
    batches = {}
    for shard, batch, width, _, i, ids, mask, labels in rows:
        real = py_encode(texts[i], py_vocab(texts), 4096)
        pad = width - len(real)
        assert ids == real + [0] * pad
        assert mask == [1] * len(real) + [0] * pad
        assert labels == real + [-100] * pad
        batches.setdefault((shard, batch), []).append((len(real), width))
    for members in batches.values():
        assert {w for _, w in members} == {-(-max(n for n, _ in members) // 8) * 8}
    for shard in {s for s, _ in batches}:
        sizes = [len(batches[key]) for key in sorted(batches) if key[0] == shard]
        assert sizes[:-1] == [4] * (len(sizes) - 1) and 1 <= sizes[-1] <= 4


@pytest.mark.parametrize("batch_rows", [1, 4, 7, 1000])
def test_one_short_batch_in_all(spark, batch_rows):
    texts = corpus()
    encoded = tokens.encode(table(spark, texts), tokens.fit_vocab(table(spark, texts)))

    def build(parts):
        batches = tokens.padded_batches(encoded.repartition(parts), batch_rows=batch_rows)
        return sorted(map(tuple, batches.collect()))

    rows = build(1)
    assert rows == build(17)
    # In the order of a hash of the ids, over all rows.
    order = sorted(range(len(texts)), key=lambda i: hashlib.md5(f"42:{i % 2}:{i}".encode()).hexdigest())
    vocab = py_vocab(texts)
    expected = []
    for n in range(0, len(order), batch_rows):
        members = {i: py_encode(texts[i], vocab, 4096) for i in order[n : n + batch_rows]}
        width = -(-max(map(len, members.values())) // 8) * 8
        expected += [(n // batch_rows, width, i % 2, i, ids + [0] * (width - len(ids))) for i, ids in members.items()]
    assert [r[:5] for r in rows] == sorted(expected)
    assert all(r[5] == [int(x != 0) for x in r[4]] and r[6] == [x or -100 for x in r[4]] for r in rows)


def test_a_slice_names_a_rare_token_once(spark, monkeypatch):
    """What is dealt out by token is bounded by the slices, not by the texts."""
    monkeypatch.setattr(tokens, "MAX_BROADCAST_TOKENS", 1)
    written = {}
    stage = tokens.stage

    def kept(df, name):
        written[name] = stage(df, name)
        return written[name]

    monkeypatch.setattr(tokens, "stage", kept)
    texts = corpus() * 3
    vocab = tokens.fit_vocab(table(spark, texts))
    rows = tokens.encode(table(spark, texts, 2), vocab).collect()
    expected = py_vocab(texts)
    assert all(r.input_ids == py_encode(texts[r.row_idx], expected, 4096) for r in rows)
    named = written["token-ids"].select(F.explode("rest")).count()
    assert 0 < named <= 2 * len(expected)


@pytest.mark.parametrize("most", [500_000, 3])
def test_slices_long_texts_and_nulls(spark, monkeypatch, most):
    monkeypatch.setattr(tokens, "MAX_BROADCAST_TOKENS", most)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 40)
    texts = ["", "a b c " * 30, "x", "", "é" * 100 + " y", "b c d e f", "\x01 a"]
    rows = [(0, i, t) for i, t in enumerate(texts)] + [(None, None, "a zz"), (1, None, None)]
    df = spark.createDataFrame(rows, "source_rank int, row_idx long, text string").coalesce(1)
    got = tokens.encode(df, tokens.fit_vocab(df)).collect()
    vocab = py_vocab([t or "" for _, _, t in rows])
    assert {(r.source_rank, r.row_idx): r.input_ids for r in got} == {
        (a, b): py_encode(t or "", vocab, 4096) for a, b, t in rows
    }
    assert len(got) == len(rows)
    nothing = tokens.encode(df, tokens.fit_vocab(df.limit(0))).collect()
    assert all(r.input_ids == [1] * (len(r.input_ids) - 1) + [2] for r in nothing)


@pytest.mark.parametrize("size", [None, 1000])
def test_counting_gets_small_batches(spark, monkeypatch, size):
    """Whatever the number of texts, a worker holds about a slice of them."""
    before = spark.conf.get(BATCH_BYTES)

    def bytes_got(batches):
        for n, batch in enumerate(batches):
            yield pa.RecordBatch.from_arrays([pa.array([f"{n} {batch.nbytes}"]), pa.array([1])], names=["token", "n"])

    monkeypatch.setattr(tokens, "SLICE_BYTES", 4000)
    monkeypatch.setattr(tokens, "_slice_counts", bytes_got)
    monkeypatch.setattr(tokens, "_summaries", lambda capacity: bytes_got)
    texts = [f"w{i} " * 100 for i in range(100)]
    got = [int(r.token.split()[1]) for r in tokens.fit_vocab(table(spark, texts, 1), size).collect()]
    assert sum(got) > sum(map(len, texts)) and max(got) < 5000
    assert spark.conf.get(BATCH_BYTES) == before


def test_encoding_gets_small_batches_of_cut_texts(spark, monkeypatch):
    written = {}
    stage = tokens.stage

    def kept(df, name):
        written[name] = stage(df, name)
        return written[name]

    monkeypatch.setattr(tokens, "stage", kept)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 4000)
    before = spark.conf.get(BATCH_BYTES)
    # 10 tokens each; of the long ones, which would fill a batch each, only so many are sent.
    texts = ["hot " * 2000] * 20 + [f"w{i}x " * 10 for i in range(300)]
    vocab = tokens.fit_vocab(table(spark, texts, 1))
    rows = tokens.encode(table(spark, texts, 1), vocab, max_tokens=10).collect()
    expected = py_vocab(texts)
    assert {r.row_idx: r.input_ids for r in rows} == {i: py_encode(t, expected, 10) for i, t in enumerate(texts)}
    sizes = [r["count"] for r in written["token-ids"].groupBy("block").count().collect()]
    assert len(sizes) < 10 and max(sizes) * 40 < 5000
    assert spark.conf.get(BATCH_BYTES) == before


def test_only_rare_tokens_move(spark, monkeypatch):
    """No table has a row per token: frequent tokens stay with their text."""
    written = {}
    stage = tokens.stage

    def counted(df, name):
        out = stage(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(tokens, "stage", counted)
    texts = corpus()
    vocab = tokens.fit_vocab(table(spark, texts))
    tokens.encode(table(spark, texts), vocab).collect()
    assert written["token-ids"] == len(texts)
    assert sum(written.values()) < sum(len(TOKEN.findall(t)) for t in texts)


def test_shard_count():
    assert [tokens.shard_count(n) for n in (0, 1, 10_000, 10_001)] == [1, 1, 1, 2]


def test_token_pattern_covers_visible_text(apply):
    values = ["áb", "x\x85y\xa0z", "a_b-c", "²½", "​"]
    assert apply(tokens.tokens, values) == [re.findall(r"\w+|[^\w\s]", v) for v in values]


def test_no_token_is_lost(spark):
    texts = corpus()
    counted = tokens.count_tokens(table(spark, texts)).agg(F.sum("n")).first()[0]
    assert counted == sum(len(TOKEN.findall(t)) for t in texts)
