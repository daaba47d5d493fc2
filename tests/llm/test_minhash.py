import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codeprep.llm import arrays, minhash
from codeprep.llm.oracles import OP12

DOCS = "doc_id bigint, text string, n int, node string"


def brute(rows, size=4, percent=80):
    """Sets of joined words, every pair tried, labels passed on until they settle."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = [x for x in (text or "").translate(lower).replace("\n", " ").replace("\t", " ").split(" ") if x]
        k = min(size, len(w))
        sets.append({" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    label = list(range(len(rows)))

    def linked(a, b):
        return a and b and 100 * len(a & b) >= percent * len(a | b)

    near = [[j for j in range(len(rows)) if j != i and linked(sets[i], sets[j])] for i in range(len(rows))]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            low = min([label[i], *[label[j] for j in near[i]]])
            changed |= low != label[i]
            label[i] = low
    first = {}
    for (i, _), root in zip(rows, label):
        if i is not None:
            first[root] = min(i, first.get(root, i))
    out = []
    for (i, _), root, s in zip(rows, label, sets):
        component = first.get(root) if s else i
        out.append((i, len(s), component, i == component))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, how = rng.randrange(len(words)), rng.random()
        if how < 0.6:
            words[at] = f"n{rng.randrange(10**6)}"
        elif how < 0.8 and len(words) > 5:
            del words[at]
        else:
            words.insert(at, f"n{rng.randrange(10**6)}")
    return words


def group(rng, members, length, edits, own):
    base = [f"{own}{i}" for i in range(length)]
    return [" ".join(edited(rng, base, rng.randint(0, edits))) for _ in range(members)]


@pytest.mark.parametrize("bucket", [1, 4, 32])
def test_near_copies_against_brute_force(spark, bucket):
    """Groups at all similarities, with buckets of any size handled either way."""
    rng = random.Random(bucket)
    texts = group(rng, 60, 60, 6, "a") + group(rng, 25, 30, 3, "b") + group(rng, 20, 200, 25, "c")
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(40)]
    texts += ["", " \n", None, "One two THREE", "one two three", "one two three four", "é É", "é é"]
    rows = list(enumerate(texts)) + [(1000 + i, texts[i]) for i in range(0, 60, 7)]
    rows += [(None, texts[0]), (None, texts[0]), (None, "only here without an id"), (None, None), (3, texts[70]), (3, texts[3])]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], DOCS).repartition(3)
    got = minhash.near_copies(docs, bucket=bucket)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found(got) == brute(rows)


def test_against_sql(spark, duck):
    rng = random.Random(8)
    texts = group(rng, 40, 40, 4, "a") + group(rng, 30, 12, 1, "b") + ["", None, "a b", "A b", "a b c d e"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = found(minhash.near_copies(spark.createDataFrame([(*r, 0, "") for r in rows], DOCS)))
    expected = duck(OP12, documents=("doc_id BIGINT, text VARCHAR", rows))
    names = ("doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted((tuple(r[n] for n in names) for r in expected), key=repr) == brute(rows)


def test_other_shingles_and_similarities(spark):
    rng = random.Random(2)
    rows = list(enumerate(group(rng, 60, 50, 8, "a")))
    docs = spark.createDataFrame([(i, t, 0, "") for i, t in rows], DOCS)
    assert found(minhash.near_copies(docs, size=2, percent=90, bucket=3)) == brute(rows, 2, 90)


def test_coordinates_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for shared, own in ((180, 20), (100, 50), (900, 100)):
        rates = []
        for _ in range(40):
            pick = rng.choice(pool, shared + 2 * own, replace=False)
            a, b = np.sort(pick[: shared + own]), np.sort(np.concatenate([pick[:shared], pick[shared + own :]]))
            signs = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 128)
            rates.append((signs[0] == signs[1]).mean())
        similarity = shared / (shared + 2 * own)
        assert abs(np.mean(rates) - similarity) < 0.02
        # No wider than for permutations of their own.
        assert np.std(rates) < 1.35 * np.sqrt(similarity * (1 - similarity) / 128)


def test_order_is_a_permutation_and_shifts_are_circular():
    places = np.concatenate([np.arange(1 << 16), 2**32 - 1 - np.arange(1 << 16)]).astype(np.uint32)
    ordered, spare = places.copy(), np.empty_like(places)
    minhash._order(ordered, spare)
    assert len(np.unique(ordered)) == len(places)
    values = np.arange(1, 50, dtype=np.uint64)
    signs = minhash.signatures(values, np.array([0, 49]), 3)
    at = (arrays.mix(values + minhash._PLACES) >> np.uint64(32)).astype(np.uint32)
    for k in range(3):
        shifted = at - np.uint32(k)
        minhash._order(shifted, np.empty_like(shifted))
        assert signs[0, k] == shifted.min()


def test_names_tell_sets_apart_whatever_the_batch():
    texts = ["a b c d e f", "a b c d", "x", "", "a b c d e f", "e f", "x x x x x x"]
    data, offsets = arrays.utf8(pa.array(texts))
    values, bounds = minhash.shingle_sets(data, offsets)
    assert np.diff(bounds).tolist() == [3, 1, 1, 0, 3, 1, 1]
    some = np.flatnonzero(np.diff(bounds))
    names = minhash.set_names(values, np.concatenate([bounds[some], bounds[-1:]]))
    assert names[0] == names[3] and len(set(names)) == 5
    for text, name in zip([t for t in texts if t], names):
        alone, ends = minhash.shingle_sets(*arrays.utf8(pa.array([text])))
        assert minhash.set_names(alone, ends) == [name]


def test_a_large_group_makes_no_pairs_of_all(spark, monkeypatch):
    """Members that are no links of the pivot's component are ruled out without a comparison."""
    rng = random.Random(11)
    rows = list(enumerate(group(rng, 300, 150, 9, "a")))
    compared = []
    compare = minhash._Sets.compare

    def counted(self, pairs):
        out = compare(self, pairs)
        compared.append(out.count())
        return out

    monkeypatch.setattr(minhash._Sets, "compare", counted)
    docs = spark.createDataFrame([(i, t, 0, "") for i, t in rows], DOCS)
    assert found(minhash.near_copies(docs)) == brute(rows)
    assert sum(compared) < 10 * len(rows)


def test_long_texts_and_empty_tables(spark):
    words = [f"w{i}" for i in range(120_000)]
    rows = [(5, " ".join(words), 0, ""), (4, " ".join(words[100:] + ["x"]), 0, ""), (9, "y" * 1_000_000, 0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    assert found(minhash.near_copies(docs)) == sorted(
        [(5, 119_997, 4, False), (4, 119_898, 4, True), (9, 1, 9, True)], key=repr
    )
    empty = minhash.near_copies(docs.filter(F.lit(False)))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.count() == 0
