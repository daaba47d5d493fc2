import random

import pytest

from codeprep.operators import cleaning
from codeprep.plans.dataset import prepared

SCHEMA = "source_rank int, row_idx long, instruction string, input string, output string"


def samples(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def good(n):
    return "return " + "😀" * (n - 7)


@pytest.mark.parametrize(
    "instruction, output, kept",
    [
        ("i" * 10, good(49), False),
        ("i" * 10, good(50), True),
        ("i" * 10, good(4000), True),
        ("i" * 10, good(4001), False),
        ("i" * 9, good(60), False),
        ("😀" * 10, good(60), True),
        ("i" * 10, "Return " + "x" * 60, False),
        ("i" * 10, "x" * 60 + "print(", True),
        ("i" * 9 + "</s>", good(60), False),
    ],
)
def test_quality_rules(spark, instruction, output, kept):
    rows = cleaning.clean(samples(spark, [(0, 0, instruction, "", output)]))
    assert cleaning.quality_filter(rows).count() == kept


def test_input_is_not_cleaned(spark):
    row = cleaning.clean(samples(spark, [(0, 0, " a</s> ", " </s> ", "b<eos>\n")])).first()
    assert (row.instruction, row.input, row.output) == ("a", " </s> ", "b")


def test_reject_reasons(spark):
    rows = samples(
        spark,
        [(0, 0, "x", "", "y"), (0, 1, "i" * 10, "", good(60)), (0, 2, "i" * 10, "", "x" * 60)],
    )
    got = {r.reason: r.n_rejected for r in cleaning.quality_rejects(rows).collect()}
    assert got == {"output_length": 1, "instruction_length": 1, "no_keyword": 2, "any_rule": 2}


def mixed_rows(n, seed=3):
    """A third of the rows share one key; sources arrive out of order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT instruction" if i % 3 == 0 else f"Instruction number {rng.randrange(n // 4)}"
        rows.append((rng.randrange(5), i, key + " " * rng.randrange(3), "", good(50 + i % 9)))
    rng.shuffle(rows)
    return rows


def first_per_key(rows):
    best = {}
    for row in rows:
        key = row[2].strip().lower()
        if key not in best or row[:2] < best[key]:
            best[key] = row[:2]
    return set(best.values())


@pytest.mark.parametrize("parts", [1, 17])
def test_first_in_source_order_survives(spark, parts):
    rows = mixed_rows(3000)
    kept = prepared(samples(spark, rows).repartition(parts)).collect()
    assert {(r.source_rank, r.row_idx) for r in kept} == first_per_key(rows)
    assert len(kept) == len(first_per_key(rows))


def test_funnel_and_groups(spark):
    rows = mixed_rows(900) + [(1, 5000, "short", "", "x"), (7, 1, "also short", "", "")]
    funnel = {r.source_rank: tuple(r)[1:] for r in cleaning.funnel(samples(spark, rows)).collect()}
    fine = rows[:900]
    survivors = first_per_key(fine)
    for rank in {r[0] for r in rows}:
        assert funnel[rank] == (
            sum(r[0] == rank for r in rows),
            sum(r[0] == rank for r in fine),
            sum(s[0] == rank for s in survivors),
        )
    groups = cleaning.copy_groups(cleaning.clean(samples(spark, fine))).collect()
    assert sum(g.n_groups for g in groups) == len(survivors)
    assert sum(g.n_dropped for g in groups) == len(fine) - len(survivors)
    assert max(g.group_size for g in groups) == 300


def test_cleaning_takes_a_stream(spark, tmp_path):
    rows = [(0, i, "instruction %d</s>" % i, "", good(49 + i)) for i in range(4)]
    samples(spark, rows).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    query = (
        cleaning.quality_filter(cleaning.clean(stream))
        .writeStream.format("memory")
        .queryName("cleaned_stream")
        .start()
    )
    query.processAllAvailable()
    query.stop()
    kept = spark.table("cleaned_stream").orderBy("row_idx").collect()
    assert [r.instruction for r in kept] == ["instruction 1", "instruction 2", "instruction 3"]
