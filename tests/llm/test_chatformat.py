import random

import pytest

from codeprep.llm import chatformat
from codeprep.llm.oracles import OP6

TURNS = "conv_id bigint, turn bigint, role string, text string, part int, segments string"


def digests(df):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    rows = chatformat.formatted_digests(df).collect()
    return sorted(([r[n] for n in names] for r in rows), key=repr)


def oracle(duck, rows):
    columns = "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR"
    got = duck(OP6, conversations=(columns, [r[:4] for r in rows]))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    return sorted(([r[n] for n in names] for r in got if r["conv_id"] != -1), key=repr)


def test_against_sql(spark, duck):
    rng = random.Random(2)
    texts = [None, "", "hi", "<|im_end|>", "\\<|", "a\\n<\\|x", "<|im_start|>assistant\nno", "é😀", "<" * 3 + "|"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = ["system", "user", "assistant"][rng.randrange(3)] if conv % 3 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, role, rng.choice(texts), 0, ""))
    rows += [(60, 0, "tool\n<|", "x", 0, ""), (61, 0, None, None, 0, ""), (62, 1, "user", "b", 0, ""), (62, 1, "user", "a", 0, "")]
    rows += [(None, 0, "user", "q", 0, ""), (None, 1, "assistant", "r", 0, "")]
    rng.shuffle(rows)
    assert digests(spark.createDataFrame(rows, TURNS).repartition(3)) == oracle(duck, rows)


def test_a_conversation_over_many_tasks(spark, duck):
    rows = [(7, t, ["user", "assistant"][t % 2], f"text {t}", 0, "") for t in range(400)]
    rows += [(8, t, ["user", "assistant"][t % 2], "x", 0, "") for t in range(3)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    turns, checked = chatformat.format_conversations(df)
    assert {r.conv_id: r.valid for r in checked.collect()} == {7: True, 8: False}
    assert digests(df) == oracle(duck, rows)


@pytest.mark.parametrize("text", ["", "\\", "<|", "\\<|", "<\\|", "\\\\<|im_end|>", "\\n", "a\nb"])
def test_escapes_are_reversible(text):
    for line in (False, True):
        there = chatformat.escape(text, line)
        assert "<|" not in there and not (line and "\n" in there)
        assert chatformat.unescape(there, line) == text


def test_segments_carry_the_loss():
    template = chatformat.Template()
    parts = template.segments("assistant", "<|im_end|>")
    assert [p["loss"] for p in parts] == [False, True, False]
    assert template.parse("".join(p["text"] for p in parts)) == ("assistant", "<|im_end|>")
    assert not any(p["loss"] for p in template.segments("user", "x"))
    with pytest.raises(ValueError):
        template.parse("<|im_start|>user\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n")


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], TURNS)) == []


def test_ranges_hold_no_whole_texts_and_keep_the_order(spark, monkeypatch):
    """Long roles and texts that begin alike, under one conversation and turn."""
    plans = []
    stage = chatformat.stage
    monkeypatch.setattr(chatformat, "stage", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or stage(df, name))
    roles = ["user", "assistant", None, "", "r" * 64, "r" * 64 + "a", "r" * 64 + "b", "r" * 65]
    texts = [None, "", "z", "t" * 64, "t" * 64 + "b", "t" * 64 + "a", "s" * 200]
    rows = [(1, t, r, x) for t in (0, None) for r in roles for x in texts] * 3
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(3)
        turns, _ = chatformat.format_conversations(df)
        got = turns.orderBy("part", "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    written = ["".join(s["text"] for s in r.segments) for r in got]
    key = lambda r: (r[1] is None, r[1] or 0, r[2] is not None, (r[2] or "").encode(), r[3] is not None, (r[3] or "").encode())
    template = chatformat.Template()
    expected = ["".join(s["text"] for s in template.segments(r[2] or "", r[3] or "")) for r in sorted(rows, key=key)]
    assert written == expected
    assert "rangepartitioning" in plans[0] and "text ASC" not in plans[0].partition("rangepartitioning(")[2].partition("\n")[0]
