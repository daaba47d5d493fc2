"""What the physical plans must and must not hold."""

import pytest

from codeprep.operators import ranking, tokens
from codeprep.plans import dataset, queries
from codeprep.plans import evaluation as evaluation_plan
from codeprep.plans.queries import QUERIES
from codeprep.sources import instructions
from codeprep.staging import stage

SMALL = "/root/testdata/sf0.001"
# Through Python, with Arrow: files, whose names and bytes Spark's readers do not take as they are,
# and tokens, which are looked up and counted in slices.
ARROW = {"code_file_scan", "encode_lengths", "padded_batches", "funnel_last_steps", "vocab_fit", "vocab_topk"}
PLANNED = sorted(set(QUERIES) - ARROW)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(spark, name, monkeypatch):
    """Neither in the plan of the result nor in those of the tables written on the way."""
    plans = []
    for module in (dataset, evaluation_plan, queries, instructions, ranking, tokens):
        if hasattr(module, "stage"):
            monkeypatch.setattr(module, "stage", lambda df, name: plans.append(plan(df)) or stage(df, name))
    text = plan(QUERIES[name](spark, SMALL)) + "".join(plans)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEval", "MapIn"):
        assert word not in text


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["dedup_first_wins"](spark, SMALL))
    final, _, rest = text.partition("Exchange hashpartitioning(key")
    assert "Final" in final and "row_number(), 1, Partial" in rest


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["fixed_broken"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    text = plan(QUERIES["source_lang_filter"](spark, SMALL))
    assert "html" not in text and "n_chars" not in text


def test_texts_are_encoded_where_they_are(spark, monkeypatch):
    """Encoding: no row per token, and without rare tokens no exchange at all."""
    plans = {}
    monkeypatch.setattr(tokens, "stage", lambda df, name: plans.update({name: plan(df)}) or stage(df, name))
    text = plan(QUERIES["encode_lengths"](spark, SMALL))
    assert "Generate" not in plans["token-ids"] and "Exchange" not in plans["token-ids"] + text
    monkeypatch.setattr(tokens, "MAX_BROADCAST_TOKENS", 100)
    text = plan(QUERIES["encode_lengths"](spark, SMALL))
    assert "Generate" not in plans["token-ids"] and "Exchange" not in plans["token-ids"]
    assert "CoGroups" in text and "BroadcastNestedLoopJoin" not in text


def test_only_ids_and_lengths_are_sorted_into_batches(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(ranking, "stage", lambda df, name: written.update({name: df.columns}) or stage(df, name))
    text = plan(QUERIES["padded_batches"](spark, SMALL))
    assert written["numbered"] == ["source_rank", "row_idx", "key", "n", "_at"]
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["chat_replay", "running_pass1"])
def test_both_levels_share_the_shuffle(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in plan(df)
