"""The replay against a state machine that reads one turn after the other."""

import random

import pytest

from codeprep.operators import chatlog

SCHEMA = "conv_id long, turn long, role string, text string"


def simulate(rows):
    """Expected (conv_id, turn, command, turn_count, last_response) and saves."""
    states, saved = [], []
    for conv in sorted({r[0] for r in rows}):
        said = {r[1]: r for r in rows if r[0] == conv}
        count, last = 0, ""
        for turn in sorted(said):
            _, _, role, text = said[turn]
            if role != "user":
                continue
            word = text.strip().lower()
            if not word:
                continue
            if word in {"/quit", "/exit", "/q"}:
                states.append((conv, turn, "quit", count, last))
                break
            if word == "/clear":
                count, command = 0, "clear"
            elif word == "/save":
                command = "save"
                saved.append((conv, turn, last or None))
            else:
                command = "ask"
                answer = said.get(turn + 1)
                if answer and answer[2] == "assistant":
                    count, last = count + 1, answer[3]
            states.append((conv, turn, command, count, last))
    return states, saved


def logs(n_convs, seed, hot=0):
    rng = random.Random(seed)
    users = ["hello", "write code", " /CLEAR ", "/save", "　", "/Save", "more", "/clear x"]
    rows = []
    for conv in range(n_convs):
        length = hot if conv == 0 and hot else rng.randrange(1, 25)
        for turn in range(length):
            role = rng.choice(["user", "assistant", "assistant", "system"])
            if turn % 2 == 0 and rng.random() < 0.8:
                role = "user"
            text = rng.choice(users) if role == "user" else f"answer {conv}-{turn}"
            if role == "user" and rng.random() < 0.02 and conv:
                text = rng.choice(["/quit", "/EXIT", " /q\n"])
            if role == "assistant" and rng.random() < 0.05:
                text = ""
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("block_turns", [4096, 7, 1])
def test_replay(spark, monkeypatch, block_turns):
    monkeypatch.setattr(chatlog, "BLOCK_TURNS", block_turns)
    rows = logs(40, 11, hot=400)
    states, saved = simulate(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    replayed = chatlog.replay(table)
    assert sorted(map(tuple, replayed.collect())) == sorted(states)
    got = [(r.conv_id, r.turn, r.content) for r in chatlog.saves(replayed).collect()]
    assert sorted(got, key=lambda r: r[:2]) == sorted(saved, key=lambda r: r[:2])


def test_commands(apply):
    words = ["/QUIT", " /exit", "/q", "/clear\n", "/Save", "", "\x85", "/quit now", "hi"]
    assert apply(chatlog.classify, words) == [
        "quit", "quit", "quit", "clear", "save", "blank", "blank", "ask", "ask",
    ]


def test_save_after_clear_and_before_any_answer(spark):
    rows = [
        (1, 0, "user", "/save"), (1, 1, "user", "ask"), (1, 2, "assistant", "A"),
        (1, 3, "user", "/clear"), (1, 4, "user", "/save"), (1, 5, "user", "/quit"),
        (1, 6, "user", "/save"),
    ]
    got = chatlog.saves(chatlog.replay(spark.createDataFrame(rows, SCHEMA))).orderBy("turn").collect()
    assert [(r.turn, r.outcome, r.file_name, r.content) for r in got] == [
        (0, "nothing to save", None, None), (4, "saved", "chat_1_4.py", "A"),
    ]
