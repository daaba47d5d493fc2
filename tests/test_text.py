"""Column functions on cases written out, and properties on awkward strings."""

import random

import pytest

from codeprep.functions import completions, text
from codeprep.operators import cleaning

PIECES = [
    "a", "Z", "é", "İ", "Σ", "😀", "中", "²", "_", "0", " ", "  ", "\t", "\n", "\r\n", "\r",
    "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "</s>", "<eos>",
    "<e</s>os>", "<|endoftext|>", "<EOS_", "TOKEN>", "<EOS_TOKEN>", "<", "```", "```python",
    "``", "def f(x):", "def  g (", "def\x1cf²(", "undef f(", "def (", "import os", "@deco",
    "class A:", "    return x", "#", '"', "python", "pythonic", "́",
]


def strings(n, seed, longest=12):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_whitespace_is_pythons():
    every = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(text.WHITESPACE) == every and len(text.WHITESPACE) == 29


def test_strip_is_pythons(apply):
    values = strings(4000, 1) + strings(200, 2, 80)
    assert apply(text.strip, values) == [v.strip() for v in values]


def test_cleaning_leaves_no_marker_and_is_done_after_one_pass_on_plain_text(apply):
    values = strings(3000, 3)
    once = apply(text.clean_text, values)
    assert all(c == c.strip() for c in once)
    # The last marker taken out can not come back; earlier ones may form anew.
    assert not any("<|eot_id|>" in c for c in once)
    plain = [c for c in once if "<" not in c]
    assert apply(text.clean_text, plain) == plain


@pytest.mark.parametrize(
    "value, cleaned",
    [
        ("a<EOS_TOKEN>b", "ab"),
        ("</s></s>x", "x"),
        ("<eos> x <|endoftext|>", "x"),
        ("<|eot_<eos>id|>", ""),
        ("<EOS_</s>TOKEN>", "<EOS_TOKEN>"),
        ("<EOS>", "<EOS>"),
        ("\u3000x\x1c", "x"),
    ],
)
def test_clean_cases(apply, value, cleaned):
    assert apply(text.clean_text, [value]) == [cleaned]


@pytest.mark.parametrize(
    "value, key",
    [
        ("  Sort A List ", "sort a list"),
        ("ΣΑΣ", "σας"),
        (" " * 99 + "ab", "a"),
        ("", ""),
        ("É" * 101, "é" * 100),
    ],
)
def test_dedup_key_cases(apply, value, key):
    assert apply(text.dedup_key, [value]) == [key]


def test_extracted_code_is_stripped_and_has_no_fence(apply):
    values = strings(3000, 4)
    for value, code in zip(values, apply(completions.extract_code, values)):
        assert code == code.strip()
        assert "```" not in code or value.count("```") == 0 or "def" in value
        # Without fence, function or line break, text stays as it is.
        if "```" not in value and "def" not in value and value.splitlines() in ([], [value]):
            assert code == value.strip()


@pytest.mark.parametrize(
    "answer, plain",
    [
        ("```python\nx = 1\n```", "x = 1"),
        (" ```\nx\n``` ", "x"),
        ("```js\nx\n```", "js\nx"),
        ("```pythonx```", "x"),
        ("a ```\nx\n```", "a ```\nx\n```"),
        ("```x", "```x"),
        ("```a```b```", "a```b"),
        ("``````", ""),
        ("", ""),
    ],
)
def test_unfence_cases(apply, answer, plain):
    assert apply(completions.unfence, [answer]) == [plain]


@pytest.mark.parametrize(
    "answer, markers, code_like",
    [
        ("def f(): return 1", 2, True),
        ("import os", 1, False),
        ("class A:\n    x", 2, True),
        ("def def def ", 1, False),
        ("Return x", 0, False),
        ("", 0, False),
    ],
)
def test_code_like_cases(apply, answer, markers, code_like):
    assert apply(completions.marker_count, [answer]) == [markers]
    assert apply(completions.is_code_like, [answer]) == [code_like]


def test_fixed_values():
    """What results must agree on, written out; the SQL counterparts import these."""
    assert text.END_TOKENS == ("<EOS_TOKEN>", "</s>", "<eos>", "<|endoftext|>", "<|eot_id|>")
    assert cleaning.CODE_KEYWORDS == (
        "def ", "import ", "class ", "return ", "print(", "for ", "if ",
    )
    assert completions.CODE_MARKERS == ("def ", "class ", "import ", "return ", "    ")
    assert (cleaning.MIN_OUTPUT, cleaning.MAX_OUTPUT, cleaning.MIN_INSTRUCTION) == (50, 4000, 10)


@pytest.mark.parametrize("keyword", ["def ", "import ", "class ", "return ", "print(", "for ", "if "])
def test_each_keyword_alone_makes_an_output_good(apply, keyword):
    filler = "x" * 60
    assert apply(cleaning.has_keyword, [filler + keyword, filler + keyword[:-1]]) == [True, False]


def test_end_markers(apply):
    assert apply(text.clean_text, ["<e</s>os>", "a</s>b", " 　x\x85", "<|eot_id|>"]) == [
        "", "ab", "x", "",
    ]


def test_dedup_key_width(apply):
    a, b = "x" * 100 + "1", "X" * 100 + "2"
    keys = apply(text.dedup_key, [a, b, "x" * 99 + "1", "😀" * 101, "😀" * 100])
    assert keys[0] == keys[1] != keys[2]
    assert keys[3] == keys[4]


def test_truncation_and_label(apply):
    short, long = "😀" * 3000, "😀" * 3001
    assert apply(text.truncate_code, [short, long]) == [short, short + "\n# ... (truncated)"]
    assert apply(text.short_label, ["a" * 60, "a" * 61]) == ["a" * 60, "a" * 60 + "..."]


@pytest.mark.parametrize(
    "answer, code",
    [
        ("plain text", "plain text"),
        ("x\n```python\nimport a\ndef f():\n  pass\nprint(1)\n```\ny", "def f():\n  pass"),
        ("```python\ndef f(): pass", "def f(): pass"),
        ("```\na = 1\n```\n```python b = 2\n  c\n```", "b = 2\n  c"),
        ("```python\nb = 2\n```", ""),
        ("```python\n x\n`````python\n y\n```", "x\n``"),
        ("```js\nlet a\n```", "js"),
        ("undef f(x):\n  1", "def f(x):\n  1"),
        ("def f():\r\n  1\r\n@deco\ndef g():", "def f():\n  1\n@deco"),
        ("😀 def f():\n  1\nélan\n_x\nZ", "def f():\n  1\nélan\n_x"),
        ("", ""),
    ],
)
def test_extract_cases(apply, answer, code):
    assert apply(completions.extract_code, [answer]) == [code]


def test_long_answer(apply):
    body = "    x = 1\n" * 200_000
    assert apply(completions.extract_code, ["def f():\n" + body + "done\n"]) == [
        ("def f():\n" + body).strip()
    ]
