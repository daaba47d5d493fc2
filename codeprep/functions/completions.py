"""Turning a model's answer into code."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from codeprep.functions.text import strip

FENCE = "```"
PYTHON_FENCE = "```python"

# Substrings that hint at code; two of them make an answer code-like.
CODE_MARKERS = ("def ", "class ", "import ", "return ", "    ")
MIN_MARKERS = 2

# A word character is a letter, a number of any kind, or an underscore. Java's
# own \w under (?U) also takes combining marks and joiners, and leaves out
# numbers such as U+00B2.
_WORD = r"[\p{L}\p{N}_]"
# (?U)\s covers 25 of the 29 whitespace code points; the separators are named.
_SPACE = r"[\s\x1c-\x1f]"
_FROM_FUNCTION = rf"(?sU)(def{_SPACE}+{_WORD}+{_SPACE}*\(.*)"

_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# Line 0 and every later line up to one that starts with an ASCII letter.
_TOP_BLOCK = r"(?s)\A(.*?)(?:\n[a-zA-Z].*)?\z"


def fenced_part(answer: Column) -> Column:
    """Text inside the first Python fence, else inside the first plain fence.

    A fence that is never closed runs to the end of the text.
    """
    after_python = F.split_part(answer, F.lit(PYTHON_FENCE), F.lit(2))
    after_plain = F.split_part(answer, F.lit(FENCE), F.lit(2))
    return (
        F.when(answer.contains(PYTHON_FENCE), F.split_part(after_python, F.lit(FENCE), F.lit(1)))
        .when(answer.contains(FENCE), after_plain)
        .otherwise(answer)
    )


def from_first_function(code: Column) -> Column:
    """Drop what comes before the first function header; no header, no change."""
    tail = F.regexp_extract(code, _FROM_FUNCTION, 1)
    return F.when(tail == "", code).otherwise(tail)


def first_top_level_block(code: Column) -> Column:
    """Keep line 0 and what follows until a later line starts at column 0 with a letter."""
    lines = F.regexp_replace(code, _LINE_BREAK, "\n")
    return strip(F.regexp_extract(lines, _TOP_BLOCK, 1))


def extract_code(answer: Column) -> Column:
    return first_top_level_block(from_first_function(fenced_part(answer)))


def assemble_solution(prompt: Column, code: Column) -> Column:
    return F.concat(prompt, F.lit("\n"), code)


def unfence(answer: Column) -> Column:
    """If the stripped answer is one fenced block, its stripped body; else the stripped answer.

    A fence tagged with another language keeps the tag as the first body line.
    """
    text = strip(answer)
    tag = F.when(text.startswith(PYTHON_FENCE), F.lit(len(PYTHON_FENCE))).otherwise(
        F.lit(len(FENCE))
    )
    is_block = (
        text.startswith(FENCE) & text.endswith(FENCE) & (F.length(text) >= 2 * len(FENCE))
    )
    body = F.substr(text, tag + F.lit(1), F.length(text) - tag - F.lit(len(FENCE)))
    return F.when(is_block, strip(body)).otherwise(text)


def marker_count(answer: Column) -> Column:
    return reduce(add, [answer.contains(marker).cast("int") for marker in CODE_MARKERS])


def is_code_like(answer: Column) -> Column:
    return marker_count(answer) >= MIN_MARKERS
