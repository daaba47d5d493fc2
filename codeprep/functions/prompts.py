"""Prompt templates as string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codeprep.functions.text import strip

# Section headers and task sentences of the prompt format.
INSTRUCTION_HEADER = "### Instruction:\n"
INPUT_HEADER = "\n\n### Input:\n"
RESPONSE_HEADER = "\n\n### Response:\n"
COMPLETE_TASK = (
    "Complete the following Python function. "
    "Only return the completed function body, no explanation."
)
EXPLAIN_TASK = "Explain what the following Python code does, step by step."
REVIEW_TASK = (
    "Review the following Python code. Identify bugs, issues, and suggest improvements. "
    "Be specific and actionable."
)
FIX_TASK = "Fix the following Python code that produces this error: "
DOCSTRING_TASK = "Add a detailed docstring to the following Python function."
REVIEW_FIX_ERROR = "issues found during review"
END_OF_TEXT = "<|im_end|>"


def training_prompt(
    instruction: Column, input_: Column, output: Column, end_of_text: str = END_OF_TEXT
) -> Column:
    """One training example; the input section appears only when it has text."""
    context = strip(input_)
    return F.concat(
        F.lit(INSTRUCTION_HEADER),
        strip(instruction),
        F.when(context != "", F.concat(F.lit(INPUT_HEADER), context)).otherwise(F.lit("")),
        F.lit(RESPONSE_HEADER),
        strip(output),
        F.lit(end_of_text),
    )


def completion_prompt(problem: Column) -> Column:
    """Prompt of the evaluation run; the problem text is used as it is."""
    return F.concat(
        F.lit(INSTRUCTION_HEADER + COMPLETE_TASK + "\n\n"), problem, F.lit(RESPONSE_HEADER)
    )


def generate_prompt(instruction: Column) -> Column:
    return F.concat(F.lit(INSTRUCTION_HEADER), strip(instruction), F.lit(RESPONSE_HEADER))


def _over_code(task: Column, code: Column) -> Column:
    return F.concat(
        F.lit(INSTRUCTION_HEADER), task, F.lit(INPUT_HEADER), strip(code), F.lit(RESPONSE_HEADER)
    )


def explain_prompt(code: Column) -> Column:
    return _over_code(F.lit(EXPLAIN_TASK), code)


def review_prompt(code: Column) -> Column:
    return _over_code(F.lit(REVIEW_TASK), code)


def fix_prompt(code: Column, error: Column | str = REVIEW_FIX_ERROR) -> Column:
    error = F.lit(error) if isinstance(error, str) else error
    return _over_code(F.concat(F.lit(FIX_TASK), strip(error)), code)


def docstring_prompt(code: Column) -> Column:
    return _over_code(F.lit(DOCSTRING_TASK), code)
