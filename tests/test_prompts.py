from pyspark.sql import functions as F

from codeprep.functions import prompts


def one(spark, column):
    return spark.range(1).select(column.alias("p")).first().p


def test_training_prompt(spark):
    def prompt(input_):
        return one(spark, prompts.training_prompt(F.lit(" do "), F.lit(input_), F.lit("out\n")))

    head, tail = "### Instruction:\ndo", "\n\n### Response:\nout<|im_end|>"
    assert prompt("　") == head + tail
    assert prompt(" x ") == head + "\n\n### Input:\nx" + tail


def test_code_prompts(spark):
    code = F.lit("\nx = 1\n")
    frame = "### Instruction:\n{}\n\n### Input:\nx = 1\n\n### Response:\n"
    fix = "Fix the following Python code that produces this error: "
    review = (
        "Review the following Python code. Identify bugs, issues, and suggest improvements. "
        "Be specific and actionable."
    )
    docstring = "Add a detailed docstring to the following Python function."
    for column, task in [
        (prompts.explain_prompt(code), "Explain what the following Python code does, step by step."),
        (prompts.review_prompt(code), review),
        (prompts.fix_prompt(code), fix + "issues found during review"),
        (prompts.fix_prompt(code, F.lit(" E: 1 ")), fix + "E: 1"),
        (prompts.docstring_prompt(code), docstring),
    ]:
        assert one(spark, column) == frame.format(task)


def test_generate_and_completion_prompts(spark):
    assert one(spark, prompts.generate_prompt(F.lit(" hi "))) == (
        "### Instruction:\nhi\n\n### Response:\n"
    )
    assert one(spark, prompts.completion_prompt(F.lit("def f():\n"))) == (
        "### Instruction:\nComplete the following Python function. Only return the completed "
        "function body, no explanation.\n\ndef f():\n\n\n### Response:\n"
    )
