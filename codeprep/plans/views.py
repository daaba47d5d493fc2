"""Inputs of the registered queries, derived from the given tables.

The tables hold prose, so the views put in what the operators look for: code
keywords, end markers, fences, chat commands. Every view covers all rows and
whole texts of its table. The SQL means the same in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SAMPLES = """
    SELECT CAST(substr(source, 4) AS INT) % 5 AS source_rank, doc_id AS row_idx, lang,
        CASE doc_id % 11 WHEN 0 THEN concat('</s> ', text) WHEN 1 THEN NULL ELSE text END
            AS instruction,
        CASE doc_id % 4 WHEN 0 THEN concat(' ', source, ' ') WHEN 1 THEN '' END AS input,
        CASE doc_id % 5
            WHEN 0 THEN concat('def f(x):', chr(10), text, '<|endoftext|>')
            WHEN 1 THEN concat(text, '<e</s>os>', chr(10)) ELSE text END AS output
    FROM {documents}
"""

# Whole rows that repeat, the last wanted one among them.
REPEATED = """
    SELECT CAST(substr(source, 4) AS INT) % 5 AS source_rank, CAST(doc_id % 7 AS BIGINT) AS row_idx,
        concat('text ', CAST(doc_id % 7 AS STRING)) AS output
    FROM {documents}
"""

PROBLEMS = """
    SELECT concat('Problem/', CAST(item_id AS STRING)) AS task_id, item_id AS row_idx,
        text AS prompt
    FROM {benchmark}
"""

COMPLETIONS = """
    SELECT conv_id AS task_id, turn AS sample_idx,
        concat('def f', CAST(conv_id AS STRING), '(x):', chr(10)) AS prompt,
        CASE turn % 4
            WHEN 1 THEN concat('Sure!', chr(10), '```python', chr(10), 'import math', chr(10),
                'def f(x):', chr(10), '    return x', chr(10), 'print(f(1))', chr(10), '```',
                chr(10), text)
            WHEN 2 THEN concat(' ```', chr(10), text, chr(10), '``` ')
            WHEN 3 THEN concat('```python', chr(10), 'class A:', chr(13), chr(10), '    ', text,
                chr(10), '```', chr(10))
            ELSE concat('    return x', chr(10), text) END AS response
    FROM {conversations}
"""

# Two runs with many samples per problem.
ATTEMPTS = """
    SELECT CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'finetuned' END AS label,
        concat('Task/', CAST(user_id AS STRING)) AS task_id, user_id AS row_idx,
        event_id AS sample_idx, event_type IN ('purchase', 'view') AS passed,
        CASE WHEN event_type IN ('purchase', 'view') THEN NULL
            WHEN event_type = 'error' THEN 'AssertionError: ' WHEN event_type = 'click' THEN ''
            ELSE concat('NameError: ', event_type) END AS error
    FROM {events}
"""

# Two runs with one sample per problem: events 2i and 2i+1 are the attempts at problem i.
SINGLE_ATTEMPTS = """
    SELECT CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'finetuned' END AS label,
        concat('Task/', CAST(CAST(floor(event_id / 2) AS BIGINT) AS STRING)) AS task_id,
        CAST(floor(event_id / 2) AS BIGINT) AS row_idx, CAST(0 AS BIGINT) AS sample_idx,
        event_type IN ('purchase', 'view') AS passed,
        CASE WHEN event_type IN ('purchase', 'view') THEN NULL
            ELSE concat('NameError: ', event_type) END AS error
    FROM {events}
"""

# The same with every seventh problem left out, so that positions and numbers differ.
GAPPED_ATTEMPTS = f"SELECT * FROM ({SINGLE_ATTEMPTS}) AS a WHERE row_idx % 7 <> 3"

CODE_FILES = """
    SELECT concat('page_', CAST(page_id AS STRING), '.py') AS source_name,
        CASE WHEN page_id % 17 = 0 THEN ' ' ELSE html END AS code
    FROM {pages}
"""

# Names that hold signs with a meaning in addresses or patterns.
FILE_NAMES = (
    "__init__.py", "_own.py", "main.py", "a b.py", "c#d.py", "q?x.py", "e%41.py", "ü.py", "[a]*.py", "x=1;y.py"
)

CHAT_LOG = """
    SELECT conv_id, turn, role,
        CASE WHEN role <> 'user' THEN text
            WHEN conv_id % 14 = 5 AND turn = 0 THEN '/Save'
            WHEN conv_id % 14 = 1 AND turn = 4 THEN '/save'
            WHEN conv_id % 7 = 1 AND turn = 2 THEN ' /CLEAR '
            WHEN conv_id % 7 = 2 AND turn = 2 THEN '/save'
            WHEN conv_id % 7 = 3 AND turn = 2 THEN '/q'
            WHEN conv_id % 7 = 4 AND turn = 2 THEN '  ' ELSE text END AS text
    FROM {conversations}
"""

TABLES = ("documents", "benchmark", "conversations", "events", "pages")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: read(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def as_duckdb(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})
