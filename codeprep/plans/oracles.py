"""DuckDB SQL that must give the same rows as the registered queries.

Written from the meaning of each operator with DuckDB's own means: plain
single-level windows, list functions, set differences.
"""

from __future__ import annotations

from codeprep.functions import prompts as p
from codeprep.functions.completions import CODE_MARKERS
from codeprep.functions.text import END_TOKENS, WHITESPACE
from codeprep.operators.cleaning import CODE_KEYWORDS
from codeprep.plans import queries as q
from codeprep.plans import views

WS = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def text(value: str) -> str:
    """A SQL literal; line breaks are spelled out."""
    lines = ["'" + line.replace("'", "''") + "'" for line in value.split("\n")]
    return "(" + " || chr(10) || ".join(lines) + ")"


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


def cleaned(c: str) -> str:
    for token in END_TOKENS:
        c = f"replace({c}, '{token}', '')"
    return strip(c)


def any_contains(c: str, needles) -> str:
    return "(" + " OR ".join(f"contains({c}, '{n}')" for n in needles) + ")"


SAMPLES = f"""
samples AS ({views.as_duckdb(views.SAMPLES)}),
triples AS (SELECT source_rank, row_idx, coalesce(instruction, '') AS instruction,
    coalesce(input, '') AS input, coalesce(output, '') AS output FROM samples)
"""
CLEAN = f"""{SAMPLES},
clean AS (SELECT source_rank, row_idx, {cleaned('instruction')} AS instruction, input,
    {cleaned('output')} AS output FROM triples)
"""
RULES = f"""{CLEAN},
rules AS (SELECT *, length(output) < 50 OR length(output) > 4000 AS bad_output,
    length(instruction) < 10 AS bad_instruction,
    NOT {any_contains('output', CODE_KEYWORDS)} AS no_keyword,
    lower({strip('substr(instruction, 1, 100)')}) AS key FROM clean),
good AS (SELECT * FROM rules WHERE NOT (bad_output OR bad_instruction OR no_keyword))
"""
KEPT = f"""{RULES},
kept AS (SELECT * FROM good
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, row_idx) = 1)
"""
HASHED = f"""{KEPT},
hashed AS (SELECT source_rank, row_idx, instruction, input, output,
    md5(instruction || '|' || input || '|' || output) AS texts_md5,
    md5('42:' || CAST(source_rank AS VARCHAR) || ':' || CAST(row_idx AS VARCHAR)) AS h FROM kept),
placed AS (SELECT *, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n FROM hashed)
"""
SPLIT = f"""{HASHED},
split AS (SELECT source_rank, row_idx, texts_md5, instruction, input, output,
    CASE WHEN rn <= ceil(CAST(0.02 AS DOUBLE) * n) THEN 'eval' ELSE 'train' END AS split FROM placed)
"""


def over_code(task: str, code: str) -> str:
    return (
        f"{text(p.INSTRUCTION_HEADER)} || {task} || {text(p.INPUT_HEADER)} || {strip(code)}"
        f" || {text(p.RESPONSE_HEADER)}"
    )


def training(end: str) -> str:
    return (
        f"{text(p.INSTRUCTION_HEADER)} || {strip('instruction')}"
        f" || CASE WHEN {strip('input')} <> '' THEN {text(p.INPUT_HEADER)} || {strip('input')}"
        f" ELSE '' END || {text(p.RESPONSE_HEADER)} || {strip('output')} || '{end}'"
    )


SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
FUNCTION = rf"(?s)def{SPACE}+[\p{{L}}\p{{N}}_]+{SPACE}*\(.*"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

COMPLETIONS = f"completions AS ({views.as_duckdb(views.COMPLETIONS)})"
EXTRACT = f"""{COMPLETIONS},
fenced AS (SELECT *, CASE
    WHEN contains(response, '```python')
        THEN string_split(string_split(response, '```python')[2], '```')[1]
    WHEN contains(response, '```') THEN string_split(response, '```')[2]
    ELSE response END AS part FROM completions),
sought AS (SELECT *, coalesce(nullif(regexp_extract(part, '{FUNCTION}'), ''), part) AS code
    FROM fenced),
lines AS (SELECT *, string_split_regex(code, '{BREAK}') AS l FROM sought),
ends AS (SELECT *, list_position(
    list_transform(l[2:], lambda x: regexp_matches(x, '^[a-zA-Z]')), true) AS stop FROM lines),
codes AS (SELECT task_id, sample_idx, prompt, {strip(
    "array_to_string(CASE WHEN coalesce(stop, 0) > 0 THEN l[1:stop] ELSE l END, chr(10))"
)} AS code FROM ends)
"""

ATTEMPTS = f"attempts AS ({views.as_duckdb(views.ATTEMPTS)})"
SINGLE = f"attempts AS ({views.as_duckdb(views.SINGLE_ATTEMPTS)})"


def pass_k(k: int) -> str:
    """1 - prod(1 - k/i) for i from n-c+1 to n: another form than the Spark one."""
    return f"""CASE WHEN num_samples - num_correct < {k} THEN 1.0 ELSE 1.0 - coalesce(list_product(
        list_transform(range(num_samples - num_correct + 1, num_samples + 1),
                       lambda i: 1.0 - CAST({k} AS DOUBLE) / i)), 1.0) END"""


PROBLEMS = f"""
counts AS (SELECT label, task_id, min(row_idx) AS row_idx,
    count(*) FILTER (WHERE passed) AS num_correct, count(*) AS num_samples,
    count(*) FILTER (WHERE error <> '') AS num_errors FROM attempts GROUP BY label, task_id),
problems AS (SELECT *, num_correct / num_samples AS pass_at_1 FROM counts)
"""
SUMMARY = f"""
means AS (SELECT label, count(*) AS num_problems, min(num_samples) AS num_samples,
    avg(pass_at_1) AS mean_1, avg({pass_k(10)}) AS mean_10,
    count(*) FILTER (WHERE num_correct > 0) AS num_passed,
    count(*) FILTER (WHERE num_correct = 0) AS num_failed FROM problems GROUP BY label),
summary AS (SELECT label, num_problems, num_samples, round(mean_1 * 100, 2) AS pass_at_1,
    CASE WHEN num_samples >= 10 AND mean_10 <> 0 THEN round(mean_10 * 100, 2) END AS pass_at_10,
    num_passed, num_failed FROM means)
"""
RUNS = """
runs AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'finetuned' END AS label,
    strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS timestamp,
    round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000, 1) AS elapsed_sec
    FROM events GROUP BY 1),
detailed AS (SELECT s.*, 'models/' || s.label AS model_path, r.timestamp,
    CAST(0.2 AS DOUBLE) AS temperature, r.elapsed_sec FROM summary s JOIN runs r USING (label))
"""

CHANGES = """
b AS (SELECT task_id FROM problems WHERE label = 'baseline' AND num_correct = 0),
f AS (SELECT task_id FROM problems WHERE label = 'finetuned' AND num_correct = 0)
SELECT 'fixed' AS change, task_id FROM (SELECT * FROM b EXCEPT SELECT * FROM f)
UNION ALL SELECT 'broken', task_id FROM (SELECT * FROM f EXCEPT SELECT * FROM b)
"""
GAPPED = f"attempts AS ({views.as_duckdb(views.GAPPED_ATTEMPTS)})"
PROGRESS = """
so_far AS (SELECT label, row_number() OVER w AS n_done,
    round(avg(pass_at_1) OVER w, 6) AS pass_at_1_so_far
    FROM problems WINDOW w AS (PARTITION BY label ORDER BY row_idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT * FROM so_far WHERE n_done % 20 = 0
"""

CHAT = f"""
log AS ({views.as_duckdb(views.CHAT_LOG)}),
follow AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM log WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
inputs AS (SELECT conv_id, turn, lower({strip('text')}) AS said,
    CASE WHEN next_role = 'assistant' THEN next_text END AS response
    FROM follow WHERE role = 'user'),
commands AS (SELECT *, CASE WHEN said = '' THEN 'blank'
    WHEN said IN ('/quit', '/exit', '/q') THEN 'quit' WHEN said = '/clear' THEN 'clear'
    WHEN said = '/save' THEN 'save' ELSE 'ask' END AS command FROM inputs)
"""
REPLAY = f"""{CHAT},
session AS (SELECT *, CASE WHEN command = 'ask' THEN response END AS answer,
    coalesce(sum(CASE WHEN command = 'quit' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id
        ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS quits,
    sum(CASE WHEN command = 'clear' THEN 1 ELSE 0 END)
        OVER (PARTITION BY conv_id ORDER BY turn) AS segment
    FROM commands),
states AS (SELECT conv_id, turn, command,
    CAST(count(answer) OVER (PARTITION BY conv_id, segment ORDER BY turn) AS BIGINT) AS turn_count,
    coalesce(last_value(answer IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn), '')
        AS last_response
    FROM session WHERE quits = 0 AND command <> 'blank')
"""

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\p{Z}\t-\r\x1c-\x1f\x{85}]"


def vocab(source: str) -> str:
    return f"""
    found AS (SELECT unnest(regexp_extract_all(text, '{TOKEN}')) AS token FROM {source}),
    tally AS (SELECT token, count(*) AS n FROM found GROUP BY token),
    vocab AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 2 AS id
        FROM tally)
    """


def encoded() -> str:
    return f"""{SAMPLES},
    texts AS (SELECT source_rank, row_idx, {training('')} AS text FROM triples),
    {vocab('texts')},
    lists AS (SELECT source_rank, row_idx, regexp_extract_all(text, '{TOKEN}') AS l FROM texts),
    each_token AS (SELECT source_rank, row_idx, unnest(l) AS token,
        unnest(range(len(l))) AS pos FROM lists),
    ids AS (SELECT source_rank, row_idx, list(coalesce(id, 1) ORDER BY pos) AS ids
        FROM each_token LEFT JOIN vocab USING (token) GROUP BY source_rank, row_idx),
    encoded AS (SELECT source_rank, row_idx, len(l) + 1 > 4096 AS was_truncated,
        list_append(coalesce(ids, []), 2)[1:4096] AS input_ids
        FROM lists LEFT JOIN ids USING (source_rank, row_idx))
    """


def list_md5(c: str) -> str:
    return f"md5(array_to_string({c}, ' '))"


def padded(c: str, filler: int) -> str:
    return (
        f"list_concat({c}, list_transform(range(width - len(input_ids)), lambda i: {filler}))"
    )


SOURCE_RANKS = {"documents": 0, "pages": 1, "missing": 2, "by_language": 3, "by_content": 4}
COMBINED = """
combined AS (
    SELECT 'documents' AS source, 0 AS source_rank, doc_id AS row_idx, text AS instruction,
        source AS input, text AS output FROM documents
    UNION ALL SELECT 'pages', 1, page_id, url, '', html FROM pages
    UNION ALL SELECT 'by_language', 3, doc_id, source, '', text FROM documents
        WHERE lower(lang) = 'en'
    UNION ALL SELECT 'by_content', 4, doc_id, lang, '', text FROM documents
        WHERE contains(lower(text), ' the '))
"""

ORACLES: dict[str, str] = {
    "load_report": f"""WITH {COMBINED},
        listed(source, source_rank) AS (VALUES {", ".join(
            f"('{name}', {rank})" for name, rank in SOURCE_RANKS.items())})
        SELECT l.source, l.source_rank, l.source <> 'missing' AS loaded, count(c.source) AS n_rows,
            CAST(0 AS BIGINT) AS n_rejected
        FROM listed l LEFT JOIN combined c USING (source_rank) GROUP BY l.source, l.source_rank""",
    "load_rejects": """SELECT 'pages' AS source, 0 AS source_rank, true AS loaded, count(*) AS n_rows,
            CAST(1 AS BIGINT) AS n_rejected, 'part=3' AS rejected FROM pages WHERE page_id % 5 <> 3
        UNION ALL SELECT 'documents', 1, true, count(*), 0, NULL FROM documents""",
    "concat_sources": f"WITH {COMBINED} SELECT * FROM combined",
    "source_positions": f"""WITH every AS (
            SELECT 'documents' AS source, 0 AS source_rank, row_number() OVER () AS pos,
                source AS instruction, text AS output FROM documents
            UNION ALL SELECT 'pages', 1, row_number() OVER (), url, html FROM pages),
        keyed AS (SELECT *, lower({strip('substr(instruction, 1, 100)')}) AS key FROM every)
        SELECT source, source_rank, key, md5(output) AS output_md5 FROM keyed
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, pos) = 1""",
    "normalize_triples": f"WITH {SAMPLES} SELECT * FROM triples",
    "source_lang_filter": "SELECT doc_id, lang, text FROM documents WHERE lower(lang) = 'en'",
    "source_remap": """SELECT doc_id, source AS instruction, '' AS input, text AS output
        FROM documents""",
    "source_content_filter": """SELECT doc_id, text FROM documents
        WHERE contains(lower(text), ' the ')""",
    "first_n_problems": f"""SELECT * FROM ({views.as_duckdb(views.PROBLEMS)})
        ORDER BY row_idx LIMIT {q.PROBLEM_LIMIT}""",
    "strip_end_tokens": f"WITH {CLEAN} SELECT * FROM clean",
    "quality_filter": f"""WITH {RULES}
        SELECT source_rank, row_idx, instruction, input, output FROM good""",
    "quality_reject_reasons": f"""WITH {RULES}
        SELECT 'output_length' AS reason, count(*) AS n_rejected FROM rules WHERE bad_output
        UNION ALL SELECT 'instruction_length', count(*) FROM rules WHERE bad_instruction
        UNION ALL SELECT 'no_keyword', count(*) FROM rules WHERE no_keyword
        UNION ALL SELECT 'any_rule', count(*) FROM rules
            WHERE bad_output OR bad_instruction OR no_keyword""",
    "dedup_first_wins": f"""WITH {KEPT}
        SELECT source_rank, row_idx, instruction, input, output, key FROM kept""",
    "dedup_groups": f"""WITH {RULES}
        SELECT group_size, count(*) AS n_groups, CAST(sum(group_size - 1) AS BIGINT) AS n_dropped
        FROM (SELECT key, count(*) AS group_size FROM rules GROUP BY key) GROUP BY group_size""",
    "funnel_counts": f"""WITH {KEPT}
        SELECT source_rank, count(*) AS n_raw,
            (SELECT count(*) FROM good g WHERE g.source_rank = r.source_rank) AS n_quality,
            (SELECT count(*) FROM kept k WHERE k.source_rank = r.source_rank) AS n_dedup
        FROM rules r GROUP BY source_rank""",
    "sample_exact": f"""WITH {HASHED}
        SELECT source_rank, row_idx, texts_md5 FROM placed WHERE rn <= {q.SAMPLE_SIZE}""",
    "sample_repeated": f"""WITH r AS ({views.as_duckdb(views.REPEATED)}),
        p AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(source_rank AS VARCHAR) || ':'
            || CAST(row_idx AS VARCHAR))) AS rn FROM r)
        SELECT source_rank, row_idx, output, count(*) AS n_rows FROM p WHERE rn <= {q.SAMPLE_SIZE}
        GROUP BY source_rank, row_idx, output""",
    "split_by_share": f"""WITH {SAMPLES}
        SELECT source_rank, row_idx, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(source_rank AS VARCHAR)
            || ':' || CAST(row_idx AS VARCHAR)), 1, 8) AS BIGINT) < floor({q.STREAM_SHARE} * 4294967296)
            THEN 'eval' ELSE 'train' END AS split FROM triples""",
    "split_exact": f"WITH {SPLIT} SELECT source_rank, row_idx, split, texts_md5 FROM split",
    "split_written": f"WITH {SPLIT} SELECT source_rank, row_idx, split, texts_md5 FROM split",
    "funnel_last_steps": f"""WITH {SPLIT}
        SELECT source_rank, count(*) AS n_tokenised,
            count(*) FILTER (WHERE split = 'train') AS n_train,
            count(*) FILTER (WHERE split = 'eval') AS n_eval FROM split GROUP BY source_rank""",
    "split_sizes": f"WITH {SPLIT} SELECT split, count(*) AS n_rows FROM split GROUP BY split",
    "render_training_prompt": f"""WITH {CLEAN}, t AS (
            SELECT source_rank, row_idx, {training(p.END_OF_TEXT)} AS prompt FROM clean)
        SELECT source_rank, row_idx, md5(prompt) AS prompt_md5,
            CAST(length(prompt) AS INTEGER) AS n_chars FROM t""",
    "render_completion_prompt": f"""SELECT task_id, {text(p.INSTRUCTION_HEADER + p.COMPLETE_TASK)}
            || chr(10) || chr(10) || prompt || {text(p.RESPONSE_HEADER)} AS prompt
        FROM ({views.as_duckdb(views.PROBLEMS)})""",
    "cli_prompts": f"""SELECT conv_id, turn,
            CASE WHEN length(text) > 60 THEN substr(text, 1, 60) || '...' ELSE text END AS label,
            md5({text(p.INSTRUCTION_HEADER)} || {strip('text')} || {text(p.RESPONSE_HEADER)})
                AS generate_md5,
            md5({over_code(f"{text(p.FIX_TASK)} || {strip('role')}", 'text')}) AS fix_md5,
            md5({over_code(text(p.DOCSTRING_TASK), 'text')}) AS docstring_md5
        FROM conversations""",
    "code_files_prompts": f"""WITH f AS ({views.as_duckdb(views.CODE_FILES)}),
        c AS (SELECT source_name, CASE WHEN length(code) > 3000
            THEN substr(code, 1, 3000) || chr(10) || '# ... (truncated)' ELSE code END AS code
            FROM f WHERE {strip('code')} <> ''),
        r AS (SELECT source_name, {over_code(text(p.EXPLAIN_TASK), 'code')} AS explain,
            {over_code(text(p.REVIEW_TASK), 'code')} AS review,
            {over_code(text(p.FIX_TASK + p.REVIEW_FIX_ERROR), 'code')} AS fix FROM c)
        SELECT source_name, CAST(length(explain) AS INTEGER) AS n_chars,
            md5(explain) AS explain_md5, md5(review) AS review_md5, md5(fix) AS fix_md5 FROM r""",
    "code_file_scan": f"""WITH f AS (SELECT concat('part ', page_id % 7, '/_page_', page_id, '/',
                {list(views.FILE_NAMES)}[page_id % {len(views.FILE_NAMES)} + 1]) AS source_path,
            CASE WHEN page_id % 17 = 0 THEN ' ' ELSE 'x' || chr(10) || 'y' || chr(10)
                || replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)) END AS code
            FROM pages),
        c AS (SELECT source_path, CASE WHEN length(code) > 3000
            THEN substr(code, 1, 3000) || chr(10) || '# ... (truncated)' ELSE code END AS code
            FROM f WHERE {strip('code')} <> ''),
        r AS (SELECT source_path, {over_code(text(p.EXPLAIN_TASK), 'code')} AS explain,
            {over_code(text(p.REVIEW_TASK), 'code')} AS review,
            {over_code(text(p.FIX_TASK + p.REVIEW_FIX_ERROR), 'code')} AS fix FROM c)
        SELECT source_path, md5(explain) AS explain_md5, md5(review) AS review_md5,
            md5(fix) AS fix_md5 FROM r""",
    "extract_code": f"""WITH {EXTRACT}
        SELECT task_id, sample_idx, code, prompt || chr(10) || code AS solution FROM codes""",
    "unfence_answer": f"""WITH {COMPLETIONS}, s AS (
            SELECT task_id, sample_idx, {strip('response')} AS t FROM completions)
        SELECT task_id, sample_idx, CASE WHEN regexp_full_match(t, '(?s)```(?:python)?.*```')
            THEN {strip("regexp_extract(t, '(?s)^```(?:python)?(.*)```$', 1)")}
            ELSE t END AS answer FROM s""",
    "code_like_answers": f"""WITH {COMPLETIONS}, m AS (SELECT task_id, sample_idx, {" + ".join(
            f"CAST(contains(response, '{m}') AS INTEGER)" for m in CODE_MARKERS)} AS n_markers
            FROM completions)
        SELECT task_id, sample_idx, n_markers, n_markers >= 2 AS code_like FROM m""",
    "pass_at_k": f"""WITH {ATTEMPTS}, {PROBLEMS} SELECT label, task_id, {", ".join(
        f"round({pass_k(k)}, 6) AS pass_at_{k}" for k in (1, 5, 10, 40))} FROM problems""",
    "per_problem_results": f"""WITH {ATTEMPTS}, {PROBLEMS}
        SELECT * REPLACE (round(pass_at_1, 6) AS pass_at_1) FROM problems""",
    "problem_errors": f"""WITH {ATTEMPTS}
        SELECT label, task_id, sample_idx, error FROM attempts WHERE error <> ''""",
    "run_summary": f"""WITH {ATTEMPTS}, {PROBLEMS}, {SUMMARY}, {RUNS} SELECT * FROM detailed""",
    "failed_tasks": f"""WITH {SINGLE}, {PROBLEMS}
        SELECT label, row_idx, task_id FROM problems WHERE num_correct = 0""",
    "running_pass1": f"WITH {SINGLE}, {PROBLEMS}, {PROGRESS}",
    "running_pass1_gaps": f"WITH {GAPPED}, {PROBLEMS}, {PROGRESS}",
    "run_report": f"""WITH {ATTEMPTS}, {PROBLEMS}, {SUMMARY}, {RUNS}
        SELECT label, concat_ws(chr(10), 'RESULTS - ' || upper(label),
            'pass@1: ' || CAST(pass_at_1 AS VARCHAR) || '%',
            'pass@10: ' || CAST(pass_at_10 AS VARCHAR) || '%',
            printf('Passed: %d / %d', num_passed, num_problems),
            printf('Time: %.1f min', elapsed_sec / 60)) AS report FROM detailed""",
    "compare_runs": f"""WITH {ATTEMPTS}, {PROBLEMS}, {SUMMARY},
        b AS (SELECT * FROM summary WHERE label = 'baseline'),
        f AS (SELECT * FROM summary WHERE label = 'finetuned'),
        t AS (
            SELECT 1 AS line, 'pass@1 (%)' AS metric, b.pass_at_1 AS baseline,
                f.pass_at_1 AS finetuned FROM b, f
            UNION ALL SELECT 2, 'pass@10 (%)', b.pass_at_10, f.pass_at_10 FROM b, f
                WHERE b.pass_at_10 <> 0 AND f.pass_at_10 <> 0
            UNION ALL SELECT 3, 'Problems passed', b.num_passed, f.num_passed FROM b, f
            UNION ALL SELECT 4, 'Total problems', b.num_problems, f.num_problems FROM b, f)
        SELECT *, CASE WHEN line < 4 THEN round(finetuned - baseline, 2) END AS delta FROM t""",
    "compare_headline": f"""WITH {ATTEMPTS}, {PROBLEMS}, {SUMMARY},
        o AS (SELECT max(pass_at_1) FILTER (WHERE label = 'baseline') AS b,
            max(pass_at_1) FILTER (WHERE label = 'finetuned') AS f FROM summary)
        SELECT 'Fine-tuned a model on ' || (SELECT count(*) FROM documents)
            || ' Python samples, improving pass@1 from '
            || CAST(b AS VARCHAR) || '% -> ' || CAST(f AS VARCHAR) || '% (+'
            || printf('%.1f', f - b) || '%)' AS headline FROM o""",
    "fixed_broken": f"WITH {SINGLE}, {PROBLEMS}, {CHANGES}",
    "compare_changes": f"WITH {SINGLE}, {PROBLEMS}, {CHANGES}",
    "chat_commands": f"""WITH {CHAT}
        SELECT command, count(*) AS n_turns FROM commands GROUP BY command""",
    "chat_replay": f"WITH {REPLAY} SELECT * FROM states",
    "chat_prompts": f"""WITH {REPLAY}
        SELECT s.conv_id, s.turn, md5({text(p.INSTRUCTION_HEADER)} || {strip('l.text')}
            || {text(p.RESPONSE_HEADER)}) AS prompt_md5
        FROM states s JOIN log l ON s.conv_id = l.conv_id AND s.turn = l.turn AND l.role = 'user'
        WHERE s.command = 'ask'""",
    "chat_saves": f"""WITH {REPLAY}
        SELECT conv_id, turn,
            CASE WHEN last_response <> '' THEN 'chat_' || conv_id || '_' || turn || '.py' END
                AS file_name,
            nullif(last_response, '') AS content,
            CASE WHEN last_response <> '' THEN 'saved' ELSE 'nothing to save' END AS outcome
        FROM states WHERE command = 'save'""",
    "vocab_fit": f"WITH {vocab('documents')} SELECT * FROM vocab",
    "vocab_topk": f"""WITH {vocab('documents')}
        SELECT * FROM vocab ORDER BY id LIMIT {q.VOCAB_SIZE}""",
    "encode_lengths": f"""WITH {encoded()}
        SELECT source_rank, row_idx, was_truncated, CAST(len(input_ids) AS INTEGER) AS n_tokens,
            {list_md5('input_ids')} AS ids_md5, {list_md5('input_ids')} AS labels_md5 FROM encoded""",
    "padded_batches": f"""WITH {encoded()},
        keyed AS (SELECT *, md5('42:' || CAST(source_rank AS VARCHAR) || ':'
            || CAST(row_idx AS VARCHAR)) AS h FROM encoded),
        grouped AS (SELECT *, (row_number() OVER (ORDER BY h) - 1) // 4 AS batch FROM keyed),
        wide AS (SELECT *, CAST(ceil(max(len(input_ids)) OVER (PARTITION BY batch) / 8) * 8
            AS INTEGER) AS width FROM grouped)
        SELECT batch, width, source_rank, row_idx, width AS n_padded,
            {list_md5(padded('input_ids', 0))} AS input_ids_md5,
            {list_md5(padded('list_transform(input_ids, lambda x: 1)', 0))} AS attention_mask_md5,
            {list_md5(padded('input_ids', -100))} AS labels_md5 FROM wide""",
}
ORACLES["funnel_observed"] = ORACLES["funnel_counts"]
