import json
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from codeprep.functions.scores import pass_at_k, percent_or_null
from codeprep.operators import comparison, evaluation
from codeprep.plans import evaluation as plan
from codeprep.sources import reports

# Problems without a passing sample in two published runs of 164
# problems with one sample each, and the running averages of these runs.
FAILED = {
    "baseline": [
        26, 32, 39, 65, 69, 71, 82, 83, 91, 93, 94, 99, 101, 106, 108, 110, 111, 115, 124, 127,
        129, 132, 133, 134, 139, 140, 144, 145, 149, 150, 155, 162, 163,
    ],
    "finetuned": [
        8, 10, 26, 32, 33, 65, 75, 77, 83, 108, 110, 120, 127, 129, 130, 132, 133, 134, 137, 139,
        140, 142, 145, 162, 163,
    ],
}
RUNNING = {
    "baseline": ["1.000", "0.925", "0.950", "0.925", "0.880", "0.850", "0.821", "0.806"],
    "finetuned": ["0.900", "0.875", "0.917", "0.900", "0.910", "0.908", "0.857", "0.856"],
}
SCHEMA = "label string, task_id string, row_idx long, sample_idx long, passed boolean, error string"


@pytest.fixture(scope="module")
def published(spark):
    rows = [
        (label, f"Task/{i}", i, 0, i not in failed, "E: x" if i in failed else None)
        for label, failed in FAILED.items()
        for i in range(164)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [("baseline", "m/a", "2026-04-25T11:41:52", 0.2, 522.68),
         ("finetuned", "m/b", "2026-04-26T08:29:42", 0.2, 647.7)],
        "label string, model_path string, timestamp string, temperature double, elapsed_sec double",
    )


def exact_pass(n, c, k):
    return 1.0 if n - c < k else 1 - math.comb(n - c, k) / math.comb(n, k)


@pytest.mark.parametrize("k", [1, 2, 10, 25])
def test_pass_at_k(spark, k):
    cases = [(n, c) for n in [*range(1, 31), 200] for c in range(n + 1)]
    table = spark.createDataFrame(cases, "n long, c long")
    got = table.select("n", "c", pass_at_k(F.col("n"), F.col("c"), k).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(exact_pass(r.n, r.c, k), abs=1e-12)
        assert 0 <= r.p <= 1
    by_n = {}
    for r in sorted(got, key=lambda r: (r.n, r.c)):
        assert r.p >= by_n.get(r.n, 0) - 1e-12
        by_n[r.n] = r.p


def test_zero_share_is_null(spark):
    shares = spark.createDataFrame([(0.0,), (0.5,), (0.12345,)], "share double")
    got = [r.p for r in shares.select(percent_or_null(F.col("share")).alias("p")).collect()]
    assert got == [None, 50.0, 12.35]


def test_published_summary(published):
    summary = {r.label: r for r in evaluation.run_summary(evaluation.per_problem(published)).collect()}
    old, new = summary["baseline"], summary["finetuned"]
    assert (old.pass_at_1, new.pass_at_1) == (79.88, 84.76)
    assert (old.num_passed, old.num_failed, new.num_passed, new.num_failed) == (131, 33, 139, 25)
    assert (old.num_problems, old.num_samples, old.pass_at_10) == (164, 1, None)


def test_published_progress(published, monkeypatch):
    for blocks in (4096, 3):
        monkeypatch.setattr(evaluation, "STEPS_PER_BLOCK", blocks)
        lines = evaluation.running_pass1(evaluation.per_problem(published)).orderBy("n_done").collect()
        for label, expected in RUNNING.items():
            mine = [r for r in lines if r.label == label]
            assert [r.n_done for r in mine] == list(range(20, 161, 20))
            assert [f"{r.pass_at_1_so_far:.3f}" for r in mine] == expected


def test_published_changes(published):
    failed = evaluation.failed_tasks(evaluation.per_problem(published))
    for label, expected in FAILED.items():
        rows = failed.filter(F.col("label") == label).orderBy("row_idx").collect()
        assert [r.task_id for r in rows] == [f"Task/{i}" for i in expected]
    changes = comparison.fixed_and_broken(failed)
    counts = {r.change: r.n_tasks for r in comparison.change_counts(changes).collect()}
    assert counts == {"fixed": 17, "broken": 9}
    broken = [r.task_id for r in changes.collect() if r.change == "broken"]
    assert broken == sorted(broken) and broken.index("Task/10") < broken.index("Task/8")


def test_metric_table_and_headline(published):
    summary = evaluation.run_summary(evaluation.per_problem(published))
    table = [tuple(r)[1:] for r in comparison.metric_table(summary).orderBy("line").collect()]
    assert table == [
        ("pass@1 (%)", 79.88, 84.76, 4.88),
        ("Problems passed", 131.0, 139.0, 8.0),
        ("Total problems", 164.0, 164.0, None),
    ]
    line = comparison.headline(summary, "M", 84042).first().headline
    assert "84042 Python samples" in line and "79.88% -> 84.76% (+4.9%)" in line
    only_one = summary.filter(F.col("label") == "baseline")
    assert comparison.metric_table(only_one).count() == 0


def many_samples(spark, n=12):
    """Task 0 never passes, task 1 always, task 2 every third time."""
    errors = ["E: a", "", None, "E: b"]
    rows = []
    for task in range(3):
        for i in range(n):
            passed = task == 1 or (task == 2 and i % 3 == 0)
            rows.append(("run", f"t{task}", task, i, passed, None if passed else errors[i % 4]))
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_errors_in_sample_order(spark):
    attempts = many_samples(spark)
    problems = {r.task_id: r for r in evaluation.per_problem(attempts).collect()}
    expected = {
        "t0": ["E: a", "E: b"] * 3,
        "t2": [e for i in range(12) if i % 3 and (e := ["E: a", "", None, "E: b"][i % 4])],
    }
    listed = {}
    for r in evaluation.problem_errors(attempts).orderBy("task_id", "sample_idx").collect():
        listed.setdefault(r.task_id, []).append(r.error)
    assert listed == expected
    assert {t: r.num_errors for t, r in problems.items()} == {"t0": 6, "t1": 0, "t2": len(expected["t2"])}


def test_many_errors_of_one_sample_stay_rows(spark):
    rows = [("run", "t", 0, 5, False, f"E: {i}") for i in range(3000)]
    errors = evaluation.problem_errors(spark.createDataFrame(rows, SCHEMA))
    assert errors.columns == ["label", "task_id", "sample_idx", "error"]
    assert errors.count() == 3000


@pytest.mark.parametrize("first, step", [(1, 1), (7, 13), (-5, 1)])
def test_progress_counts_problems_whatever_their_numbers(spark, first, step):
    rows = [("run", f"t{i}", first + step * i, 0, i % 2 == 0, None) for i in range(60)]
    lines = evaluation.running_pass1(
        evaluation.per_problem(spark.createDataFrame(rows, SCHEMA))
    ).collect()
    assert sorted((r.n_done, r.pass_at_1_so_far) for r in lines) == [(20, 0.5), (40, 0.5), (60, 0.5)]


def test_pass_10_needs_ten_samples(spark):
    enough = evaluation.run_summary(evaluation.per_problem(many_samples(spark, 12))).first()
    mean = (0 + 1 + exact_pass(12, 4, 10)) / 3
    assert enough.pass_at_10 == round(mean * 100, 2)
    few = evaluation.run_summary(evaluation.per_problem(many_samples(spark, 9))).first()
    assert few.pass_at_10 is None
    none = many_samples(spark).filter("task_id = 't0'")
    assert evaluation.run_summary(evaluation.per_problem(none)).first().pass_at_10 is None


def test_report_lines(published, runs):
    summary = evaluation.with_run_details(
        evaluation.run_summary(evaluation.per_problem(published)), runs
    )
    lines = {r.label: r.report for r in evaluation.report_lines(summary).collect()}
    assert lines["baseline"] == (
        "RESULTS - BASELINE\npass@1: 79.88%\nPassed: 131 / 164\nTime: 8.7 min"
    )


def test_reports_of_separate_evaluations(spark, published, runs, tmp_path):
    out = str(tmp_path / "reports")
    for run in ("baseline", "finetuned"):
        plan.evaluate(published.filter(F.col("label") == run), runs, out)
    metrics, changes = plan.compare(spark, [out])
    assert metrics.filter("line = 1").first().delta == 4.88
    assert changes.count() == 26
    stored = reports.read_problems(spark, [out])
    assert evaluation.running_pass1(stored).count() == 16
    errors = reports.read_errors(spark, [out])
    assert errors.groupBy("label").count().orderBy("label").collect() == [("baseline", 33), ("finetuned", 25)]
    with pytest.raises(FileNotFoundError):
        plan.compare(spark, [out], "baseline", "other")
    with pytest.raises(FileNotFoundError):
        plan.compare(spark, [out, str(tmp_path / "none")])


def test_a_repeated_evaluation_replaces_its_run_only(spark, published, runs, tmp_path):
    out = str(tmp_path / "reports")
    plan.evaluate(published, runs, out)
    better = published.filter("label = 'baseline'").withColumns(
        {"passed": F.lit(True), "error": F.lit(None).cast("string")}
    )
    plan.evaluate(better, runs, out)
    summary = {r.label: r.num_passed for r in reports.read_summary(spark, [out]).collect()}
    assert summary == {"baseline": 164, "finetuned": 139}
    assert {r.label for r in reports.read_errors(spark, [out]).collect()} == {"finetuned"}


def test_runs_in_two_folders_and_details_given_twice(spark, published, runs, tmp_path):
    folders = [str(tmp_path / run) for run in ("baseline", "finetuned")]
    older = runs.withColumns({"timestamp": F.lit("2020"), "model_path": F.lit("old")})
    for folder, run in zip(folders, ("baseline", "finetuned")):
        plan.evaluate(published.filter(F.col("label") == run), runs.unionByName(older), folder)
    assert [r.delta for r in plan.compare(spark, folders)[0].orderBy("line").collect()] == [4.88, 8.0, None]
    assert {r.model_path for r in reports.read_summary(spark, folders).collect()} == {"m/a", "m/b"}


def test_nested_export(spark, published, runs, tmp_path):
    out, nested = str(tmp_path / "reports"), str(tmp_path / "nested")
    plan.evaluate(published, runs, out)
    reports.export_nested(spark, [out], ["baseline", "finetuned"], nested)
    reports.export_nested(spark, [out], ["finetuned"], nested)
    paths = [f"{nested}/run=baseline", f"{nested}/run=finetuned"]
    document = json.loads(next(Path(paths[0]).glob("*.json")).read_text())
    assert document["pass@10"] is None and document["elapsed_sec"] == 522.7
    assert list(document) == [
        "label", "model_path", "timestamp", "num_problems", "num_samples", "temperature",
        "pass@1", "pass@10", "num_passed", "num_failed", "elapsed_sec", "failed_tasks",
        "per_problem",
    ]
    assert document["failed_tasks"] == [f"Task/{i}" for i in FAILED["baseline"]]
    assert document["per_problem"][26] == {
        "task_id": "Task/26", "num_correct": 0, "num_samples": 1, "pass@1": 0.0, "errors": ["E: x"],
    }
    assert document["per_problem"][0]["errors"] == []
    read = reports.read_nested(spark, paths)
    assert evaluation.running_pass1(reports.nested_problems(read)).count() == 16
    assert {r.label: r.pass_at_1 for r in reports.nested_summary(read).collect()} == {
        "baseline": 79.88, "finetuned": 84.76,
    }
    with pytest.raises(FileNotFoundError):
        reports.export_nested(spark, [out], ["other"], nested)


def test_an_evaluation_that_stops_on_the_way_leaves_the_old_report(spark, published, runs, tmp_path, monkeypatch):
    out = str(tmp_path / "reports")
    plan.evaluate(published, runs, out)
    before = {name: sorted(map(tuple, reports.read_table(spark, [out], name).collect()), key=repr) for name in reports.TABLES}
    better = published.withColumns({"passed": F.lit(True), "error": F.lit(None).cast("string")})
    problems = evaluation.per_problem(better)
    summary = evaluation.with_run_details(evaluation.run_summary(problems), runs)
    broken = evaluation.problem_errors(better).withColumn("error", F.raise_error(F.lit("lost")))
    for tables in ((summary, problems.withColumn("row_idx", F.raise_error(F.lit("lost")).cast("bigint")), broken),):
        with pytest.raises(Exception, match="lost"):
            reports.write_reports(*tables, out)
    with monkeypatch.context() as patch:
        patch.setattr(reports.Manifest, "put", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            plan.evaluate(better, runs, out)
    after = {name: sorted(map(tuple, reports.read_table(spark, [out], name).collect()), key=repr) for name in reports.TABLES}
    assert after == before
    plan.evaluate(better, runs, out)
    assert {r.num_passed for r in reports.read_summary(spark, [out]).collect()} == {164}
    assert reports.read_errors(spark, [out]).count() == 0


def test_labels_that_look_like_numbers(spark, published, runs, tmp_path):
    folders = [str(tmp_path / "a b"), str(tmp_path / "c")]
    for folder, run, label in zip(folders, ("baseline", "finetuned"), ("1", "base")):
        own = published.filter(F.col("label") == run).withColumn("label", F.lit(label))
        plan.evaluate(own, runs.withColumn("label", F.lit(label)).limit(1), folder)
    assert {r.label for r in reports.read_summary(spark, folders).collect()} == {"1", "base"}
    assert {r.label for r in reports.read_errors(spark, folders).collect()} == {"1", "base"}
    metrics, changes = plan.compare(spark, folders, "1", "base")
    assert metrics.filter("line = 1").first().delta == 4.88 and changes.count() == 26
    for label in ("01", "1", "1.0", "2024-01-01", "true", "null", "__HIVE_DEFAULT_PARTITION__"):
        own = published.filter("label = 'baseline'").withColumn("label", F.lit(label))
        plan.evaluate(own, runs.withColumn("label", F.lit(label)).limit(1), folders[0])
    labels = sorted(r.label for r in reports.read_summary(spark, folders[:1]).collect())
    assert labels == sorted(["01", "1", "1.0", "2024-01-01", "true", "null", "__HIVE_DEFAULT_PARTITION__"])
    assert reports.read_problems(spark, folders[:1]).count() == 164 * 7


def test_manifests_that_meet(spark, tmp_path, monkeypatch):
    """Another manifest takes the number between reading and writing."""
    path = str(tmp_path)
    manifest = reports.Manifest(spark, path)
    manifest.put("v1", ["a", "b"])
    read, other = reports.Manifest._read, []

    def meets(self, number):
        entries = read(self, number)
        if not other:
            other.append(reports.Manifest(spark, path))
            other[0].put("v2", ["b", None])
        return entries

    monkeypatch.setattr(reports.Manifest, "_read", meets)
    manifest.put("v3", ["c"])
    held = {(e["run"], e["version"]) for e in manifest.runs()}
    assert held == {("a", "v1"), ("b", "v2"), (None, "v2"), ("c", "v3")}
    assert sorted(p.name for p in tmp_path.glob("[!.]*")) == [f"manifest-0000000{i}" for i in (1, 2, 3)]
