import json
import os

import pytest

from codeprep.sources import files, instructions, problems
from codeprep.sources.instructions import SourceSpec, load_report, load_sources, rejected_files


def write(spark, path, rows, schema, parts=1):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(str(path))
    return str(path)


def test_broken_sources_are_skipped(spark, tmp_path):
    good = write(spark, tmp_path / "good", [("i", "o")], "instruction string, output string")
    garbage = tmp_path / "garbage.parquet"
    garbage.write_bytes(b"not parquet at all")
    specs = [
        SourceSpec("garbage", str(garbage)),
        SourceSpec("absent", str(tmp_path / "absent")),
        SourceSpec("good", good),
    ]
    rows, statuses = load_sources(spark, specs)
    assert [(s.name, s.loaded) for s in statuses] == [
        ("garbage", False), ("absent", False), ("good", True),
    ]
    assert [tuple(r) for r in rows.drop("file").collect()] == [("good", 2, 0, "i", "", "o")]
    report = {r.source: (r.loaded, r.n_rows) for r in load_report(spark, rows, statuses).collect()}
    assert report == {"garbage": (False, 0), "absent": (False, 0), "good": (True, 1)}


def test_nothing_loaded_is_an_error(spark, tmp_path):
    with pytest.raises(RuntimeError):
        load_sources(spark, [SourceSpec("absent", str(tmp_path / "absent"))])
    with pytest.raises(RuntimeError):
        load_sources(spark, [])


def test_filters_and_remapping(spark, tmp_path):
    path = write(
        spark,
        tmp_path / "s",
        [
            (0, "Python", "p0", None), (1, "java", "p1", "s"), (2, None, "p2", "s"),
            (3, "PYTHON", None, "s"),
        ],
        "id int, lang string, problem string, solution string",
    )
    columns = {"instruction": "problem", "output": "solution"}
    spec = SourceSpec("s", path, columns=columns, equals={"lang": "python"}, order_col="id")
    rows = load_sources(spark, [spec])[0].drop("file").orderBy("row_idx").collect()
    assert [tuple(r)[2:] for r in rows] == [(0, "p0", "", ""), (3, "", "", "s")]
    spec = SourceSpec("s", path, columns=columns, contains={"lang": "yth"}, order_col="id")
    assert load_sources(spark, [spec])[0].count() == 2
    # A filter on a column that the source lacks sees empty text.
    spec = SourceSpec("s", path, columns=columns, equals={"other": "x"}, order_col="id")
    assert load_sources(spark, [spec])[0].count() == 0


def test_numbers_become_text(spark, tmp_path):
    path = write(spark, tmp_path / "n", [(7, 1.5)], "instruction int, output double")
    row = load_sources(spark, [SourceSpec("n", path)])[0].first()
    assert (row.instruction, row.input, row.output) == ("7", "", "1.5")


def in_file_order(rows):
    return [r.instruction for r in sorted(rows, key=lambda r: (r.file, r.row_idx))]


def test_positions_in_parquet_files(spark, tmp_path):
    path = tmp_path / "many"
    spark.range(1000, numPartitions=7).selectExpr("cast(id as string) instruction").write.option(
        "maxRecordsPerFile", 60
    ).parquet(str(path))
    rows, _ = load_sources(spark, [SourceSpec("many", str(path))])
    assert in_file_order(rows.collect()) == [str(i) for i in range(1000)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_positions_count_rows_before_the_filter(spark, tmp_path):
    path = tmp_path / "filtered"
    spark.range(100, numPartitions=1).selectExpr(
        "cast(id as string) instruction", "if(id % 10 = 0, 'Keep', 'drop') lang"
    ).write.parquet(str(path))
    rows, _ = load_sources(spark, [SourceSpec("f", str(path), equals={"lang": "keep"})])
    assert sorted((r.row_idx, int(r.instruction)) for r in rows.collect()) == [
        (i, i) for i in range(0, 100, 10)
    ]


def test_positions_in_json_lines(spark, tmp_path):
    path = tmp_path / "j"
    path.mkdir()
    for f in range(3):
        lines = [json.dumps({"instruction": f"{f}-{i:05d}", "extra": 1}) for i in range(4000)]
        (path / f"{f}.json").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows, _ = load_sources(spark, [SourceSpec("j", str(path), format="json")])
        got = rows.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert in_file_order(got) == [f"{f}-{i:05d}" for f in range(3) for i in range(4000)]
    assert len({(r.file, r.row_idx) for r in got}) == 12000


def test_first_problems(spark):
    table = spark.range(50).selectExpr("50 - id as row_idx", "cast(id as string) as task_id")
    for wanted, count in [(None, 50), (0, 50), (7, 7), (50, 50), (90, 50)]:
        rows = problems.first_problems(table, wanted)
        assert rows.columns == table.columns
        assert sorted(r.row_idx for r in rows.collect()) == list(range(1, count + 1))


@pytest.mark.parametrize("wanted", [1, 7, 8, 20])
def test_first_problems_of_tied_positions(spark, wanted):
    rows = [(i // 5, f"t{i:02d}", None if i % 2 else "p") for i in range(20)]
    table = spark.createDataFrame(rows, "row_idx long, task_id string, prompt string")
    got = problems.first_problems(table.repartition(4), wanted).collect()
    assert sorted(tuple(r) for r in got) == rows[:wanted] if wanted < 20 else len(got) == 20


def test_first_problems_without_positions(spark):
    rows = [(None, "b"), (None, "a"), (3, "c"), (1, "d"), (1, "d"), (1, "e")]
    table = spark.createDataFrame(rows, "row_idx long, task_id string").repartition(3)
    order = [(None, "a"), (None, "b"), (1, "d"), (1, "d"), (1, "e"), (3, "c")]
    for wanted in range(1, 7):
        got = sorted(map(tuple, problems.first_problems(table, wanted).collect()), key=repr)
        assert got == sorted(order[:wanted], key=repr)


def test_first_problems_sorts_no_texts(spark, tmp_path):
    spark.range(1000).selectExpr("id as row_idx", "cast(id as string) as prompt").write.parquet(str(tmp_path / "p"))
    chosen = problems.first_problems(spark.read.parquet(str(tmp_path / "p")), 10)
    text = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in text and "Exchange" not in text and "LessThan(row_idx,9)),EqualNullSafe(row_idx,9))]" in text
    assert chosen.count() == 10


def test_code_files(spark, tmp_path):
    folder = tmp_path / "code"
    deep = folder / "_inner" / ".hidden"
    deep.mkdir(parents=True)
    (folder / "empty").mkdir()
    (folder / "a.py").write_text("x = 1\ny = 2\n")
    (folder / "b.py").write_text(" \n\t　\n")
    (folder / "c.py").write_text("z" * 3001)
    (deep / "__init__.py").write_bytes(b"one\r\ntwo\rthree\n")
    (folder / "_private.py").write_bytes(b"\xff\xfe")
    scanned = files.scan_code_files(spark, str(folder))
    kept, rejected = files.split_blank(scanned)
    bad = {r.source_path: r.error for r in rejected.collect()}
    assert set(bad) == {"b.py", "_private.py"} and bad["b.py"] is None
    assert bad["_private.py"].startswith("UnicodeDecodeError")
    by_path = {r.source_path: r for r in kept.collect()}
    assert set(by_path) == {"a.py", "c.py", "_inner/.hidden/__init__.py"}
    assert by_path["_inner/.hidden/__init__.py"].code == "one\ntwo\nthree\n"
    assert by_path["_inner/.hidden/__init__.py"].source_name == "__init__.py"
    by_name = {r.source_name: r for r in files.code_prompts(kept).collect()}
    assert by_name["a.py"].explain.endswith("### Input:\nx = 1\ny = 2\n\n### Response:\n")
    assert "z" * 3000 + "\n# ... (truncated)\n\n###" in by_name["c.py"].review
    alone = files.scan_code_files(spark, str(deep / "__init__.py")).collect()
    assert [(r.source_path, r.code) for r in alone] == [("__init__.py", "one\ntwo\nthree\n")]
    assert files.scan_code_files(spark, str(folder / "empty")).count() == 0
    with pytest.raises(FileNotFoundError):
        files.scan_code_files(spark, str(tmp_path / "none"))


ODD_NAMES = ["a b.py", "c#d.py", "q?x.py", "e%41.py", "ü.py", "x=1;y&z.py", "[a]*.py", "back\\slash.py", "'quoted'\".py"]


def test_file_names_are_no_addresses(spark, tmp_path):
    folder = tmp_path / "my code #1" / "100%25"
    folder.mkdir(parents=True)
    for name in [*ODD_NAMES, "c", "q", "eA.py", "e"]:
        (folder / name).write_text(f"text of {name}")
    expected = {f"100%25/{n}": f"text of {n}" for n in [*ODD_NAMES, "c", "q", "eA.py", "e"]}
    working = spark._jvm.java.lang.System.getProperty("user.dir")
    root = folder.parent
    for path in (str(root), f"file:{root}", f"file://{root}/", os.path.relpath(root, working)):
        got = files.scan_code_files(spark, path).collect()
        assert {r.source_path: r.code for r in got} == expected and not any(r.error for r in got)
    for name in ODD_NAMES:
        (one,) = files.scan_code_files(spark, str(folder / name)).collect()
        assert (one.source_path, one.code) == (name, f"text of {name}")


def test_a_folder_that_cannot_be_listed_is_reported(spark, tmp_path, monkeypatch):
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.py").write_text("x")
    (tmp_path / "b.py").write_text("y")
    # A folder that is gone when its turn comes.
    level = spark.createDataFrame([(str(tmp_path / "gone"), "gone"), (str(tmp_path), "")], "path string, source_path string")
    rows = level.mapInArrow(files._list_folders("file:///"), files._ENTRIES).collect()
    bad = [r for r in rows if r.error]
    assert [(r.source_path, r.is_folder) for r in bad] == [("gone", False)]
    assert {r.source_path for r in rows if not r.error} == {"good", "b.py"}
    listed = spark.createDataFrame([(r.path, r.source_path, r.error) for r in bad], "path string, source_path string, error string")
    (row,) = listed.mapInArrow(files._read_files("file:///"), files._FILES).collect()
    assert row.code is None and row.error == bad[0].error


def test_places_keep_the_file_system(spark, monkeypatch):
    place = files.locate(spark, "file:/a b/c#d?e%41")
    assert place == files.Place("file:///", "a b/c#d?e%41")
    assert place.open()[1] == "/a b/c#d?e%41"
    assert files.Place("s3://bucket/", "x y").store == "s3://bucket/"


def damaged(path, how):
    data = path.read_bytes()
    if how == "cut":
        data = data[: len(data) // 2]
    elif how == "changed":
        at = len(data) // 4
        data = data[:at] + bytes(b ^ 0x5A for b in data[at : at + 400]) + data[at + 400 :]
    else:
        data = b""
    path.write_bytes(data)


@pytest.mark.parametrize("how", ["cut", "changed", "emptied"])
@pytest.mark.parametrize("kind", ["parquet", "orc", "json.gz"])
@pytest.mark.parametrize("order_col", [None, "id"])
def test_broken_files_among_good_ones(spark, tmp_path, how, kind, order_col):
    folder = tmp_path / "my files #1"
    rows = spark.range(4000, numPartitions=4).selectExpr("id", "sha2(cast(id as string), 256) as instruction", "'o' as output")
    writer = rows.write
    (writer.option("compression", "gzip").json(str(folder)) if kind == "json.gz" else writer.format(kind).save(str(folder)))
    parts = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    assert len(parts) == 4
    if (kind, how) == ("orc", "changed"):
        pytest.skip("the format has no checksums: other letters are other texts")
    damaged(parts[0], how)
    for check in folder.glob(".*.crc"):
        check.unlink()
    kind = kind.partition(".")[0]
    specs = [SourceSpec("s", str(folder), format=kind, order_col=order_col)]
    combined, statuses = load_sources(spark, specs, guarded=True)
    report = load_report(spark, combined, statuses).first()
    assert (report.loaded, report.n_rows) == (True, 3000)
    assert len({r.instruction for r in combined.collect()}) == 3000
    bad = [(r.file.endswith(parts[0].name), bool(r.reason)) for r in rejected_files(spark, statuses).collect()]
    # A file without a byte has no rows, and Spark opens none.
    assert bad == ([] if how == "emptied" else [(True, True)]) and report.n_rejected == len(bad)


def test_too_many_broken_files_fail_their_source_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(instructions, "MOST_REJECTED", 2)
    bad, good = tmp_path / "bad", write(spark, tmp_path / "good", [("i", "o")], "instruction string, output string")
    spark.range(40).selectExpr("cast(id as string) as instruction").repartition(4).write.parquet(str(bad))
    for path in sorted(bad.glob("part-*"))[:3]:
        damaged(path, "cut")
    combined, statuses = load_sources(spark, [SourceSpec("bad", str(bad)), SourceSpec("good", good)], guarded=True)
    assert [(s.loaded, s.rejected) for s in statuses] == [(False, ()), (True, ())]
    assert combined.count() == 1
