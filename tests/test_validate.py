import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators.loadlog import load_log
from sluice.operators.validate import check, csv_width, fault_message
from sluice.sources.lines import lines_from, locate, read_lines
from sluice.spec import LoadSpec

SPEC = LoadSpec.of(
    {
        "onWrongColumnCount": "skip",
        "columns": [
            {"name": "id", "type": "int", "onWrongType": "skip"},
            {"name": "name", "type": "string", "onWrongType": "skip"},
            {"name": "rate", "type": "double", "onWrongType": "skip"},
            {"name": "on", "type": "bool", "onWrongType": "fail"},
        ],
    }
)
LINES = [
    "1,plain,2.5,true",
    '2,"a, b",3,FALSE',
    '3,"say ""hi""",1e3,True',
    "4,short,1",
    "5,long,1,true,more",
    "",
    "abc,bad int,1,true",
    "99999999999,overflow,1,true",
    "7.5,fraction,1,true",
    ",,,",
    "9,日本語 é,-0.5,",
    "x,two faults,y,maybe",
    "10,not a flag,1,yes",
    "+11,signed,1,false",
]


def as_lines(spark, lines, path="in/a.csv"):
    df = spark.createDataFrame(list(enumerate(lines)), "n bigint, value string")
    return lines_from(df, F.col("value"), F.lit(path), F.col("n"))


def test_good_rows(spark):
    good = [tuple(r) for r in check(as_lines(spark, LINES), SPEC).good.collect()]
    assert sorted(good, key=str) == sorted(
        [
            (1, "plain", 2.5, True),
            (2, "a, b", 3.0, False),
            (3, 'say "hi"', 1000.0, True),
            (None, None, None, None),
            (9, "日本語 é", -0.5, None),
            (11, "signed", 1.0, False),
        ],
        key=str,
    )


def test_quarantine_names_the_first_fault_and_its_policy(spark):
    checked = check(as_lines(spark, LINES), SPEC)
    rows = checked.with_line(checked.quarantine)
    message = fault_message(F.col("fault"), F.col("file_name"), F.col("line"), F.col("column_index"))
    found = {r[0]: (r[1], r[2]) for r in rows.select("line", message, "policy").collect()}
    assert found == {
        4: ("[a.csv, line:4]: expected 4 columns, but found 3.", "skip"),
        5: ("[a.csv, line:5]: expected 4 columns, but found 5.", "skip"),
        6: ("[a.csv, line:6]: expected 4 columns, but found 1.", "skip"),
        7: ("[a.csv, line:7, column:0]: an integer was expected, but the value was 'abc'.", "skip"),
        8: ("[a.csv, line:8, column:0]: an integer was expected, but the value was '99999999999'.", "skip"),
        9: ("[a.csv, line:9, column:0]: an integer was expected, but the value was '7.5'.", "skip"),
        12: ("[a.csv, line:12, column:0]: an integer was expected, but the value was 'x'.", "skip"),
        13: ("[a.csv, line:13, column:3]: a boolean was expected, but the value was 'yes'.", "fail"),
    }


def test_statistics_count_accepted_and_rejected(spark):
    row = check(as_lines(spark, LINES), SPEC).file_stats.first()
    assert (row["rows_read"], row["rows_skipped"], row["rows_failed"]) == (14, 8, 1)


def test_staged_equals_direct(spark):
    direct = check(as_lines(spark, LINES), SPEC)
    staged = direct.stage(spark)
    for name in ("quarantine", "file_stats"):
        a, b = getattr(direct, name), getattr(staged, name)
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(
            map(str, b.select(sorted(b.columns)).collect())
        )


def test_staging_is_removed(spark, tmp_path):
    staged = check(as_lines(spark, LINES), SPEC).stage(spark)
    folder = staged.staged_folder
    assert staged.quarantine.count() == 8
    staged.close()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/quarantine").count()


def test_gaps_in_row_ids_are_refused(spark):
    df = spark.createDataFrame([(0, "1,a,1,true"), (5, "2,b,1,true")], "n bigint, value string")
    checked = check(lines_from(df, F.col("value"), F.lit("in/a.csv"), F.col("n")), SPEC)
    with pytest.raises(Exception, match="have gaps"):
        checked.with_line(checked.lines).collect()


def test_log_is_numbered_without_one_task(spark):
    staged = check(as_lines(spark, LINES), SPEC).stage(spark)
    for detailed in (2, None):
        log = load_log(staged, "i", "j", F.current_timestamp(), detailed=detailed)
        assert "SinglePartition" not in log._jdf.queryExecution().executedPlan().toString()
        rows = log.orderBy("log_index").collect()
        assert [r["log_index"] for r in rows] == list(range(len(rows)))
    # Seven skips come before the line that fails the file.
    assert [r["level"] for r in rows].count("SKIP") == len(rows) - 2


def test_parse_is_not_copied_into_the_filter(spark):
    plan = check(as_lines(spark, LINES), SPEC).good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1


@pytest.mark.parametrize(
    "text, fits",
    [("1", 1), (" 1 ", 1), ("-0", 1), ("2147483648", 0), ("1e3", 0), ("1.0", 0), ("0x1", 0), ("１", 0), ("1_0", 0), ("+", 0)],
)
def test_integers(spark, text, fits):
    spec = LoadSpec.of({"columns": [{"name": "i", "type": "int", "onWrongType": "skip"}]})
    assert check(as_lines(spark, [text]), spec).good.count() == fits


def test_single_column_accepts_blank_lines(spark):
    spec = LoadSpec.of({"columns": [{"name": "i", "type": "int"}]})
    assert [r[0] for r in check(as_lines(spark, ["", "5"]), spec).good.collect()] == [None, 5]


@pytest.mark.parametrize(
    "line, found",
    [
        ("," * 30_000, 30_001),
        ('"' + "a" * 100_000 + '",b', 2),
        ('"' + '""' * 50_000 + '",b,c', 3),
        ("x" * 50_000, 1),
        ('"' + "a," * 50_000, 1),
    ],
)
def test_monstrous_lines_are_only_rejected(spark, line, found):
    checked = check(as_lines(spark, [line, "1,a,1,true"]), SPEC)
    assert checked.good.count() == 1
    row = checked.quarantine.first()
    assert row["fault"] == f"expected 4 columns, but found {found}."
    assert row["raw"] == line


def test_long_lines_of_right_width_are_kept(spark):
    line = '1,"' + "a,b" * 30_000 + '",1,true'
    assert check(as_lines(spark, [line]), SPEC).good.first()["name"] == "a,b" * 30_000


def test_every_projection_sees_width_faults(spark):
    checked = check(as_lines(spark, LINES), SPEC)
    assert checked.good.select("id").count() == checked.good.count() == 6
    assert checked.good.select(F.lit(1)).count() == 6


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(st.characters(blacklist_categories=("Cs", "Cc"))), min_size=1, max_size=5), min_size=1, max_size=20))
def test_width_of_quoted_lines(spark, rows):
    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(row)
        lines.append((out.getvalue(), len(row)))
    df = spark.createDataFrame(lines, "value string, n int")
    assert df.where(csv_width(F.col("value")) != F.col("n")).count() == 0


def test_line_numbers_do_not_depend_on_splits(spark, small_splits, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    for f in range(3):
        rows = [f"{n},{'x' * (n % 7)},1.5,true" for n in range(1, 200 + f)]
        (folder / f"file {f}+.csv").write_text("\n".join(rows) + "\n", encoding="utf-8")
    lines = read_lines(spark, str(folder))
    assert lines.select("block_start").distinct().count() > 20
    checked = check(lines, SPEC)
    rows = checked.with_line(checked.good_with("path", "file_name", "block_start", "row_id"))
    assert rows.where("line != id").count() == 0
    assert {r[0] for r in rows.select("file_name").distinct().collect()} == {f"file {f}+.csv" for f in range(3)}
    assert rows.count() == 199 + 200 + 201


def test_optional_folder(spark, tmp_path):
    (tmp_path / "customers" / "deep").mkdir(parents=True)
    (tmp_path / "customers" / "a.csv").write_text("1,a,1,true\n")
    (tmp_path / "customers" / "deep" / "b.csv").write_text("2,b,2,false\n3,c,3,true\n")
    (tmp_path / "products").mkdir()
    (tmp_path / "costs").mkdir()
    (tmp_path / "costs" / "zero.csv").write_text("")
    counts = {}
    for target in ("customers", "products", "costs", "absent"):
        located = locate(spark, str(tmp_path), target)
        good = check(located.lines, SPEC).good
        assert good.schema == SPEC.schema
        counts[target] = (located.found, good.count())
    assert counts == {"customers": (True, 3), "products": (False, 0), "costs": (False, 0), "absent": (False, 0)}


def test_staged_loads_read_their_input_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES))
    staged = check(read_lines(spark, str(tmp_path)), SPEC).stage(spark)
    for frame in (staged.good, staged.quarantine, staged.with_line(staged.quarantine), staged.file_stats):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "from_csv" not in plan
    staged.close()
