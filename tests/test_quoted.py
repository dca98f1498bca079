"""Records of several lines over splits of a few bytes, against one pass over each file."""

import random

import pytest
from pyspark.errors import PythonException

from sluice.operators.loadlog import load_log
from sluice.operators.validate import check
from sluice.sources.lines import read_lines
from sluice.sources.quoted import quoted_records
from sluice.spec import LoadSpec
from pyspark.sql import functions as F


def by_hand(text):
    """(line, record, value) of each record of a file's text."""
    out, held, first = [], [], 1
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
    for at, line in enumerate(lines, 1):
        if not held:
            first = at
        held.append(line)
        if sum(h.count('"') for h in held) % 2 == 0:
            out.append((first, len(out), "\n".join(held)))
            held = []
    if held:
        out.append((first, len(out), "\n".join(held)))
    return out


def files(tmp_path, texts):
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.csv").write_text(text)
    return str(tmp_path)


def sample(seed):
    rng = random.Random(seed)
    parts = ["a", "é,", '"', '""', "\n", "\n", "long " * 9, '"x\ny"', "1,2\n"]
    return "".join(rng.choices(parts, k=rng.randrange(400)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_one_pass_over_each_file(spark, small_splits, tmp_path, seed):
    texts = [sample(seed * 10 + i) for i in range(4)] + ["", "\n", 'open "\nto the\nend', "plain\n" * 50, '"' + "\n" * 300 + '"\nafter\n']
    lines = read_lines(spark, files(tmp_path, texts))
    assert lines.rdd.getNumPartitions() > 20
    got = {}
    for r in quoted_records(lines).collect():
        got.setdefault(r.file_name, []).append((r.line, r.record, r.value))
    wanted = {f"f{i}.csv": by_hand(t) for i, t in enumerate(texts) if by_hand(t)}
    assert {k: sorted(v) for k, v in got.items()} == wanted


def test_batches_smaller_than_a_record(spark, tmp_path):
    text = 'a,"' + "\n" * 40 + '"\nb\n' * 3
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = quoted_records(read_lines(spark, files(tmp_path, [text])))
        assert sorted((r.line, r.record, r.value) for r in found.collect()) == by_hand(text)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_unclosed_quote_is_named(spark, tmp_path):
    where = files(tmp_path, ["fine\n" + '"never\n' + "closed\n" * 100])
    with pytest.raises(PythonException, match="not closed within 50 characters: .*f0.csv, line 2"):
        quoted_records(read_lines(spark, where), limit=50).collect()


def test_unclosed_quote_over_splits_is_named(spark, small_splits, tmp_path):
    where = files(tmp_path, ["fine\n" + '"never\n' + "closed\n" * 100])
    with pytest.raises(Exception, match="not closed within 90 characters: .*f0.csv, line 2"):
        quoted_records(read_lines(spark, where), limit=90).collect()


def test_checked_load_and_log_of_records(spark, small_splits, tmp_path):
    where = files(tmp_path, ['1,"two\nlines"\nx,"bad\n\none"\n3,"a ""q"" b"\n4\n'])
    columns = [{"name": "n", "type": "int", "onWrongType": "skip"}, {"name": "note", "type": "string", "onWrongType": "skip"}]
    spec = LoadSpec.of({"onWrongColumnCount": "skip", "columns": columns})
    checked = check(quoted_records(read_lines(spark, where)), spec).stage(spark)
    assert sorted(tuple(r) for r in checked.good.collect()) == [(1, "two\nlines"), (3, 'a "q" b')]
    log = [r.message for r in load_log(checked, "i", "j", F.current_timestamp()).orderBy("log_index").collect()]
    assert log[1:3] == [
        "[f0.csv, line:3, column:0]: an integer was expected, but the value was 'x'.",
        "[f0.csv, line:7]: expected 2 columns, but found 1.",
    ]
    assert "4 row(s) read; 2 row(s) skipped" in log[3]
    checked.close()
