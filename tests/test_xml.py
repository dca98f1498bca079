import re
import xml.etree.ElementTree as ET
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.xmlrows import PROCESSORS, StoreTypeError, store_losses, to_entries
from sluice.session import work_dir
from sluice.sinks.xmlfiles import part_rows, write_xml
from sluice.sources.files import list_files, non_empty
from sluice.sources.xml import parse_entry, read_entries, read_xml
from sluice.spec import SpecError, StoreSpec

SCALE = {"column": "scale", "type": "scale", "node": "Scale", "children": ["Scale_Quantity", "Scale_Value"]}


def texts(df):
    return [r["value"] for r in df.collect()]


def parts(folder):
    return [p.read_text(encoding="utf-8") for p in sorted(Path(folder).glob("part-*")) if p.stat().st_size]


def test_worked_example(spark, tmp_path):
    rows = [("Fabrikam", "20170611T0900", 21037), ("ACME Corp", "20170611T0800", 17635)]
    df = spark.createDataFrame(rows, "customer_name string, submission_date string, amount int").coalesce(1)
    stored = write_xml(df, str(tmp_path / "out"), StoreSpec.named())
    assert stored.rows == 2
    (text,) = parts(stored.path)
    root = ET.fromstring(text)
    assert root.tag == "root"
    assert [[(e.tag, e.text) for e in entry] for entry in root] == [
        [("customer_name", n), ("submission_date", d), ("amount", str(a))] for n, d, a in rows
    ]


def test_scale_becomes_repeated_nodes(spark):
    df = spark.createDataFrame([("(4,4.54;6,7894.00;3,479.79)",), (None,)], "scale string")
    spec = StoreSpec.of({"entry": "data", "processors": [SCALE]})
    first, second = texts(to_entries(df, spec))
    nodes = ET.fromstring(first)
    assert [(n.tag, [(c.tag, c.text) for c in n]) for n in nodes] == [
        ("Scale", [("Scale_Quantity", q), ("Scale_Value", v)])
        for q, v in (("4", "4.54"), ("6", "7894.00"), ("3", "479.79"))
    ]
    assert list(ET.fromstring(second)) == []


def test_nulls_and_types(spark):
    schema = "b boolean, i int, l bigint, f float, d double, s string, x binary, n void, e string, _u string"
    row = (True, 1, 2**40, 0.5, 1e10, None, "é".encode(), None, "", "under")
    (text,) = texts(to_entries(spark.createDataFrame([row], schema), StoreSpec.named()))
    found = {e.tag: e.text for e in ET.fromstring(text)}
    assert found == {
        "b": "true", "i": "1", "l": str(2**40), "f": "0.5", "d": "1.0E10", "x": "é", "e": None, "_u": "under",
    }


@pytest.mark.parametrize(
    "kind, code",
    [
        (T.MapType(T.StringType(), T.StringType()), 2107),
        (T.ArrayType(T.StringType()), 2107),
        (T.StructType([T.StructField("a", T.StringType())]), 2107),
        (T.TimestampType(), 2108),
        (T.DateType(), 2108),
        (T.DecimalType(10, 2), 2108),
    ],
)
def test_types_without_text_are_refused(spark, kind, code):
    df = spark.createDataFrame([], T.StructType([T.StructField("c", kind)]))
    with pytest.raises(StoreTypeError) as refused:
        to_entries(df, StoreSpec.named())
    assert refused.value.code == code


def test_config_errors(spark):
    df = spark.createDataFrame([("x",)], "`a b` string")
    with pytest.raises(SpecError):
        to_entries(df, StoreSpec.named())
    other = spark.createDataFrame([("x",)], "scale string")
    with pytest.raises(SpecError):
        to_entries(other, StoreSpec.of({"entry": "e", "processors": [{**SCALE, "type": "matrix"}]}))
    with pytest.raises(SpecError):
        to_entries(other, StoreSpec.of({"entry": "e", "processors": [{**SCALE, "column": "other"}]}))


NASTY = [
    "<a href=\"x\">'&'</a>",
    "]]>",
    "tab\tline\nreturn\rboth\r\nend",
    " spaces around ",
    "日本語 ünï 🎉",
    "</e>",
    "</e>\n",
    "next\u0085line\u2028separator\u007f\u009f",
    "\u00a0\ufeff",
    "",
    None,
]


def test_awkward_text_survives_files(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(NASTY)), "n int, t string")
    spec = StoreSpec.of({"root": "r", "entry": "e"})
    out = write_xml(df, str(tmp_path / "out"), spec, files=3).path
    assert all(len(text.splitlines()) >= 3 for text in parts(out))
    for reader in (read_entries, read_xml):
        back = {r["n"]: r["t"] for r in reader(spark, out, df.schema, "e").collect()}
        assert {n: t or None for n, t in back.items()} == {n: t or None for n, t in enumerate(NASTY)}


def test_forbidden_characters_are_dropped_and_counted(spark):
    df = spark.createDataFrame([("a\x01b\x0bc￾",), ("fine",)], "t string")
    entries = texts(to_entries(df, StoreSpec.named()))
    assert [ET.fromstring(e)[0].text for e in entries] == ["abc", "fine"]
    assert tuple(store_losses(df, StoreSpec.named()).first()) == (3, 0)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=30), min_size=1, max_size=25))
def test_any_text_parses_back(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "n int, t string")
    entries = to_entries(df, StoreSpec.named())
    assert all(len(e.split("\n")) == 1 for e in texts(entries))
    want = {n: re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "", t) for n, t in enumerate(values)}
    assert {int(x[0].text): x[1].text or "" for x in map(ET.fromstring, texts(entries))} == want
    parsed = entries.select(F.inline(F.array(parse_entry(F.col("value"), df.schema))))
    assert {r["n"]: r["t"] or "" for r in parsed.collect()} == want


def test_own_processor(spark, monkeypatch):
    def flag(text, spec):
        return F.struct(*[text.contains(c).cast("string").alias(c) for c in spec.children])

    monkeypatch.setitem(PROCESSORS, "flags", flag)
    spec = StoreSpec.of(
        {"entry": "e", "processors": [{"column": "t", "type": "flags", "node": "Has", "children": ["a", "b"]}]}
    )
    df = spark.createDataFrame([("xa",)], "t string")
    assert texts(to_entries(df, spec)) == ["<e><Has><a>true</a><b>false</b></Has></e>"]


def test_all_null_rows_survive(spark, tmp_path):
    df = spark.createDataFrame([(None,), ("x",)], "t string")
    out = write_xml(df, str(tmp_path / "out"), StoreSpec.named()).path
    assert sorted(str(r["t"]) for r in read_entries(spark, out, df.schema, "entry").collect()) == ["None", "x"]


def test_root_may_share_the_name_of_the_entry(spark, tmp_path):
    out = write_xml(spark.range(5), str(tmp_path / "out"), StoreSpec.named("e", "e"), files=1).path
    assert sorted(r["id"] for r in read_entries(spark, out, "id bigint", "e").collect()) == list(range(5))
    assert part_rows(spark, out, "e").first()["rows"] == 5


def test_envelope_wraps_each_file_and_no_empty_one(spark, tmp_path):
    spec = StoreSpec.of(
        {"root": "rows", "entry": "row", "pre": ['<?xml version="1.0"?>', "<env>"], "post": ["</env>"]}
    )
    df = spark.range(10).repartition(4, F.lit(1))
    out = write_xml(df, str(tmp_path / "out"), spec).path
    (text,) = parts(out)
    tree = ET.fromstring(text)
    assert (tree.tag, tree[0].tag, len(tree[0])) == ("env", "rows", 10)
    spread = write_xml(spark.range(100), str(tmp_path / "many"), spec, files=5)
    sizes = [len(ET.fromstring(t)[0]) for t in parts(spread.path)]
    assert (len(sizes), sum(sizes)) == (5, 100) and min(sizes) > 10
    assert part_rows(spark, spread.path, "row").agg(F.sum("rows")).first()[0] == spread.rows == 100


def test_no_rows_no_envelope(spark, tmp_path):
    stored = write_xml(spark.range(0), str(tmp_path / "out"), StoreSpec.named())
    assert stored.rows == 0
    assert parts(stored.path) == []


def test_output_is_never_overwritten(spark, tmp_path):
    write_xml(spark.range(1), str(tmp_path / "out"), StoreSpec.named())
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_xml(spark.range(1), str(tmp_path / "out"), StoreSpec.named())


def test_no_shuffle_and_one_render(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("a"))
    plan = to_entries(df, StoreSpec.named())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_formatted_dates_and_decimals_are_accepted(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2), Decimal("1.50"))], "t timestamp, d decimal(5,2)")
    shown = df.select(F.date_format("t", "yyyy").alias("t"), F.col("d").cast("string").alias("d"))
    assert texts(to_entries(shown, StoreSpec.of({"entry": "e"}))) == [
        "<e><t>2024</t><d>1.50</d></e>"
    ]


def test_compressed_files_hold_the_same_entries(spark):
    """The store spec names a codec: files are smaller and read back alike, envelope and all; none is the default."""
    rows = spark.range(2000).selectExpr("id", "concat('name < ', id) as name")
    sizes = {}
    for codec in ("", "gzip"):
        spec = StoreSpec.of({"root": "root", "entry": "data", "compression": codec})
        where = work_dir(spark, "compressed")
        assert write_xml(rows, where, spec).rows == 2000
        files = non_empty(list_files(spark, where, "part-*")).collect()
        assert all(f["name"].endswith(".gz") == bool(codec) for f in files)
        sizes[codec] = sum(f["length"] for f in files)
        back = read_entries(spark, where, "id bigint, name string", "data")
        assert sorted(back.collect()) == sorted(rows.collect())
    assert 4 * sizes["gzip"] < sizes[""]
