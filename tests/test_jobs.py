"""Load log, whole jobs, delivery and streams on small files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.operators.loadlog import MORE_SKIPPED, LoadFailed, load_log, next_index
from sluice.operators.validate import check
from sluice.plans.normalize import (
    FEED_SPEC,
    MissingInput,
    Run,
    normalize_local,
    store_entities,
    store_slice,
)
from sluice.sinks.deliver import DeliveryFailed, deliver, manifest, post_xml, sending
from sluice.sinks.tables import append_log, export_instance, read_log, write_slices
from sluice.sinks.xmlfiles import write_xml
from sluice.sources.files import list_files
from sluice.sources.lines import entity_of, read_declared, read_lines, slice_of
from sluice.sources.xml import read_entries
from sluice.spec import LoadSpec, StoreSpec
from sluice.streaming.ingest import ingest, line_stream

NOW = datetime(2024, 2, 1, 13, 30)
GOOD = "1,segment,10,Fabrikam,X,Place,rep,20170611 09:00:00,4,4.54,6,7894.00"
EXPECTED_SCALE = [("4", "4.54"), ("6", "7894.00")]


def feed(tmp_path, target, files):
    folder = tmp_path / "root" / target
    folder.mkdir(parents=True)
    for name, lines in files.items():
        (folder / name).write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return str(tmp_path / "root")


def log_of(spark, path):
    rows = read_log(spark, path).orderBy("log_index").collect()
    assert [r["log_index"] for r in rows] == list(range(len(rows)))
    return [(r["level"], r["message"]) for r in rows]


def test_store_slice(spark, tmp_path, small_splits):
    bad = [GOOD.replace("1,", "one,", 1)] * 30
    root = feed(tmp_path, "customer-csv", {"a.csv": [GOOD, GOOD], "b.csv": [GOOD, *bad, GOOD], "c.csv": []})
    out, log = str(tmp_path / "xml"), str(tmp_path / "log")
    stored, _ = store_slice(spark, root, "customer-csv", out, log, Run("ACME-N-20240201T1330", "job", NOW))
    assert stored.rows == 4
    schema = "CUSTOMER_ID int, Extraction_Time string, Scale array<struct<Scale_Quantity: string, Scale_Value: string>>"
    rows = read_entries(spark, out, schema, "data").collect()
    assert {(r[0], r[1]) for r in rows} == {(10, "2017-06-11 09:00:00")}
    assert [tuple(s) for s in rows[0]["Scale"]] == EXPECTED_SCALE
    entries = log_of(spark, log)
    assert entries[:2] == [("INFO", "run id = job"), ("INFO", "/customer-csv found to contain file(s).")]
    assert entries[2:4] == [
        ("INFO", "Started reading from file: a.csv."),
        ("INFO", "Completed reading from file: a.csv; 2 row(s) read; 0 row(s) skipped."),
    ]
    skips = [m for level, m in entries if level == "SKIP"]
    assert skips[0] == "[b.csv, line:2, column:0]: an integer was expected, but the value was 'one'."
    assert skips[20].startswith("[b.csv, line:22,")
    assert skips[21:] == [MORE_SKIPPED]
    assert entries[-1] == ("INFO", "Completed reading from file: b.csv; 32 row(s) read; 30 row(s) skipped.")


def test_required_and_optional_folders(spark, tmp_path):
    end = datetime(2024, 2, 1, 13, 30)
    root, log = str(tmp_path / "root"), str(tmp_path / "log")
    feed(tmp_path, "input-202402011330/customers", {"a.csv": [GOOD]})

    def go(**folders):
        return store_entities(spark, root, end, log, Run("i", "j", NOW), **folders)

    with pytest.raises(MissingInput, match="products"):
        go(required=["customers", "products"])
    assert not (tmp_path / "log").exists()
    stored = go(required=["customers"], optional=["products"])
    assert {e: s.rows for e, s in stored.items()} == {"customers": 1, "products": 0}
    assert stored["customers"].path.endswith("/output-202402011330/process-202402011330/customers")
    jobs = read_log(spark, log).groupBy("job_id").count().collect()
    assert {r["job_id"]: r["count"] for r in jobs} == {"j-customers": 4, "j-products": 2}


def test_missing_target(spark, tmp_path):
    root = feed(tmp_path, "other", {})
    out, log = str(tmp_path / "xml"), str(tmp_path / "log")
    stored, _ = store_slice(spark, root, "customer-csv", out, log, Run("i", "job", NOW), empty="empty")
    assert stored.rows == 0
    assert log_of(spark, log) == [
        ("INFO", "run id = job"),
        ("INFO", "/customer-csv does not exist or is empty; using /empty."),
    ]


def test_fail_policy_logs_then_stops(spark, tmp_path):
    columns = [{"name": "i", "type": "int", "onWrongType": "skip"}, {"name": "d", "type": "double"}]
    spec = LoadSpec.of({"columns": columns, "onWrongColumnCount": "skip"})
    root = feed(tmp_path, "in", {"a.csv": ["1,1", "x,1", "2,y", "z,1", "3,w"]})
    out, log = str(tmp_path / "xml"), str(tmp_path / "log")
    with pytest.raises(LoadFailed, match="line:3, column:1.*'y'"):
        store_slice(spark, root, "in", out, log, Run("i", "j", NOW), spec, StoreSpec.named(), lambda df: df)
    assert not (tmp_path / "xml").exists()
    assert [level for level, _ in log_of(spark, log)] == ["INFO", "INFO", "INFO", "SKIP", "FAIL"]


def test_default_policies_fail_on_width(spark, tmp_path):
    spec = LoadSpec.of({"columns": [{"name": "i", "type": "int"}, {"name": "j", "type": "int"}]})
    root = feed(tmp_path, "in", {"a.csv": ["1,2", "1"]})
    with pytest.raises(LoadFailed, match="expected 2 columns, but found 1"):
        store_slice(
            spark, root, "in", str(tmp_path / "x"), str(tmp_path / "l"), Run("i", "j", NOW), spec,
            StoreSpec.named(), lambda df: df,
        )


def test_log_table_is_pruned_by_instance(spark, tmp_path):
    root = feed(tmp_path, "in", {"a.csv": [GOOD]})
    log = load_log(check(read_lines(spark, root), FEED_SPEC), "one", "j", F.lit(NOW))
    path = str(tmp_path / "log")
    append_log(log, path)
    append_log(log.withColumn("instance_id", F.lit("two")), path)
    table = read_log(spark, path)
    plan = table.where("instance_id = 'two'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(instance_id" in plan
    assert {r[0]: r[1] for r in next_index(table).collect()} == {"one": 2, "two": 2}
    export_instance(table, "two", str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["index", "timestamp", "level", "message"]
    assert sorted(r["index"] for r in back.collect()) == ["j-0000", "j-0001"]


def test_small_feed(spark, tmp_path):
    lines = [f"5312586,{p},61.72,10022017,1092017" for p in ("84327", "84328", "84329", "pig", "84331", "84332")]
    (tmp_path / "six.csv").write_text("\n".join(lines))
    schema = "customer string, product string, discount float, startdate string, enddate string"
    rows = normalize_local(read_declared(spark, str(tmp_path), schema), F.lit(NOW)).collect()
    assert len(rows) == 6
    assert {r["cp"] for r in rows} >= {"5312586/pig"}
    assert {(r["start"], r["end"], r["current"], r["ppa"]) for r in rows} == {
        ("2017-10-02 00:00:00", None, "2024-02-01 13:30:00", "PP01")
    }


def test_folders_give_entity_and_slice(spark, tmp_path):
    folder = tmp_path / "input-201706110800" / "customers"
    folder.mkdir(parents=True)
    (folder / "CUSTOMER_1.csv").write_text("a\n")
    (folder / "PRODUCT_1.csv").write_text("b\n")
    lines = read_lines(spark, str(tmp_path), "CUSTOMER*")
    row = lines.select("value", entity_of(F.col("path")).alias("e"), slice_of(F.col("path")).alias("s")).collect()
    assert [tuple(r) for r in row] == [("a", "customers", datetime(2017, 6, 11, 8, 0))]


def test_listing_skips_missing_roots(spark, tmp_path):
    (tmp_path / "a.txt").write_text("12345")
    files = list_files(spark, [str(tmp_path), str(tmp_path / "nope")])
    assert [(r["name"], r["length"]) for r in files.collect()] == [("a.txt", 5)]


def test_slices_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(1, datetime(2024, 1, 1, 12, 0)), (2, datetime(2024, 1, 1, 12, 30))]
    df = spark.createDataFrame(rows, "n int, slice_end timestamp")
    write_slices(df, path, "slice_end")
    write_slices(df.where("n = 2").withColumn("n", F.lit(9)), path, "slice_end")
    assert (tmp_path / "out" / "slice_date=20240101" / "slice_time=1230").is_dir()
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 9]


def test_delivery_resumes_after_a_failure(spark, tmp_path):
    out, ledger, sent = str(tmp_path / "out"), str(tmp_path / "ledger"), tmp_path / "sent"
    sent.mkdir()
    write_xml(spark.range(40), out, StoreSpec.named(), files=4)
    steps = ("post {file}", "done {file}")
    assert manifest(spark, out, steps).count() == 8
    target = str(sent)

    def flaky(path, command):
        if "part-00002" in path:
            raise RuntimeError("refused")
        with open(f"{target}/{path.rsplit('/', 1)[1]}-{command.split()[0]}", "x"):
            pass

    with pytest.raises(DeliveryFailed, match="refused"):
        deliver(spark, out, ledger, flaky, steps)
    assert len(list(sent.iterdir())) == 6

    def steady(path, command):
        with open(f"{target}/{path.rsplit('/', 1)[1]}-{command.split()[0]}", "x"):
            pass

    outcome = deliver(spark, out, ledger, steady, steps)
    assert outcome.where("delivered").count() == 8
    assert len(list(sent.iterdir())) == 8
    deliver(spark, out, ledger, flaky, steps)  # nothing is left to send


def test_files_are_streamed_to_the_service(tmp_path):
    calls = []

    class Answer:
        __enter__ = __exit__ = lambda *args: None

    def opener(request):
        calls.append((request.full_url, request.method, request.data.read().decode(), request.headers["Content-type"]))
        return Answer()

    (tmp_path / "a b.txt").write_text("<e>é</e>", encoding="utf-8")
    action = sending(lambda url, body: post_xml(url, body, opener))
    action(f"file://{tmp_path}/a%20b.txt", "https://host.example/put")
    assert calls == [("https://host.example/put", "POST", "<e>é</e>", "text/xml; charset=utf-8")]


def test_stream_picks_up_only_new_files(spark, tmp_path):
    spec = LoadSpec.of({"onWrongColumnCount": "skip", "columns": [{"name": "i", "type": "int", "onWrongType": "skip"}, {"name": "s", "type": "string"}]})
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = line_stream(spark, str(source))
        ingest(stream, spec, lambda good: good, out, checkpoint, once=True).awaitTermination()
        good = spark.read.parquet(f"{out}/good").count()
        return good, spark.read.parquet(f"{out}/quarantine").count()

    (source / "a.csv").write_text("1,a\nx,b\n2,c\n")
    assert run() == (2, 1)
    assert run() == (2, 1)
    (source / "b.csv").write_text("3,d\n4\n")
    assert run() == (3, 2)
    faults = spark.read.parquet(f"{out}/quarantine").select("file_name", "line", "batch").collect()
    assert sorted(tuple(r) for r in faults) == [("a.csv", 2, 0), ("b.csv", 2, 1)]
    log = spark.read.parquet(f"{out}/log").orderBy("job_id", "log_index").collect()
    assert [(r["job_id"], r["level"]) for r in log] == [
        (f"batch-{b}", level) for b in (0, 1) for level in ("INFO", "SKIP", "INFO")
    ]


def test_stream_stops_on_a_failing_line(spark, tmp_path):
    spec = LoadSpec.of({"columns": [{"name": "i", "type": "int"}]})
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("1\nx\n")
    query = ingest(line_stream(spark, str(source)), spec, lambda g: g, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    with pytest.raises(Exception, match="an integer was expected"):
        query.awaitTermination()
    assert not (tmp_path / "out" / "good").exists()
    levels = [r["level"] for r in spark.read.parquet(str(tmp_path / "out" / "log")).orderBy("log_index").collect()]
    assert levels == ["INFO", "FAIL"]
