import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice.operators.access import current, most_specific, upsert
from sluice.operators.associate import around, around_any, nearest
from sluice.operators.monitor import (
    activities,
    activity_counts,
    activity_outputs,
    dataset_members,
    last_execution,
    listed_files,
    look_back,
    newest_first,
    page,
    page_after,
)
from sluice.operators.running import running_total
from sluice.operators.slices import arrivals, calendar, calendar_of, gap_report, readiness
from sluice.sources.files import changed_files
from sluice.sources.records import read_pipelines

DAY = datetime(2017, 5, 12)


def test_calendar_excludes_its_last_bound(spark):
    bounds = spark.createDataFrame([(DAY, DAY + timedelta(days=1))], "a timestamp, b timestamp")
    slices = calendar(bounds, "a", "b")
    assert slices.count() == 48
    first, last = slices.agg(F.min("slice_start"), F.max("slice_end")).first()
    assert (first, last) == (DAY, DAY + timedelta(days=1))
    assert calendar(bounds, "b", "a").count() == 0
    assert calendar(bounds, "a", "a").count() == 0


def test_gaps_and_readiness(spark):
    rows = [("c", 5), ("p", 10), ("c", 65), ("x", 66), ("p", 130), ("c", 131)]
    df = spark.createDataFrame([(d, DAY + timedelta(minutes=m)) for d, m in rows], "dataset string, ts timestamp")
    slices = calendar_of(df, "ts")
    gaps = {r["slice_end"]: (r["n"], r["missing"]) for r in gap_report(slices, arrivals(df, "ts")).collect()}
    at = lambda m: DAY + timedelta(minutes=m)
    assert gaps == {at(30): (2, False), at(60): (0, True), at(90): (2, False), at(120): (0, True), at(150): (2, False)}
    arrived = df.withColumn("slice_end", F.expr("window(ts, '30 minutes').end"))
    ready = {r["slice_end"]: (r["ready"], r["missing"]) for r in readiness(slices, arrived, "dataset", ["c", "p"]).collect()}
    assert ready == {
        at(30): (True, []),
        at(60): (False, ["c", "p"]),
        at(90): (False, ["p"]),
        at(120): (False, ["c", "p"]),
        at(150): (True, []),
    }


def test_running_total_over_chunks(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v")
    )
    got = running_total(df, ["g"], "o", "v", "before", F.expr("o div 50"))
    want = {i: sum(j % 7 for j in range(i % 3, i, 3)) for i in range(1000)}
    assert {r["o"]: r["before"] for r in got.collect()} == want


def test_associated_entries_equal_brute_force(spark):
    # A third of all entries share one moment; bucket edges are covered too.
    offsets = [0] * 200 + [300, 301, 299.999999, 600, 900.5, 1200, 1500, 1800.25, 2100] * 20 + list(range(0, 9000, 37))
    rows = [(i, DAY + timedelta(seconds=s), "x") for i, s in enumerate(offsets)]
    anchors = [(i, DAY + timedelta(seconds=s), "a") for i, s in enumerate([0, 0, 1, 300, 1499.5, 5000, 8999.9])]
    logs = spark.createDataFrame(rows, "id int, ts timestamp, k string")
    marks = spark.createDataFrame(anchors, "id int, ts timestamp, k string")
    got = sorted(r["id"] for r in around_any(logs, marks, "ts").collect())
    near = timedelta(minutes=5)
    assert got == [i for i, ts, _ in rows if any(abs(ts - a) <= near for _, a, _ in anchors)]
    single = sorted(r["id"] for r in around(logs, "ts", F.lit(anchors[4][1])).collect())
    assert single == [i for i, ts, _ in rows if abs(ts - anchors[4][1]) <= near]
    plan = around_any(logs, marks, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_look_back_reaches_the_scan(spark, tmp_path):
    where = str(tmp_path / "t")
    spark.createDataFrame([(DAY - timedelta(hours=h),) for h in range(200)], "ts timestamp").write.parquet(where)
    recent = look_back(spark.read.parquet(where), "ts", F.lit(DAY))
    assert recent.count() == 97
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan


def test_pages_by_key_and_by_name(spark):
    runs = spark.createDataFrame([(i, DAY + timedelta(minutes=i // 3)) for i in range(60)], "id int, ts timestamp")
    seen, got = None, []
    while rows := page_after(runs, "ts", "id", seen, size=25).collect():
        got += [r["id"] for r in rows]
        seen = (rows[-1]["ts"], rows[-1]["id"])
    assert got == [r["id"] for r in newest_first(runs, "ts", "id").collect()]
    files = spark.createDataFrame([(f"f{i:03}", i % 2) for i in range(300)], "name string, length int")
    listed = listed_files(files, F.lit("h"), F.lit("c"), F.lit("t"))
    assert listed.count() == 150
    names = [r["name"] for r in listed_files(files, F.lit("h"), F.lit("c"), F.lit("t"), most=2, after="f100").collect()]
    assert names == ["f101", "f103"]


def test_change_without_sequence_replaces_the_old_row(spark):
    schema = "account string, customer_id string, rights string, resource_group string, data_factory string, pipelines string"
    old = spark.createDataFrame([("a", "1", "old", "", "", ""), ("b", "1", "old", "", "", "")], schema)
    changes = [("a", "1", "new", "", "", "", None), ("b", "1", "none", "", "", "", None), ("b", "1", "five", "", "", "", 5)]
    got = upsert(old, spark.createDataFrame(changes, f"{schema}, sequence bigint"))
    assert {r["account"]: r["rights"] for r in got.collect()} == {"a": "new", "b": "five"}


@pytest.fixture
def pipelines(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        """{"name": "Normalize", "properties": {"start": "2017-05-11T00:00:00Z", "end": "2017-05-12T00:00:00Z",
        "activities": [
          {"name": "Copy", "type": "Copy", "inputs": [{"name": "ftp"}], "outputs": [{"name": "in"}]},
          {"name": "Run", "type": "Script", "inputs": [{"name": "in"}], "outputs": [{"name": "out"}, {"name": "in"}]},
          {"name": "Send", "type": "Copy", "inputs": [{"name": "out"}], "outputs": [{"name": "share"}]}]}}"""
    )
    return read_pipelines(spark, str(tmp_path), multi_line=True)


def test_activities_and_counts(spark, pipelines):
    steps = activities(pipelines)
    assert [(r["position"], r["activity"], r["next_activity"]) for r in steps.orderBy("position").collect()] == [
        (1, "Copy", "Run"),
        (2, "Run", "Send"),
        (3, "Send", None),
    ]
    slices = spark.createDataFrame(
        [("in", "Ready"), ("in", "Ready"), ("in", "Failed"), ("out", "InProgress"), ("out", "PendingExecution"), ("out", "None")],
        "dataset string, status string",
    )
    counts = activity_counts(activity_outputs(steps), slices)
    assert {r["activity"]: (r["success"], r["running"], r["failure"]) for r in counts.collect()} == {
        "Copy": (2, 0, 1),
        "Run": (2, 2, 1),
        "Send": (0, 0, 0),
    }
    members = dataset_members(activity_outputs(steps)).where("dataset = 'in'")
    assert sorted(r["activity"] for r in members.collect()) == ["Copy", "Run"]


def test_activities_need_no_shuffle(pipelines):
    assert "Exchange" not in activities(pipelines)._jdf.queryExecution().executedPlan().toString()


def test_last_execution_and_pages(spark):
    runs = spark.range(30).select(
        "id",
        F.concat(F.lit("d"), F.col("id") % 20).alias("dataset"),
        F.lit(DAY).alias("slice_start"),
        (F.lit(DAY) + F.make_dt_interval(secs=F.col("id"))).alias("processing_start"),
    )
    last = {r["dataset"]: (r["id"], r["view_all"]) for r in last_execution(runs, "id").collect()}
    assert last["d5"] == (25, True) and last["d15"] == (15, False)
    ordered = newest_first(runs, "processing_start", "id")
    assert [r["id"] for r in page(ordered, 10, 2).collect()] == list(range(19, 9, -1))
    with pytest.raises(ValueError):
        page(ordered, 11)


def _acl(spark, rows):
    schema = "account string, customer_id string, rights string, resource_group string, data_factory string, pipelines string, sequence bigint"
    return spark.createDataFrame([(a, c, r, "rg", "df", p, s) for a, c, r, p, s in rows], schema)


def test_access(spark):
    table = _acl(spark, [("@x.example", "X", "view", "a, b", 1), ("me@x.example", "M", "view, admin", "c", 1)])
    users = spark.createDataFrame([("me@x.example",), ("you@x.example",), ("i@y.example",)], "user_account string")
    got = {r["user_account"]: (r["customer_id"], r["rights"], r["pipelines"]) for r in most_specific(users, table).collect()}
    assert got == {
        "me@x.example": ("M", ["view", "admin"], ["c"]),
        "you@x.example": ("X", ["view"], ["a", "b"]),
    }
    changes = _acl(spark, [("@x.example", "X2", "view", "a", 5), ("@x.example", "X3", "view", "a", 7), ("@n.example", "N", "view", "a", 2)])
    after = {r["account"]: r["customer_id"] for r in upsert(table, changes).collect()}
    assert after == {"@x.example": "X3", "me@x.example": "M", "@n.example": "N"}
    assert {r["account"] for r in current(table.unionByName(changes)).collect()} == set(after)


def test_changed_files(spark):
    names = ["a-b-c-ls-x.json", "A-B-C-LS-Y.JSON", "a-b-c-zz-x.json", "a-ls.json", "a-b-c-ds-x.txt", "a-b-pl-q.json", "a-b-c-pl.json"]
    old = [("a-b-c-ls-old.json", DAY - timedelta(seconds=1))]
    files = spark.createDataFrame([(n, DAY) for n in names] + old, "name string, modified timestamp")
    got = {r["name"]: r["kind"] for r in changed_files(files, F.lit(DAY)).collect()}
    assert got == {"a-b-c-ls-x.json": "ls", "A-B-C-LS-Y.JSON": "ls"}
    third = {r["name"]: r["kind"] for r in changed_files(files, F.lit(DAY), part=2).collect()}
    assert third == {"a-b-pl-q.json": "pl"}


def test_nearest_entries_equal_brute_force(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    # Times on few whole seconds: many ties, and gaps of exactly the reach.
    rows = [(i, start + timedelta(seconds=rng.randrange(0, 4000, 20)), rng.random() < 0.1) for i in range(300)]
    rows += [(400 + i, None, i % 2 == 0) for i in range(4)]
    frame = spark.createDataFrame(rows, "id bigint, ts timestamp, bad boolean")
    got = {r.id: r for r in nearest(frame, "ts", "id", F.col("bad"), seconds=60).collect()}
    assert len(got) == len(rows)
    timed = sorted((t, i, bad) for i, t, bad in rows if t is not None)
    for at, (t, i, _) in enumerate(timed):
        before = next(((u, j) for u, j, bad in reversed(timed[:at]) if bad), None)
        after = next(((u, j) for u, j, bad in timed[at + 1 :] if bad), None)
        for found, other in ((got[i].before, before), (got[i].after, after)):
            gap = other and abs((other[0] - t) // timedelta(microseconds=1))
            assert (found and (found.id, found.gap)) == ((other[1], gap) if other and gap <= 60_000_000 else None)
    assert all(got[400 + i].before is None and got[400 + i].after is None for i in range(4))
