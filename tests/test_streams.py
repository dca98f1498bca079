"""Late rows and slice state: batches replayed, restarted and fed out of order."""

from datetime import datetime, timedelta

import pytest

from sluice.session import work_dir
from sluice.streaming.ingest import write_batches
from sluice.streaming.late import closed_slices, count_slices, slice_counts
from sluice.streaming.state import current_states, slice_states, use_state_store, write_states

START = datetime(2024, 1, 1)
SCHEMA = "id bigint, ts timestamp, slice_note string"


def minutes(n):
    return START + timedelta(minutes=n)


@pytest.fixture
def where(spark):
    return work_dir(spark, "streams-test")


def feed(spark, where, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{where}/in")


def count(spark, where, **more):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{where}/in")
    count_slices(stream, "ts", f"{where}/out", f"{where}/cp", once=True, **more).awaitTermination()


BATCHES = [
    [(1, minutes(5), "a"), (2, minutes(29), "a"), (3, minutes(30), "b"), (4, None, "no time")],
    # An hour after 00:30 nothing is closed yet; 02:10 closes all slices up to 01:10 for the next batch.
    [(5, minutes(10), "still open"), (6, minutes(130), "new")],
    [(7, minutes(10), "late"), (8, minutes(59), "late"), (9, minutes(61), "open"), (10, minutes(131), "new")],
    [(11, minutes(500), "far ahead")],
    [(12, minutes(131), "late now"), (13, minutes(439), "open"), (14, minutes(441), "open")],
]
# Slice ends in minutes: on time, late.  07:19 lies in the slice that ends at 07:30; the watermark of 07:20 has not passed it.
WANTED = {30: (3, 1), 60: (1, 1), 90: (1, 0), 150: (2, 1), 450: (2, 0), 510: (1, 0), None: (0, 1)}


def test_late_rows_are_kept_apart_and_counted(spark, where):
    for rows in BATCHES:
        feed(spark, where, rows)
        count(spark, where)
    got = {r.slice_end and int((r.slice_end - START).total_seconds() // 60): (r.n, r.late) for r in slice_counts(spark, f"{where}/out").collect()}
    assert got == WANTED
    closed = {r.slice_end: r.closed for r in slice_counts(spark, f"{where}/out").collect()}
    assert closed[minutes(150)] and not closed[minutes(450)] and not closed[None]
    late = spark.read.parquet(f"{where}/out/late")
    assert sorted(r.id for r in late.collect()) == [4, 7, 8, 12]
    marks = {r.id: r.watermark for r in late.collect()}
    assert marks[7] == minutes(70) and marks[12] == minutes(440) and marks[4] is None


def test_a_batch_run_again_comes_to_the_same_counts(spark, where):
    for rows in BATCHES[:3]:
        feed(spark, where, rows)
        count(spark, where)
    before = sorted(map(str, slice_counts(spark, f"{where}/out").collect()))
    # Forget that the last batch was committed, as after a crash behind its writes.
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(where).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in ("2", ".2.crc"):
        fs.delete(path(f"{where}/cp/commits/{name}"), False)
    count(spark, where)
    assert sorted(map(str, slice_counts(spark, f"{where}/out").collect())) == before


def test_counts_agree_with_the_watermark_of_the_engine(spark, where):
    for rows in BATCHES:
        feed(spark, where, [r for r in rows if r[1] is not None])
        count(spark, where)
        stream = spark.readStream.schema(SCHEMA).parquet(f"{where}/in")
        write_batches(closed_slices(stream, "ts"), lambda b: b, f"{where}/closed", f"{where}/cp2", once=True).awaitTermination()
    built_in = {r.slice_end: r.n for r in spark.read.parquet(f"{where}/closed").collect()}
    own = {r.slice_end: r.n for r in slice_counts(spark, f"{where}/out").where("closed").collect()}
    assert built_in == own


def test_other_delay_and_width(spark, where):
    for rows in BATCHES[:3]:
        feed(spark, where, rows)
        count(spark, where, minutes=60, delay=0)
    got = {r.slice_end: (r.n, r.late) for r in slice_counts(spark, f"{where}/out").where("slice_end is not null").collect()}
    assert got == {minutes(60): (4, 2), minutes(120): (0, 1), minutes(180): (2, 0)}


STATES = "dataset string, at timestamp, status string, id bigint"


def test_states_survive_a_restart_and_any_order(spark, where):
    use_state_store(spark)
    batches = [
        [("a", minutes(10), "Ready", 3), ("b", minutes(1), "Failed", 1), ("a", minutes(10), "Failed", 2), (None, minutes(2), "Ready", 9)],
        [("a", minutes(5), "InProgress", 1), ("b", minutes(2), None, 4), ("c", None, "Ready", 5)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(STATES).parquet(f"{where}/in")
        states = slice_states(stream, ["dataset"], "status", "at", "id")
        write_states(states, f"{where}/out", f"{where}/cp", once=True).awaitTermination()
    got = {r.dataset: (r.status, r.retries, r.updated) for r in current_states(spark, f"{where}/out", states.schema, ["dataset"]).collect()}
    assert got == {"a": ("Ready", 2, minutes(10)), "b": ("", 1, minutes(2)), None: ("Ready", 0, minutes(2))}


def test_states_expire(spark, where):
    use_state_store(spark)
    day = 24 * 60
    batches = [
        [("a", minutes(0), "Failed", 1), ("b", minutes(0), "Failed", 1)],
        [("b", minutes(4 * day), "Ready", 2)],
        # The watermark stands at day 2: a's state is gone, b's is kept.
        [("a", minutes(4 * day), "Ready", 3), ("b", minutes(4 * day + 1), "Ready", 4)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(STATES).parquet(f"{where}/in")
        states = slice_states(stream, ["dataset"], "status", "at", "id", expiry_days=2)
        write_states(states, f"{where}/out", f"{where}/cp", once=True).awaitTermination()
    got = {r.dataset: r.retries for r in current_states(spark, f"{where}/out", states.schema, ["dataset"]).collect()}
    assert got == {"a": 0, "b": 2}


def test_states_are_folded_without_a_call_a_key(spark, where):
    """A batch that runs again comes to the same states; no key is handed to Python, and old versions go."""
    schema = "dataset string, at timestamp, status string, id bigint"
    for n in range(4):
        rows = spark.range(300).selectExpr(
            "'d' || id % 100 as dataset", f"timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id + {n}) as at", "'s' || id as status", "id"
        )
        rows.coalesce(1).write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(schema).parquet(f"{where}/in")
        states = slice_states(stream, ["dataset"], "status", "at", "id")
        assert "Python" not in states._jdf.queryExecution().toString() and "InPandas" not in states._jdf.queryExecution().toString()
        write_states(states, f"{where}/out", f"{where}/cp", once=True).awaitTermination()
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(where).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in ("3", ".3.crc"):
        fs.delete(path(f"{where}/cp/commits/{name}"), False)
    write_states(states, f"{where}/out", f"{where}/cp", once=True).awaitTermination()
    got = current_states(spark, f"{where}/out", states.schema, ["dataset"]).collect()
    assert {(r.dataset, r.status, r.retries) for r in got} == {(f"d{i}", f"s{200 + i}", 11) for i in range(100)}
    assert {f.getPath().getName() for f in fs.listStatus(path(f"{where}/cp/slice-states"))} == {"batch=2", "batch=3"}
