"""Tables that are kept and brought up to date: listings, counts, access parts, buckets."""

import os
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluice.operators.access import FIELDS, most_specific
from sluice.operators.monitor import slice_runs, status_counts
from sluice.operators.rollup import add_runs, dataset_counts, refresh
from sluice.sinks import accesstable
from sluice.sinks.tables import write_buckets
from sluice.sources import snapshots
from sluice.sources.files import LISTING

DAY = datetime(2024, 3, 1)


def changes(frame, key="path"):
    return {r[key].rsplit("/", 1)[1]: r["change"] for r in frame.collect()}


def test_listings_of_files(spark, tmp_path):
    root, store = tmp_path / "in", str(tmp_path / "store")
    assert snapshots.versions(spark, store) == []
    assert snapshots.take(spark, str(root), store) == 1
    for name in ("same", "longer", "touched", "gone"):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_text(name)
    # Roots that overlap list a file once.
    assert snapshots.take(spark, [str(root), str(root)], store) == 2
    (root / "longer").write_text("longer than before")
    (root / "gone").unlink()
    (root / "new ü.txt").write_text("x")
    # The same length at another time.
    stat = (root / "touched").stat()
    os.utime(root / "touched", (stat.st_atime + 5, stat.st_mtime + 5))
    assert snapshots.take(spark, str(root), store) == 3
    none, old, new = (snapshots.read(spark, store, v) for v in (1, 2, 3))
    assert none.count() == 0 and old.count() == 4
    assert set(changes(snapshots.diff(none, old)).values()) == {"new"}
    found = changes(snapshots.diff(old, new))
    assert len(found) == 4 and sorted(found.values()) == ["changed", "changed", "new", "removed"]
    assert (found["longer"], found["touched"], found["gone"]) == ("changed", "changed", "removed")
    assert snapshots.diff(new, new).count() == 0
    assert snapshots.read(spark, store, 0).count() == 0
    folders = snapshots.by_folder(new).collect()
    assert [(r.files, r.folder.rsplit("/", 1)[1]) for r in folders] == [(4, "in")]
    # A write that broke off is no version, and the next one replaces it.
    (Path(store) / "version=0000000003" / "_SUCCESS").unlink()
    assert snapshots.versions(spark, store) == [1, 2]
    assert snapshots.take(spark, str(root), store) == 3
    assert snapshots.read(spark, store, 3).count() == 4
    snapshots.keep_last(spark, store, 1)
    assert snapshots.versions(spark, store) == [3]
    with pytest.raises(ValueError):
        snapshots.keep_last(spark, store, 0)


def test_files_past_the_mark(spark):
    later = DAY + timedelta(seconds=1)
    seen = spark.createDataFrame([("a", "a", 1, DAY - timedelta(days=1)), ("b", "b", 1, DAY)], LISTING)
    rows = [("a", "a", 1, DAY - timedelta(days=1)), ("b", "b", 1, DAY), ("c", "c", 1, DAY), ("d", "d", 1, later)]
    rows.append(("old", "old", 1, DAY - timedelta(days=2)))
    files = spark.createDataFrame(rows, LISTING)
    assert {r.path for r in snapshots.past_mark(files, seen).collect()} == {"c", "d"}
    assert {r.path for r in snapshots.diff(seen, files).collect()} == {"c", "d", "old"}
    assert snapshots.past_mark(files, files.where("false")).count() == 5


RUN = "dataset string, slice_start timestamp, id bigint, status string"


def counted(frame):
    return {r.dataset: (r.success, r.running, r.failure) for r in frame.collect()}


def test_counts_follow_touched_days_only(spark, tmp_path):
    runs, counts = str(tmp_path / "runs"), str(tmp_path / "counts")
    first = [("a", DAY + timedelta(hours=h), h, "InProgress") for h in range(0, 96, 6)]
    first += [("b", DAY, 900, "Failed"), ("c", None, 901, "Ready"), (None, DAY, 902, "Ready"), ("b", DAY, 903, None)]
    add_runs(spark.createDataFrame(first, RUN), runs, 1)
    assert refresh(spark, runs, counts, 1) == ["20240301", "20240302", "20240303", "20240304", None]
    assert counted(dataset_counts(spark, counts)) == counted(status_counts(spark.createDataFrame(first, RUN), "dataset"))
    # Files of days that the next batch doesn't touch are never opened.
    for day in ("20240301", "20240302", "20240304"):
        for file in (tmp_path / "runs" / f"slice_date={day}").rglob("*.parquet"):
            file.write_bytes(b"broken")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "counts").rglob("*.parquet")}
    third = [("a", DAY + timedelta(hours=h), h, "Ready") for h in (48, 54)] + [("d", DAY + timedelta(hours=50), 1000, "Failed")]
    for _ in range(2):  # A batch stored and counted again changes nothing.
        add_runs(spark.createDataFrame(third, RUN), runs, 2)
        assert refresh(spark, runs, counts, 2) == ["20240303"]
    assert counted(dataset_counts(spark, counts)) == {
        "a": (2, 14, 0), "b": (0, 0, 1), "c": (1, 0, 0), None: (1, 0, 0), "d": (0, 0, 1),
    }
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "counts").rglob("*.parquet")}
    assert {f for f in before if "20240303" not in str(f)} <= set(after)
    assert all(after[f] == before[f] for f in before if "20240303" not in str(f))
    assert refresh(spark, runs, counts, 7) == []


def access_rows(spark, rows):
    return spark.createDataFrame(
        [(a, c, "view", "rg", "df", "p", s) for a, c, s in rows],
        "account string, " + ", ".join(f"{f} string" for f in FIELDS) + ", sequence bigint",
    )


def test_access_parts(spark, tmp_path):
    where, parts = str(tmp_path / "access"), 8
    scanned = lambda: {r.account: r.customer_id for r in accesstable.scan(spark, where).collect()}
    assert scanned() == {}
    assert accesstable.compact(spark, where) == []
    base = [(f"user{i}", "old", 1) for i in range(100)] + [(None, "nobody", 1)]
    accesstable.add_changes(access_rows(spark, base), where, 0, parts)
    assert accesstable.compact(spark, where) == list(range(parts))
    assert len(scanned()) == 101
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "access" / "merged").rglob("*.parquet")}
    later = [("user7", "second", 2), ("user7", "first", 1), ("user8", "unnumbered", None)]
    accesstable.add_changes(access_rows(spark, later), where, 1, parts)
    accesstable.add_changes(access_rows(spark, [("user7", "third", 3)]), where, 2, parts)
    want = {**{a: c for a, c, _ in base}, "user7": "third"}
    assert scanned() == want
    kept = tmp_path / "kept"
    shutil.copytree(tmp_path / "access" / "changes", kept)
    touched = accesstable.compact(spark, where, until=1)
    assert 1 <= len(touched) <= 2 and scanned() == want
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "access" / "merged").rglob("*.parquet")}
    outside = {f for f in files if not any(f"part={p}/" in str(f) for p in touched)}
    assert outside <= set(now) and all(now[f] == files[f] for f in outside)
    # As after a merge whose batches were not deleted.
    shutil.copytree(kept, tmp_path / "access" / "changes", dirs_exist_ok=True)
    assert scanned() == want
    accesstable.compact(spark, where)
    assert scanned() == want


def test_a_crowded_domain_is_split(spark):
    users = spark.range(5000).select(
        F.concat(F.lit("u"), "id", F.when(F.col("id") % 10 < 9, "@crowd.x").otherwise(F.lit("@small.x"))).alias("user_account")
    )
    users = users.unionByName(spark.createDataFrame([("u1@crowd.x",)] * 3 + [(None,), ("nodomain",)], "user_account string"))
    rows = [("@crowd.x", "crowd", 0), ("@small.x", "small", 0), ("u1@crowd.x", "own", 0), (None, "nobody", 0)]
    chosen = most_specific(users, access_rows(spark, rows), parts=16)
    found = {r.user_account: r.customer_id for r in chosen.collect()}
    assert len(found) == 5000 and found["u1@crowd.x"] == "own"
    assert sum(c == "crowd" for c in found.values()) == 4499
    assert sum(c == "small" for c in found.values()) == 500
    # No task of the join gets more than a small share of the crowd.
    dealt = users.distinct().where("user_account like '%crowd.x'").select(F.pmod(F.xxhash64("user_account"), F.lit(16)).alias("part"))
    shares = [r["count"] for r in dealt.groupBy("part").count().collect()]
    assert len(shares) == 16 and max(shares) < 2 * 4500 / 16
    assert users.limit(0).select("user_account").transform(lambda u: most_specific(u, access_rows(spark, rows))).count() == 0


def test_buckets_join_without_exchange(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = spark.range(200).selectExpr("concat('d', id % 7) dataset", "timestamp_seconds(1800 * (id % 20)) slice_start", "id")
        slices = runs.select("dataset", "slice_start").distinct().union(spark.sql("select 'none', timestamp_seconds(0)"))
        stored = [
            write_buckets(f, f"t_{n}_{tmp_path.name.replace('-', '_')}", str(tmp_path / n), 4, "dataset", "slice_start")
            for n, f in (("slices", slices), ("runs", runs))
        ]
        joined = slice_runs(*stored)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        key = lambda r: (r.dataset, r.slice_start, r.id if r.id is not None else -1)
        assert sorted(joined.collect(), key=key) == sorted(slice_runs(slices, runs).collect(), key=key)
        assert joined.count() == 201
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
