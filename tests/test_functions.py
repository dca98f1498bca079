import pytest
from pyspark.sql import functions as F

from sluice.functions.dates import (
    display,
    iso_from_millis,
    millis_from_iso,
    reformat,
    round_slice,
    slice_end,
    slice_start,
)
from sluice.functions.scale import build_scale, missing_members, parse_scale
from sluice.functions.text import (
    domain_of,
    pad_count,
    path_join,
    shares_any,
    to_list,
    url_container,
    url_host,
    url_token,
)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def at(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    "now, step, want",
    [
        ("11:43:00", 15, "11:45:00"),
        ("11:43:59", -30, "11:30:00"),
        ("11:43:00", 60, "12:00:00"),
        ("11:45:30", 15, "11:45:00"),
        ("12:00:00", -30, "12:00:00"),
        ("11:43:20", 0, "11:43:00"),
    ],
)
def test_rounding(spark, now, step, want):
    got = one(spark, F.date_format(round_slice(at(f"2024-01-01 {now}"), step), "HH:mm:ss"))
    assert got == want


def test_rounding_rejects_uneven_steps():
    with pytest.raises(ValueError):
        round_slice(F.lit(None), 7)


def test_rounding_is_idempotent_over_all_minutes(spark):
    minutes = spark.range(24 * 60).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    for step in (5, 15, 30, 60, -15, -30, -60):
        once = round_slice(F.col("ts"), step)
        wait = F.unix_seconds(once) - F.unix_seconds("ts")
        low, high = (0, step * 60 - 60) if step > 0 else (step * 60 + 60, 0)
        wrong = minutes.where((round_slice(once, step) != once) | ~wait.between(low, high))
        assert wrong.count() == 0


def test_slices_are_named_by_their_end(spark):
    for text, want in (("11:30:00", "12:00"), ("11:29:59.999", "11:30"), ("00:00:00", "00:30")):
        assert one(spark, F.date_format(slice_end(at(f"1969-12-31 {text}")), "HH:mm")) == want
    assert one(spark, F.date_format(slice_start(at("2024-01-01 11:59:59")), "HH:mm")) == "11:30"


def test_dates(spark):
    assert one(spark, reformat(F.lit("20170611 09:05:00"), "yyyyMMdd HH:mm:ss", "yyyy-MM-dd HH:mm:ss")) == "2017-06-11 09:05:00"
    assert one(spark, reformat(F.lit("1092017"), "MMddyyyy", "yyyy")) is None
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        one(spark, reformat(F.lit("1092017"), "MMddyyyy", "yyyy", strict=True))
    assert one(spark, display(at("2017-03-04 15:06:07"))) == "3-4-17 15:06:07 UTC"
    assert one(spark, iso_from_millis(F.lit(1488639967123))) == "2017-03-04T15:06:07.0000000"
    assert one(spark, millis_from_iso(F.lit("2017-03-04T15:06:07.1239999Z"))) == 1488639967123


def test_scale_golden(spark):
    got = one(spark, parse_scale(F.lit("(4,4.54;6,7894.00;3,479.79)"), ["q", "v"]))
    assert [tuple(r) for r in got] == [("4", "4.54"), ("6", "7894.00"), ("3", "479.79")]


@pytest.mark.parametrize(
    "text, want, short",
    [
        ("(1,2)", [("1", "2")], 0),
        ("(1,2,3;4)", [("1", "2"), ("4", None)], 1),
        ("(1,2;;)", [("1", "2")], 0),
        ("(1,2;;3,4)", [("1", "2"), ("", None), ("3", "4")], 1),
        ("(,2)", [("", "2")], 0),
        ("(1,)", [("1", None)], 1),
        ("()", [("", None)], 1),
        ("(;;)", [], 0),
    ],
)
def test_scale_ragged(spark, text, want, short):
    got = one(spark, parse_scale(F.lit(text), ["q", "v"]))
    assert [tuple(r) for r in got] == want
    assert one(spark, missing_members(F.lit(text), 2)) == short


def test_scale_null(spark):
    null = F.lit(None).cast("string")
    assert one(spark, parse_scale(null, ["q"])) is None
    assert one(spark, build_scale((F.lit("1"), null))) is None
    assert one(spark, build_scale((F.lit("1"), F.lit(2)), (F.lit(3.5), F.lit("x")))) == "(1,2;3.5,x)"


def test_text(spark):
    assert [one(spark, pad_count(F.lit(n))) for n in (0, 7, 42, 123, 12345)] == ["00", "07", "42", "123", "12345"]
    assert one(spark, to_list(F.lit(" view,  admin,x "))) == ["view", "admin", "x"]
    assert one(spark, domain_of(F.lit("me@x.example"))) == "@x.example"
    assert one(spark, domain_of(F.lit("nobody"))) is None
    assert one(spark, path_join(F.lit("s://a/"), F.lit("/b"), F.lit("c"))) == "s://a/b/c"
    empty = F.array().cast("array<string>")
    pairs = [(F.array(F.lit(1)), F.array(F.lit("1")), True), (empty, empty, False), (F.array(F.lit("a")), F.array(F.lit("b")), False)]
    assert [one(spark, shares_any(a, b)) for a, b, _ in pairs] == [w for *_, w in pairs]


def test_signed_url(spark):
    url = F.lit("https://host.example/box?sv=1&sig=abc?x")
    assert one(spark, url_host(url)) == "https://host.example"
    assert one(spark, url_container(url)) == "box"
    assert one(spark, url_token(url)) == "sv=1&sig=abc"
