"""Text, list and address helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f"


def pad_count(value: Column, width: int = 2) -> Column:
    """Left pad with zeros, never cutting longer numbers."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def to_list(text: Column) -> Column:
    """Comma text to a list of trimmed members."""
    return F.transform(F.split(text, ","), lambda member: F.btrim(member, F.lit(_BLANKS)))


def from_list(members: Column) -> Column:
    return F.array_join(members, ",")


def shares_any(left: Column, right: Column) -> Column:
    """True when two lists share a member, compared as text."""
    texts = [c.cast("array<string>") for c in (left, right)]
    return F.coalesce(F.arrays_overlap(*texts), F.lit(False))


def domain_of(account: Column) -> Column:
    """``@domain`` of an account name, null without one."""
    return F.concat(F.lit("@"), F.get(F.split(account, "@"), F.lit(1)))


def path_join(*parts: Column) -> Column:
    """Path parts joined by single slashes; a scheme's ``//`` stays."""
    return F.regexp_replace(F.concat_ws("/", *parts), r"(?<!:)/{2,}", "/")


def url_host(url: Column) -> Column:
    return F.concat(F.lit("https://"), F.get(F.split(_before_query(url), "/"), F.lit(2)))


def url_container(url: Column) -> Column:
    return F.get(F.split(_before_query(url), "/"), F.lit(3))


def url_token(url: Column) -> Column:
    return F.get(F.split(url, r"\?"), F.lit(1))


def _before_query(url: Column) -> Column:
    return F.get(F.split(url, r"\?"), F.lit(0))


def file_url(host: Column, container: Column, name: Column, token: Column) -> Column:
    return F.format_string("%s/%s/%s?%s", host, container, name, token)


def log_key(job_id: Column, index: Column) -> Column:
    """``job-0007``: the display form; sort by the numeric index instead."""
    return F.format_string("%s-%04d", job_id, index)


def flag_text(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False)).cast("string")
