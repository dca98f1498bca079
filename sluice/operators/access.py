"""Who may see what: assignments keyed by account or mail domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import domain_of, shares_any, to_list

FIELDS = ("customer_id", "rights", "resource_group", "data_factory", "pipelines")
#: Parts that lookups of a heavy account are dealt into.
PARTS = 64


def current(assignments: DataFrame, sequence: str = "sequence") -> DataFrame:
    """The access table: the last assignment of each account."""
    latest = F.max_by(F.struct(*FIELDS), F.col(sequence))
    return assignments.groupBy("account").agg(latest.alias("_a")).select("account", "_a.*")


def upsert(table: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert or replace by account; among changes the highest sequence wins.

    A change without sequence replaces the old row and yields to numbered changes.
    """
    old = table.select("account", *FIELDS, F.lit(None).cast("bigint").alias("sequence"))
    new = changes.select("account", *FIELDS, F.col("sequence").cast("bigint"))
    # A null sequence would be ignored by max_by, so old rows get the lowest.
    old = old.withColumn("sequence", F.lit(-(2**63)))
    rows = old.unionByName(new.withColumn("sequence", F.coalesce("sequence", F.lit(1 - 2**63))))
    return current(rows)


def for_account(table: DataFrame, user: Column) -> DataFrame:
    """Rows of one user: under the full account or under its domain."""
    return table.where((F.col("account") == user) | (F.col("account") == domain_of(user)))


def most_specific(users: DataFrame, table: DataFrame, user: str = "user_account", parts: int = PARTS) -> DataFrame:
    """The longest matching account for each user, with list fields split.

    Accounts that more than one in ``parts`` of all names look up, such as the
    mail domain of most users, are found by a count.  There are fewer than
    ``parts`` of them, so this list is broadcast; their lookups are dealt into
    ``parts`` parts by user and their assignments are copied to each.
    """
    # Users named more than once would be dealt into the same part each time.
    once = users.select(user).distinct()
    names = once.select(user, F.explode(F.array_distinct(F.array(user, domain_of(F.col(user))))).alias("account"))
    counted = names.groupBy("account").agg(F.count("*").alias("n"))
    total = counted.select(F.sum("n")).scalar()
    heavy = F.broadcast(counted.where(F.col("n") * parts > total).select("account", F.lit(True).alias("_heavy")))
    part = F.when(F.col("_heavy"), F.pmod(F.xxhash64(user), F.lit(parts))).otherwise(0)
    every = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    dealt = names.join(heavy, "account", "left").select(user, "account", part.cast("int").alias("_part"))
    copied = table.join(heavy, "account", "left").select("account", *FIELDS, F.explode(every).alias("_part"))
    chosen = (
        dealt.join(copied, ["account", "_part"])
        .groupBy(user)
        .agg(
            F.max_by(F.struct("account", *FIELDS), F.struct(F.length("account"), F.col("account"))).alias("_a")
        )
    )
    return chosen.select(user, "_a.*").withColumns(
        {"rights": to_list(F.col("rights")), "pipelines": to_list(F.col("pipelines"))}
    )


def has_right(rights: Column, wanted: Column) -> Column:
    """True when any wanted right is held."""
    return shares_any(rights, wanted)


def holds(rights: Column, right: str) -> Column:
    return F.coalesce(F.array_contains(rights, right), F.lit(False))
