"""Access assignments: upsert, lookup and rights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import case
from sluice.cases.feeds import ASSIGNMENTS, USER_ACCOUNT, assignments, pipeline_records, table, user_account
from sluice.functions.text import domain_of, to_list
from sluice.operators.access import current, for_account, has_right, holds, most_specific, upsert
from sluice.operators.monitor import accessible
from sluice.session import work_dir
from sluice.sinks import accesstable
from sluice.sinks.tables import append_access

_COLUMNS = "account, customer_id, rights, resource_group, data_factory, pipelines"
_CHANGED = f"""
changed as (
  select {USER_ACCOUNT} as account, 'V' || c_custkey as customer_id, 'admin' as rights,
    'rg-changed' as resource_group, 'df-changed' as data_factory, 'pl-0' as pipelines
  from customer where c_mktsegment = 'BUILDING')
"""


def _changes(spark: SparkSession, sf_dir: str, sequence: int) -> DataFrame:
    buildings = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return buildings.select(
        user_account().alias("account"),
        F.concat(F.lit("V"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.lit("admin").alias("rights"),
        F.lit("rg-changed").alias("resource_group"),
        F.lit("df-changed").alias("data_factory"),
        F.lit("pl-0").alias("pipelines"),
        F.lit(sequence).cast("bigint").alias("sequence"),
    )


_UPSERTED = f"""with {ASSIGNMENTS}, {_CHANGED}
  select {_COLUMNS} from changed
  union all select {_COLUMNS} from assignments where account not in (select account from changed)"""


@case("acl_upsert", _UPSERTED)
def acl_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stale = _changes(spark, sf_dir, 1).withColumn("rights", F.lit("none"))
    changes = stale.unionByName(_changes(spark, sf_dir, 2))
    return upsert(assignments(spark, sf_dir), changes)


@case("acl_scan", _UPSERTED)
def acl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments appended to a table; the scan resolves the latest."""
    where = work_dir(spark, "access")
    append_access(assignments(spark, sf_dir), where)
    append_access(_changes(spark, sf_dir, 1), where)
    return current(spark.read.parquet(where))


@case("acl_merged_scan", _UPSERTED)
def acl_merged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments merged into parts, a batch of changes merged into those it touches, and one beside them."""
    where = work_dir(spark, "access-table")
    parts = 8
    accesstable.add_changes(assignments(spark, sf_dir), where, 0, parts)
    accesstable.compact(spark, where)
    accesstable.add_changes(_changes(spark, sf_dir, 1).withColumn("rights", F.lit("none")), where, 1, parts)
    accesstable.add_changes(_changes(spark, sf_dir, 2), where, 2, parts)
    accesstable.compact(spark, where, until=1)
    return accesstable.scan(spark, where)


_SPECIFIC = f"""
users as (select {USER_ACCOUNT} as user_account, c_custkey from customer),
matches as (
  select user_account, a.* from users u join assignments a
    on a.account = u.user_account or a.account = '@' || split_part(u.user_account, '@', 2)),
chosen as (
  select * from (select *, row_number() over (partition by user_account order by length(account) desc) as rn
    from matches) where rn = 1)
"""


@case(
    "acl_most_specific",
    f"""with {ASSIGNMENTS}, {_SPECIFIC}
    select user_account, account, customer_id, data_factory,
      case when account = user_account then 'view|admin' else 'view' end as rights,
      replace(pipelines, ', ', '|') as pipelines
    from chosen""",
)
def acl_most_specific(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(user_account().alias("user_account"))
    chosen = most_specific(users, assignments(spark, sf_dir))
    return chosen.select(
        "user_account",
        "account",
        "customer_id",
        "data_factory",
        F.array_join("rights", "|").alias("rights"),
        F.array_join("pipelines", "|").alias("pipelines"),
    )


_CROWDED = "case when c_custkey % 10 < 9 then replace(c_name, '#', '.') || '@crowd.example' else {0} end"


@case(
    "acl_hot_domain",
    f"""with {ASSIGNMENTS}, users as (select {_CROWDED.format(USER_ACCOUNT)} as user_account from customer),
    granted as (select account, customer_id, data_factory from assignments
      union all select '@crowd.example', 'CROWD', 'df-crowd'),
    matches as (select user_account, g.* from users u join granted g
      on g.account = u.user_account or g.account = '@' || split_part(u.user_account, '@', 2))
    select user_account, account, customer_id, data_factory from (select *, row_number() over (
      partition by user_account order by length(account) desc) as rn from matches) where rn = 1""",
)
def acl_hot_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine of ten users share a mail domain."""
    crowd = F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@crowd.example"))
    account = F.when(F.col("c_custkey") % 10 < 9, crowd).otherwise(user_account())
    users = table(spark, sf_dir, "customer").select(account.alias("user_account"))
    granted = assignments(spark, sf_dir)
    shared = {"account": "@crowd.example", "customer_id": "CROWD", "data_factory": "df-crowd"}
    own = spark.range(1).select(*(F.lit(shared.get(c)).cast(t).alias(c) for c, t in granted.dtypes))
    chosen = most_specific(users, granted.unionByName(own))
    return chosen.select("user_account", "account", "customer_id", "data_factory")


@case(
    "acl_for_account",
    f"""with {ASSIGNMENTS}, who as (select {USER_ACCOUNT} as u from customer where c_acctbal < 0
      order by c_acctbal, c_custkey limit 1)
    select {_COLUMNS} from assignments, who where account = u or account = '@' || split_part(u, '@', 2)""",
)
def acl_for_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for the customer deepest in debt: its own and its domain's."""
    deepest = F.min_by(user_account(), F.struct("c_acctbal", "c_custkey"))
    who = table(spark, sf_dir, "customer").select(deepest).scalar()
    return for_account(assignments(spark, sf_dir), who).drop("sequence")


@case(
    "acl_semi_join",
    f"""with {ASSIGNMENTS} select distinct 'pl-' || c_custkey as name from customer
    where 'pl-' || c_custkey in (select trim(unnest(string_split(pipelines, ','))) from assignments)""",
)
def acl_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipelines that somebody may see."""
    allowed = assignments(spark, sf_dir).select(F.explode(to_list(F.col("pipelines"))).alias("name"))
    return accessible(pipeline_records(spark, sf_dir), allowed).select("name")


@case(
    "rights_overlap",
    f"""with {ASSIGNMENTS} select account, list_has_any([trim(x) for x in string_split(rights, ',')], ['admin', 'owner'])
      as may_change, list_contains([trim(x) for x in string_split(rights, ',')], 'view') as may_view,
      case when account like '_%@%' then '@' || split_part(account, '@', 2) else account end as domain
    from assignments""",
)
def rights_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rights = to_list(F.col("rights"))
    wanted = F.array(F.lit("admin"), F.lit("owner"))
    return assignments(spark, sf_dir).select(
        "account",
        has_right(rights, wanted).alias("may_change"),
        holds(rights, "view").alias("may_view"),
        domain_of(F.col("account")).alias("domain"),
    )
