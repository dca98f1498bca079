"""XML entries, files with envelopes, and reading them back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import case
from sluice.cases.feeds import FEED_ROWS, feed_lines, table
from sluice.functions.scale import build_scale
from sluice.operators.validate import check
from sluice.operators.xmlrows import PROCESSORS, StoreTypeError, store_losses, to_entries
from sluice.plans.normalize import FEED_SPEC, FEED_STORE, normalize_feed
from sluice.session import work_dir
from sluice.sinks.xmlfiles import part_rows, write_xml
from sluice.sources.files import list_files, non_empty
from sluice.sources.xml import is_entry, parse_entry, read_entries, read_xml
from sluice.spec import StoreSpec

_SOAP = StoreSpec.of(
    {
        "root": "rows",
        "entry": "row",
        "pre": ['<?xml version="1.0" encoding="utf-8"?>', "<Envelope>", "<Body>"],
        "post": ["</Body>", "</Envelope>"],
    }
)


def _escaped(expression: str) -> str:
    # The writer leaves ">" as it is, which XML allows.
    return f"replace(replace({expression}, '&', '&amp;'), '<', '&lt;')"


def _element(name: str, expression: str) -> str:
    return f"coalesce('<{name}>' || {expression} || '</{name}>', '')"


@case(
    "xml_entries",
    f"""select c_custkey, '<entry>' || {_element('c_name', _escaped("'<' || c_name || '> & co'"))} ||
      {_element('nation', "case when c_acctbal >= 0 then cast(c_nationkey as varchar) end")} ||
      {_element('c_acctbal', 'cast(c_acctbal as varchar)')} ||
      {_element('in_credit', 'cast(c_acctbal > 5000 as varchar)')} ||
      {_element('c_mktsegment', 'c_mktsegment')} || '</entry>' as value
    from customer""",
)
def xml_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One element per column; customers in debt have no nation element."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("<"), "c_name", F.lit("> & co")).alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("nation"),
        "c_acctbal",
        (F.col("c_acctbal") > 5000).alias("in_credit"),
        F.encode("c_mktsegment", "UTF-8").alias("c_mktsegment"),
    )
    return to_entries(rows, StoreSpec.named(), keep=("c_custkey",))


_FEED_XML = f"""
with rows as ({FEED_ROWS})
select '<data>' || {_element('CUSTOMER_DESC', _escaped('CUSTOMER_DESC'))} ||
  {_element('CUSTOMER_DEST_LOC', 'CUSTOMER_DEST_LOC')} ||
  {_element('CUSTOMER_DEST_LOC_DESC', 'CUSTOMER_DEST_LOC_DESC')} ||
  {_element('CUSTOMER_ID', 'cast(CUSTOMER_ID as varchar)')} ||
  {_element('CUSTOMER_SEGMENT_DESC', 'CUSTOMER_SEGMENT_DESC')} ||
  {_element('CUSTOMER_SEGMENT_ID', 'cast(CUSTOMER_SEGMENT_ID as varchar)')} ||
  {_element('Extraction_Time', 'Extraction_Time')} || {_element('SALES_REP', 'SALES_REP')} ||
  '<Scale><Scale_Quantity>' || replace(replace(scale[2:len(scale) - 1], ',',
    '</Scale_Quantity><Scale_Value>'), ';', '</Scale_Value></Scale><Scale><Scale_Quantity>')
  || '</Scale_Value></Scale></data>' as value
from rows
"""


@case("normalize_xml", _FEED_XML)
def normalize_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main path: CSV lines, checked, reshaped, as XML with repeated scale nodes."""
    return to_entries(normalize_feed(check(feed_lines(spark, sf_dir), FEED_SPEC).good), FEED_STORE)


@case(
    "xml_round_trip",
    r"""select doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') as text, lang, source, n_chars
    from documents""",
)
def xml_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through XML files with an envelope, and back."""
    documents = table(spark, sf_dir, "documents")
    where = work_dir(spark, "documents")
    write_xml(documents, where, StoreSpec.of({"root": "documents", "entry": "document"}))
    return read_entries(spark, where, documents.schema, "document")


@case("xml_read", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def xml_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enveloped files through the general XML reader."""
    supplier = table(spark, sf_dir, "supplier")
    where = work_dir(spark, "suppliers")
    write_xml(supplier, where, _SOAP)
    return read_xml(spark, where, supplier.schema, "row")


@case(
    "xml_parse",
    "select l_orderkey, l_linenumber, cast(l_quantity as varchar) as q, cast(l_extendedprice as varchar) as v "
    "from lineitem union all "
    "select l_orderkey, l_linenumber, cast(l_discount as varchar), cast(l_tax as varchar) from lineitem",
)
def xml_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated scale nodes parsed back into rows."""
    pairs = (("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"))
    scale = build_scale(*[[F.col(c) for c in pair] for pair in pairs])
    items = table(spark, sf_dir, "lineitem")
    rows = items.select("l_orderkey", "l_linenumber", scale.alias("scale"))
    spec = StoreSpec.of(
        {"entry": "e", "processors": [{"column": "scale", "type": "scale", "node": "S", "children": ["q", "v"]}]}
    )
    entries = to_entries(rows, spec, keep=("l_orderkey", "l_linenumber"))
    parsed = parse_entry(F.col("value"), "S array<struct<q: string, v: string>>")
    return entries.select("l_orderkey", "l_linenumber", F.inline(parsed["S"]))


@case(
    "envelope_parts",
    "select count(*) as entries, true as all_enveloped, cast(0 as bigint) as hollow_files from orders",
)
def envelope_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in enveloped files: every non-empty file starts and ends with the
    envelope and holds at least one entry."""
    where = work_dir(spark, "envelopes")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    write_xml(orders, where, _SOAP, files=8)
    lines = spark.read.text(where).select(F.col("_metadata.file_name").alias("name"), "value")
    starts, ends = F.col("value").startswith("<?xml"), F.col("value").endswith("</Envelope>")
    per_file = lines.groupBy("name").agg(
        F.count_if(starts).alias("starts"), F.count_if(ends).alias("ends"), (F.count("*") - 2).alias("entries")
    )
    counted = part_rows(spark, where, "row").withColumnRenamed("rows", "part_rows")
    files = non_empty(list_files(spark, where, "part-*")).select("name")
    return (
        files.join(per_file, "name", "left")
        .join(counted, "name", "left")
        .agg(
            F.sum("part_rows").alias("entries"),
            F.bool_and(
                (F.col("starts") == 1) & (F.col("ends") == 1) & (F.col("entries") == F.col("part_rows"))
            ).alias("all_enveloped"),
            F.count_if(F.col("part_rows").isNull()).alias("hollow_files"),
        )
    )


@case(
    "store_losses",
    r"""select cast(coalesce(sum(length(text) - length(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'))), 0)
      as bigint) as illegal_characters,
      cast(sum(case when lang = 'en' then 1 else 0 end) as bigint) as missing_members from documents""",
)
def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What XML cannot carry: forbidden characters, and a member English documents lack."""
    spec = StoreSpec.of(
        {"entry": "e", "processors": [{"column": "scale", "type": "scale", "children": ["size", "lang"]}]}
    )
    rows = table(spark, sf_dir, "documents").select(
        "text",
        F.when(F.col("lang") == "en", F.format_string("(%d)", "n_chars"))
        .otherwise(F.format_string("(%d,%s)", "n_chars", "lang"))
        .alias("scale"),
    )
    return store_losses(rows, spec)


@case(
    "custom_processor",
    "select p_partkey, "
    + "'<p>' || "
    + _element("p_name", _escaped("p_name"))
    + " || case when p_type is null then '' else '<kind>' || list_aggregate(list_transform(string_split(p_type, ' '), "
    + "lambda w: '<word>' || "
    + _escaped("w")
    + " || '</word>'), 'string_agg', '') || '</kind>' end || '</p>' as xml from part",
)
def custom_processor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a processor type that the caller brings: words of a column as elements."""
    words = {"words": lambda text, spec: F.when(text.isNotNull(), F.struct(F.split(text, " ").alias(spec.children[0])))}
    spec = StoreSpec.of(
        {"entry": "p", "processors": [{"column": "p_type", "type": "words", "node": "kind", "children": ["word"]}]}
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return to_entries(parts, spec, keep=("p_partkey",), name="xml", processors={**PROCESSORS, **words})


@case(
    "store_refusals",
    """select 'again' as attempt, 'PATH_ALREADY_EXISTS' as refusal, count(*) as stored from customer
    union all select 'date', '2108', 0 union all select 'nested', '2107', 0""",
)
def store_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes that are refused, and the entries at their target afterwards: over
    old output, which stays whole, and of columns that have no XML text."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    root = work_dir(spark, "refusals")
    where = f"{root}/customers"
    write_xml(customer, where, StoreSpec.named("customers", "customer"))
    nested = orders.select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("o_customer"))
    attempts = (
        ("again", customer, where),
        ("date", orders.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate")), f"{root}/dates"),
        ("nested", nested, f"{root}/nested"),
    )
    found = None
    for name, rows, target in attempts:
        refusal = "none"
        try:
            write_xml(rows, target, StoreSpec.named("customers", "customer"))
        except AnalysisException as refused:
            refusal = refused.getCondition()
        except StoreTypeError as refused:
            refusal = str(refused.code)
        # Read from above, since a folder that was refused may not be there.
        lines = spark.read.option("recursiveFileLookup", "true").text(root)
        here = F.col("_metadata.file_path").contains(f"/{target.rpartition('/')[2]}/") & is_entry(F.col("value"), "customer")
        row = lines.where(here).agg(F.count("*").alias("stored"))
        row = row.select(F.lit(name).alias("attempt"), F.lit(refusal).alias("refusal"), "stored")
        found = row if found is None else found.unionByName(row)
    return found
