"""Reading XML back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names never start with "@", so no element is taken for an attribute.
XML_NAMES = {"attributePrefix": "@", "valueTag": "@value"}
_READ = {**XML_NAMES, "mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}




def parse_entry(xml: Column, schema: str | T.StructType) -> Column:
    """One entry element as a struct."""
    return F.from_xml(xml, schema if isinstance(schema, str) else schema.simpleString(), _READ)


def is_entry(line: Column, entry: str) -> Column:
    """Whether a line of a written file is an entry, not part of the envelope."""
    whole = line.startswith(f"<{entry}>") & line.endswith(f"</{entry}>")
    return whole | (line == f"<{entry}/>")


def read_entries(spark: SparkSession, path: str, schema: str | T.StructType, entry: str) -> DataFrame:
    """Files of this library, which keep one entry per line, so that large
    files split.  Envelope lines do not start with the entry element."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    entries = lines.where(is_entry(F.col("value"), entry))
    return entries.select(F.inline(F.array(parse_entry(F.col("value"), schema))))


def read_xml(spark: SparkSession, path: str, schema: str | T.StructType, entry: str) -> DataFrame:
    """XML of any layout; files do not split."""
    reader = spark.read.format("xml").options(**_READ).option("rowTag", entry)
    return reader.schema(schema).option("recursiveFileLookup", "true").load(path)
