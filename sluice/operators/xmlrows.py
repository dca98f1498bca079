"""Rows as XML entries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scale import missing_members, parse_scale
from sluice.sources.xml import XML_NAMES
from sluice.spec import ProcessorSpec, SpecError, StoreSpec, check_xml_name

# Characters XML 1.0 does not allow: controls other than tab and line ends,
# and the two non-characters.
ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"
# The same and line ends: text that needs more than the usual escapes.  Said by what is
# usual, so that nearly every character is judged by the first range.
_UNUSUAL = r"[^\x20-\x{FFFD}\x09\x{10000}-\x{10FFFF}]"

_PLAIN = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_NESTED = (T.MapType, T.StructType, T.ArrayType)


class StoreTypeError(TypeError):
    """A column whose type has no XML text; ``code`` tells nested (2107) from other (2108)."""

    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


def legal_text(text: Column) -> Column:
    """Text without characters XML forbids."""
    return F.regexp_replace(text, ILLEGAL, "")


def illegal_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(ILLEGAL)), F.lit(0))


def _text(name: str, kind: T.DataType) -> Column:
    """A column as text, by type."""
    column = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, (T.NullType, *_PLAIN)):
        return column.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.decode(column, "UTF-8")
    if isinstance(kind, _NESTED):
        raise StoreTypeError(2107, f"column {name!r}: nested types are not supported")
    raise StoreTypeError(2108, f"column {name!r}: format {kind.simpleString()} as text first")


def _scale(text: Column, spec: ProcessorSpec) -> Column:
    return parse_scale(text, spec.children)


# Processor types by name; add an entry to offer another one.
Processor = Callable[[Column, ProcessorSpec], Column]
PROCESSORS: dict[str, Processor] = {"scale": _scale}


def _is_free_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType))


def entry_fields(
    schema: T.StructType, spec: StoreSpec, clean: bool, processors: Mapping[str, Processor] = PROCESSORS
) -> list[Column]:
    """Element columns of an entry, in schema order; ``clean`` drops forbidden characters."""
    for column in spec.processors:
        if column not in schema.names:
            raise SpecError(f"processor for unknown column {column!r}")
    fields = []
    for f in schema.fields:
        text = _text(f.name, f.dataType)
        if clean and _is_free_text(f.dataType):
            text = legal_text(text)
        chosen = spec.processors.get(f.name)
        if chosen is None:
            fields.append(text.alias(check_xml_name(f.name, "column")))
            continue
        if chosen.type not in processors:
            raise SpecError(f"unknown processor type {chosen.type!r}")
        if not isinstance(f.dataType, T.StringType):
            raise StoreTypeError(2108, f"column {f.name!r}: a processor reads text")
        fields.append(processors[chosen.type](text, chosen).alias(chosen.node))
    return fields


def to_entries(
    df: DataFrame,
    spec: StoreSpec,
    keep: tuple[str, ...] = (),
    name: str = "value",
    processors: Mapping[str, Processor] = PROCESSORS,
) -> DataFrame:
    """One XML text per row, always on a single line; ``keep`` columns ride
    along and are not part of the entry.  ``processors`` are the processor
    types that the spec may name.

    One look at all text of a row tells whether it needs the careful form;
    most rows do not and skip the per-column work.
    """
    stored = T.StructType([f for f in df.schema.fields if f.name not in keep])

    def rendered(clean: bool) -> Column:
        fields = F.struct(*entry_fields(stored, spec, clean, processors))
        return F.to_xml(fields, {**XML_NAMES, "rowTag": spec.entry, "indent": ""})

    # The writer ends every entry with a line end.  It goes; text cannot hold a raw tag.
    end = f"</{spec.entry}>"
    careful = F.replace(rendered(clean=True), F.lit(f"{end}\n"), F.lit(end))
    # A line end inside a value becomes a character reference: entries stay on
    # one line, so files split when read back, and the value survives.
    for raw, reference in (("\n", "&#10;"), ("\r", "&#13;")):
        careful = F.replace(careful, F.lit(raw), F.lit(reference))
    texts = [_text(f.name, f.dataType) for f in stored.fields if _is_free_text(f.dataType)]
    xml = F.substring_index(rendered(clean=False), "\n", 1)
    if texts:
        xml = F.when(F.concat_ws("", *texts).rlike(_UNUSUAL), careful).otherwise(xml)
    return df.select(*keep, xml.alias(name))


def store_losses(df: DataFrame, spec: StoreSpec) -> DataFrame:
    """One row: characters and scale members the XML output cannot carry."""
    texts = [_text(f.name, f.dataType) for f in df.schema.fields if _is_free_text(f.dataType)]
    illegal = sum((F.coalesce(illegal_count(t), F.lit(0)) for t in texts), F.lit(0))
    short = sum(
        (
            F.coalesce(missing_members(F.col(f"`{p.column}`"), len(p.children)), F.lit(0))
            for p in spec.processors.values()
        ),
        F.lit(0),
    )
    return df.agg(
        F.coalesce(F.sum(illegal), F.lit(0)).alias("illegal_characters"),
        F.coalesce(F.sum(short), F.lit(0)).alias("missing_members"),
    )
