"""Load and store specifications; every configuration error is raised here."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The type names a load spec may use, and their Spark types.
LOAD_TYPES: dict[str, T.DataType] = {
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "number": T.DoubleType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "chararray": T.StringType(),
}
POLICIES = ("skip", "fail")

_XML_NAME = re.compile(r"[A-Za-z_À-�][\w.\-·]*(:[A-Za-z_À-�][\w.\-·]*)?")


class SpecError(ValueError):
    """A load or store specification that cannot be honoured."""


def _policy(value: object, where: str) -> str:
    text = "fail" if value is None else str(value)
    if text not in POLICIES:
        raise SpecError(f"{where}: policy must be one of {POLICIES}, not {text!r}")
    return text


def check_xml_name(name: str, where: str) -> str:
    if not isinstance(name, str) or not _XML_NAME.fullmatch(name):
        raise SpecError(f"{where}: {name!r} is not an XML element name")
    return name


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    on_wrong_type: str = "fail"

    @property
    def spark_type(self) -> T.DataType:
        return LOAD_TYPES[self.type]


@dataclass(frozen=True)
class LoadSpec:
    """Declared columns and error policies of one kind of input file."""

    columns: tuple[ColumnSpec, ...]
    on_wrong_column_count: str = "fail"

    @staticmethod
    def of(document: str | Mapping) -> LoadSpec:
        doc = json.loads(document) if isinstance(document, str) else document
        columns = []
        for i, entry in enumerate(doc.get("columns") or []):
            try:
                name, kind = str(entry["name"]), str(entry["type"]).lower()
            except KeyError as missing:
                raise SpecError(f"column {i}: {missing} is required") from None
            if kind not in LOAD_TYPES:
                raise SpecError(f"column {name!r}: unknown type {kind!r}")
            columns.append(ColumnSpec(name, kind, _policy(entry.get("onWrongType"), f"column {name!r}")))
        if not columns:
            raise SpecError("a load spec needs at least one column")
        lowered = [c.name.lower() for c in columns]
        if len(set(lowered)) != len(lowered):
            raise SpecError("column names must differ")
        return LoadSpec(tuple(columns), _policy(doc.get("onWrongColumnCount"), "onWrongColumnCount"))

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    @property
    def can_fail(self) -> bool:
        policies = {c.on_wrong_type for c in self.columns if c.type not in ("string", "chararray")}
        return "fail" in policies | {self.on_wrong_column_count}


@dataclass(frozen=True)
class ProcessorSpec:
    column: str
    type: str
    node: str
    children: tuple[str, ...]


@dataclass(frozen=True)
class StoreSpec:
    """How rows become XML: element names, processors, the file envelope and the files' compression (none by default)."""

    entry: str
    root: str = ""
    processors: Mapping[str, ProcessorSpec] = field(default_factory=dict)
    pre: tuple[str, ...] = ()
    post: tuple[str, ...] = ()
    on_close: tuple[str, ...] = ()
    compression: str = ""

    @staticmethod
    def of(document: str | Mapping) -> StoreSpec:
        doc = json.loads(document) if isinstance(document, str) else document
        if not doc.get("entry"):
            raise SpecError("a store spec needs an entry name")
        processors: dict[str, ProcessorSpec] = {}
        for p in doc.get("processors") or []:
            column = str(p.get("column") or "")
            kind = str(p.get("type") or "")
            if not column or not kind or not p.get("children"):
                raise SpecError("a processor needs column, type and children")
            if column in processors:
                raise SpecError(f"two processors for column {column!r}")
            node = check_xml_name(str(p.get("node") or column), "processor node")
            children = tuple(check_xml_name(c, "processor child") for c in p["children"])
            if len(set(children)) != len(children):
                raise SpecError(f"processor for {column!r}: child names must differ")
            processors[column] = ProcessorSpec(column, kind, node, children)
        root = str(doc.get("root") or "")
        if root:
            check_xml_name(root, "root")
        return StoreSpec(
            entry=check_xml_name(str(doc["entry"]), "entry"),
            root=root,
            processors=processors,
            pre=tuple(doc.get("pre") or ()),
            post=tuple(doc.get("post") or ()),
            on_close=tuple(doc.get("onclose") or ()),
            compression=str(doc.get("compression") or ""),
        )

    @staticmethod
    def named(root: str = "root", entry: str = "entry") -> StoreSpec:
        """The short form: only a root and an entry name."""
        return StoreSpec.of({"root": root, "entry": entry})
