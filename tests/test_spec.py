import pytest
from pyspark.sql import types as T

from sluice.plans.normalize import FEED_SPEC, FEED_STORE
from sluice.spec import LoadSpec, SpecError, StoreSpec


def test_load_defaults_and_types():
    spec = LoadSpec.of('{"columns": [{"name": "a", "type": "INTEGER"}, {"name": "b", "type": "number"}]}')
    assert spec.on_wrong_column_count == "fail"
    assert [c.on_wrong_type for c in spec.columns] == ["fail", "fail"]
    assert spec.schema == T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    assert spec.can_fail


def test_feed_spec_never_fails():
    assert len(FEED_SPEC.columns) == 12
    assert not FEED_SPEC.can_fail
    assert FEED_STORE.processors["scale"].node == "Scale"


@pytest.mark.parametrize(
    "doc",
    [
        {},
        {"columns": [{"name": "a", "type": "date"}]},
        {"columns": [{"name": "a"}]},
        {"columns": [{"name": "a", "type": "int", "onWrongType": "ignore"}]},
        {"columns": [{"name": "a", "type": "int"}, {"name": "A", "type": "int"}]},
        {"columns": [{"name": "a", "type": "int"}], "onWrongColumnCount": "drop"},
    ],
)
def test_bad_load_specs(doc):
    with pytest.raises(SpecError):
        LoadSpec.of(doc)


def _store(**extra):
    return {"entry": "e", **extra}


@pytest.mark.parametrize(
    "doc",
    [
        {"root": "r"},
        _store(root="1st"),
        _store(processors=[{"column": "c", "type": "scale"}]),
        _store(processors=[{"column": "c", "type": "scale", "children": ["a b"]}]),
        _store(processors=[{"column": "c", "type": "scale", "children": ["a"]}] * 2),
    ],
)
def test_bad_store_specs(doc):
    with pytest.raises(SpecError):
        StoreSpec.of(doc)


def test_store_defaults():
    spec = StoreSpec.of(_store(processors=[{"column": "c", "type": "scale", "children": ["a"]}]))
    assert (spec.root, spec.pre, spec.post, spec.processors["c"].node) == ("", (), (), "c")
    assert (StoreSpec.named().root, StoreSpec.named().entry) == ("root", "entry")
