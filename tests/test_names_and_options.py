import pytest

from tidewell.functions import identifiers as I
from tidewell.operators import mapping as M
from tidewell.options import OptionError, Options


@pytest.mark.parametrize(
    ("written", "stored", "kept"),
    [
        ("weight_kg", "WEIGHT_KG", "weight_kg"),
        ("_7", "_7", "_7"),
        ("7up", "7up", "7up"),
        ("net weight", "net weight", "net weight"),
        ("größe", "größe", "größe"),
        ('"net weight"', "net weight", "net weight"),
        ('"Tare"', "Tare", "Tare"),
        ('"5"" pipe"', '5" pipe', '5" pipe'),
        ('5" pipe', '5" pipe', '5" pipe'),
        ('"in" or "out"', '"in" or "out"', '"in" or "out"'),
        ('"', '"', '"'),
        ('""', "", ""),
    ],
)
def test_written_and_stored_names(written, stored, kept):
    assert I.stored_name(written) == stored
    assert I.stored_name(written, keep_case=True) == kept
    assert I.stored_name(I.quote(stored)) == stored  # what is quoted comes back as it is


def test_names_that_readers_see():
    assert [I.read_name(n) for n in ("TARE", "_T4", "Tare", "4T", "GROSS WT", 'A"')] == ["TARE", "_T4", '"Tare"', '"4T"', '"GROSS WT"', '"A"""']
    assert I.read_name("gross wt", keep_case=True) == "gross wt"
    for name in ("TARE", "tare", "gross wt", 'q"q', "É"):
        assert I.stored_name(I.read_name(name)) == name  # what is read can be written again


def test_dotted_names():
    assert I.parts("depot.crates") == ["DEPOT", "CRATES"]
    assert I.parts(' a."b.c"."D""E" ') == ["A", "b.c", 'D"E']
    assert I.parts("x$1") == ["X$1"]
    for bad in ("", "a..b", ".a", "a b", '"open', "a;drop", "4x"):
        with pytest.raises(ValueError):
            I.parts(bad)


def test_column_map_text():
    assert I.parse_column_map("Map(a -> B, c -> D)") == {"a": "B", "c": "D"}
    for bad in ("", "Map()", "a -> b", "Map(a)", "Map(a -> )"):
        with pytest.raises(ValueError):
            I.parse_column_map(bad)


def test_mapping_by_name():
    assert M.by_name(["a", "B"], ["A", "b"], True) == {"a": "A", "B": "b"}
    assert M.by_name(["a", "x"], ["A", "b"], False) == {"a": "A"}
    for own, table, strict in ((["a", "A"], ["a"], False), (["a"], ["a", "A"], False), (["a"], ["a", "b"], True), (["a", "c"], ["a", "b"], True), (["x"], ["y"], False)):
        with pytest.raises(M.MappingError):
            M.by_name(own, table, strict)
    assert M.by_name(["a", "A", "b"], ["b"], False) == {"b": "b"}  # nobody needs the doubled one


def test_explicit_map():
    assert M.explicit({"a": "b"}, ["a"], ["B"]) == {"a": "B"}
    with pytest.raises(M.MappingError):
        M.explicit({"z": "B"}, ["a"], ["B"])
    with pytest.raises(M.MappingError):
        M.explicit({"a": "Q"}, ["a"], ["B"])


def test_options():
    o = Options.parse({"DbTable": "t", "USESTAGINGTABLE": "off", "truncate_table": "enabled", "sfUser": "x", "odd": 1})
    assert o["usestagingtable"] is False and o["truncate_table"] is True and o.unknown == ("odd", "sfuser")
    assert o.given == {"dbtable", "usestagingtable", "truncate_table", "sfuser", "odd"}
    assert o.source == ("table", "t")
    assert Options.parse({"dbtable": "(select 1;)"}).source == ("query", "select 1")
    assert Options.parse({"query": "select 1 ; "}).source == ("query", "select 1")
    for bad in ({"dbtable": "t", "query": "q"}, {"purge": "maybe"}, {"s3maxfilesize": "12"}, {"partition_size_in_mb": "0"}, {"column_mapping": "x"}, {"column_mismatch_behavior": "x"}, {"partition_size_in_mb": "a"}):
        with pytest.raises(OptionError):
            Options.parse(bad)
    with pytest.raises(OptionError):
        _ = Options.parse({}).source
