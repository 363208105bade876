"""Reader and writer options: names, defaults, validation."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from tidewell.functions.identifiers import parse_column_map

log = logging.getLogger(__name__)

# What counts as true and as false.
TRUE = ("on", "yes", "true", "1", "enabled")
FALSE = ("off", "no", "false", "0", "disabled")
BOOLEANS = {
    "usestagingtable": True, "truncate_table": False, "continue_on_error": False, "truncate_columns": False, "force": False, "purge": False,
    "trim_space": False, "use_copy_unload": False, "use_parquet_in_write": False, "use_json_in_structured_data": False, "keep_column_case": False,
    "treat_decimal_as_long": False, "verify_rows": False, "compress": True, "internal_skip_write_when_writing_empty_dataframe": False,
}
INTEGERS = {"partition_size_in_mb": 100, "expected_partition_count": 1000, "s3maxfilesize": 10_000_000, "max_records_per_file": 0}
TEXTS = (
    "dbtable", "query", "sfdatabase", "sfschema", "tempdir", "stage_dir", "load_id", "warehouse_dir", "preactions", "postactions", "columnmap",
    "column_mapping", "column_mismatch_behavior", "string_timestamp_format", "sftimezone", "files",
)
#: Other names of the same options.
ALIASES = {"sfcompress": "compress", "stage": "stage_dir", "table": "dbtable"}
LEAST_FILE_SIZE = 1_000_000


class OptionError(ValueError):
    """An option has a value that can't be used."""


def boolean(name: str, value: object) -> bool:
    text = str(value).strip().lower()
    if text in TRUE:
        return True
    if text in FALSE:
        return False
    raise OptionError(f"{name} must be one of {TRUE + FALSE}, not {value!r}")


@dataclass(frozen=True)
class Options:
    """Validated options. Unknown names, among them all that concern a remote service or its own text
    formats, are kept in ``unknown``, named in a warning, and otherwise ignored."""

    values: Mapping[str, object]
    column_map: Mapping[str, str] | None = None
    unknown: tuple[str, ...] = field(default=())
    #: Names that the caller has given.
    given: frozenset[str] = field(default=frozenset())

    @classmethod
    def parse(cls, given: Mapping[str, object]) -> Options:
        lower = {ALIASES.get(k.lower(), k.lower()): v for k, v in given.items() if v is not None}
        values: dict[str, object] = {**BOOLEANS, **INTEGERS, "sfschema": "public", "column_mapping": "order", "column_mismatch_behavior": "error"}
        for name in BOOLEANS.keys() & lower.keys():
            values[name] = boolean(name, lower[name])
        for name in INTEGERS.keys() & lower.keys():
            try:
                values[name] = int(str(lower[name]))
            except ValueError:
                raise OptionError(f"{name} must be a whole number, not {lower[name]!r}") from None
        for name in TEXTS:
            if name in lower:
                values[name] = str(lower[name])
        if values["s3maxfilesize"] < LEAST_FILE_SIZE:
            raise OptionError(f"s3maxfilesize must be {LEAST_FILE_SIZE} or more")
        if values["partition_size_in_mb"] <= 0 or values["expected_partition_count"] <= 0:
            raise OptionError("partition_size_in_mb and expected_partition_count must be positive")
        for name, allowed in (("column_mapping", ("name", "order")), ("column_mismatch_behavior", ("error", "ignore"))):
            values[name] = str(values[name]).lower()
            if values[name] not in allowed:
                raise OptionError(f"{name} must be one of {allowed}, not {values[name]!r}")
        if "dbtable" in values and "query" in values:
            raise OptionError("give dbtable or query, not both")
        known = {*values, *TEXTS}
        unknown = tuple(sorted(lower.keys() - known))
        if unknown:
            log.warning("options that have no meaning here: %s", ", ".join(unknown))
        column_map = parse_column_map(str(values["columnmap"])) if "columnmap" in values else None
        return cls(values, column_map, unknown, frozenset(lower))

    def __getitem__(self, name: str):
        return self.values[name]

    def get(self, name: str, default=None):
        return self.values.get(name, default)

    @property
    def source(self) -> tuple[str, str]:
        """("table", name) or ("query", text)"""
        if "query" in self.values:
            return "query", str(self["query"]).strip().rstrip(";").strip()
        if "dbtable" not in self.values:
            raise OptionError("dbtable or query is needed")
        name = str(self["dbtable"]).strip()
        if name.startswith("(") and name.endswith(")"):
            return "query", name[1:-1].strip().rstrip(";").strip()
        return "table", name
