"""Dataset contracts: what a file or table is expected to look like."""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from loadlens.session import literal_frame

PLACEHOLDERS = {"{date_range}": r"(\d{8}-\d{8})", "{month}": r"(\d{4}-\d{2})"}


@dataclass(frozen=True)
class Contract:
    """One dataset: file name pattern, target table, ordered columns, keys, dialect."""

    file_pattern: str
    table_name: str
    expected_columns: tuple[str, ...] = ()
    date_column: str | None = None
    duplicate_key_columns: tuple[str, ...] = ()
    delimiter: str | None = None
    file_format: str = "AUTO"
    quote_char: str | None = '"'
    header: bool = False
    date_range: tuple[dt.date, dt.date] | None = None
    types: dict[str, str] = field(default_factory=dict, hash=False)
    multiline: bool = False

    @property
    def format(self) -> str:
        if self.file_format.upper() != "AUTO":
            return self.file_format.upper()
        name = self.file_pattern.lower().removesuffix(".gz")
        return "TSV" if name.endswith(".tsv") else "CSV"

    @property
    def separator(self) -> str:
        """An explicit separator wins; otherwise the format decides."""
        return self.delimiter or ("\t" if self.format == "TSV" else ",")

    @property
    def regex(self) -> str:
        """Anchored expression for file names, capturing the period; ``.gz`` optional."""
        out, rest = "", self.file_pattern
        marks = re.compile("|".join(re.escape(p) for p in PLACEHOLDERS))
        while found := marks.search(rest):
            out += re.escape(rest[: found.start()]) + PLACEHOLDERS[found.group()]
            rest = rest[found.end() :]
        tail = re.escape(rest)
        return f"^{out}{tail}$" if rest.endswith(".gz") else f"^{out}{tail}(?:\\.gz)?$"

    @property
    def literal_ends(self) -> tuple[str, str]:
        """What names begin and end with for sure: the text before the first placeholder and after the last, without ``.gz``."""
        marks = list(re.finditer("|".join(re.escape(p) for p in PLACEHOLDERS), self.file_pattern))
        if not marks:
            return self.file_pattern.removesuffix(".gz"), ""
        return self.file_pattern[: marks[0].start()], self.file_pattern[marks[-1].end() :].removesuffix(".gz")

    @property
    def period_kind(self) -> str | None:
        if "{date_range}" in self.file_pattern:
            return "range"
        return "month" if "{month}" in self.file_pattern else None

    def month_file_regex(self, month: str) -> str | None:
        """Names this contract's file may have for one month, any known extension."""
        from loadlens.functions.dates import month_range

        first, last = month_range(month)
        if self.period_kind is None:
            return None
        name = self.file_pattern.replace("{month}", month).replace(
            "{date_range}", f"{first:%Y%m%d}-{last:%Y%m%d}"
        )
        stem = name.rsplit(".", 1)[0] if "." in name else name
        return f"^{re.escape(stem)}\\.(?:tsv|csv|txt)(?:\\.gz)?$"

    def typed_like(self, table: DataFrame) -> "Contract":
        """Column types taken from the table that is loaded, matched without regard to case."""
        kinds = {f.name.lower(): f.dataType.simpleString() for f in table.schema.fields}
        return replace(self, types={c: kinds[c.lower()] for c in self.expected_columns if c.lower() in kinds})

    def with_range(self, start: dt.date, end: dt.date) -> "Contract":
        return replace(self, date_range=(start, end))


def contract_from_dict(entry: dict) -> Contract:
    keys = entry.get("duplicate_key_columns") or ()
    return Contract(
        file_pattern=entry["file_pattern"],
        table_name=entry["table_name"],
        expected_columns=tuple(entry.get("expected_columns") or ()),
        date_column=entry.get("date_column"),
        duplicate_key_columns=(keys,) if isinstance(keys, str) else tuple(keys),
        delimiter=entry.get("delimiter"),
        file_format=entry.get("file_format") or "AUTO",
        quote_char=entry.get("quote_char", '"'),
        types=entry.get("types") or {},
        multiline=bool(entry.get("multiline")),
    )


def load_contracts(text: str) -> list[Contract]:
    """Contracts from a JSON document with a ``files`` list."""
    return [contract_from_dict(e) for e in json.loads(text).get("files", [])]


def contracts_frame(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """One row per contract column: table, pattern, position, column name."""
    rows = [
        (c.table_name, c.file_pattern, i, name)
        for c in contracts
        for i, name in enumerate(c.expected_columns, 1)
    ]
    return literal_frame(spark, rows, "table_name string, file_pattern string, position int, column_name string")
