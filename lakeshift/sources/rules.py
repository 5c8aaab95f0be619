"""Filter rules: an INI file with exact and pattern entries, as objects and as rows."""

from __future__ import annotations

import configparser
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakeshift.functions.text import posix_regex

#: The sections of a rule file.
SECTIONS = ("include-only-schema", "exclude-schema", "include-only-table", "exclude-table", "exclude-table-data", "exclude-index", "include-only-extension", "exclude-extension")
SCHEMA_SECTIONS = ("include-only-schema", "exclude-schema", "include-only-extension", "exclude-extension")
#: Delimiters of patterns, what opens and what closes.
DELIMITERS = {"/": "/", "[": "]", "{": "}", "(": ")", "<": ">", '"': '"', "'": "'", "|": "|", "#": "#", "$": "$"}
ROWS = "section string, nspname string, nspname_re string, relname string, relname_re string"
#: What a selection asks for when its complement is wanted.
COMPLEMENT = {"include": "not-included", "exclude": "excluded", "exclude-index": "excluded-index", "not-included": "include", "excluded": "exclude", "excluded-index": "exclude-index", "none": "none"}


class RuleError(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    """One entry: for the schema and the relation either a name or a pattern; no relation in schema sections."""

    section: str
    nspname: str | None = None
    nspname_re: str | None = None
    relname: str | None = None
    relname_re: str | None = None

    @property
    def match_class(self) -> str:
        """E (exact) or R (pattern) for the schema and the relation, as in ER."""
        return ("R" if self.nspname_re is not None else "E") + ("R" if self.relname_re is not None else "E")


@dataclass
class Rules:
    rules: list[Rule] = field(default_factory=list)

    def of(self, section: str) -> list[Rule]:
        return [r for r in self.rules if r.section == section]

    @property
    def kind(self) -> str:
        """include, exclude, exclude-index or none; includes and excludes of tables can't be mixed."""
        has = {r.section for r in self.rules}
        if "include-only-table" in has and {"exclude-schema", "exclude-table"} & has:
            raise RuleError("include-only-table can't be used with exclude-schema or exclude-table")
        if "include-only-schema" in has and "exclude-schema" in has:
            raise RuleError("include-only-schema can't be used with exclude-schema")
        if "include-only-extension" in has and "exclude-extension" in has:
            raise RuleError("include-only-extension can't be used with exclude-extension")
        if "include-only-table" in has:
            return "include"
        if {"include-only-schema", "exclude-schema", "exclude-table", "exclude-table-data"} & has:
            return "exclude"
        return "exclude-index" if "exclude-index" in has else "none"

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r.section, r.nspname, r.nspname_re, r.relname, r.relname_re) for r in self.rules], ROWS)


def is_pattern(entry: str) -> bool:
    """Whether a ~ stands outside double quotes."""
    return any("~" in part for part in entry.split('"')[::2])


def delimited(entry: str, at: int) -> tuple[str, int]:
    """The pattern that begins with ~ at a place, and where it ends."""
    if entry[at : at + 1] != "~" or entry[at + 1 : at + 2] not in DELIMITERS:
        raise RuleError(f"a pattern is ~ and a delimiter, not {entry[at:]!r}")
    close = entry.find(DELIMITERS[entry[at + 1]], at + 2)
    if close < 0:
        raise RuleError(f"unterminated pattern {entry!r}")
    return entry[at + 2 : close], close + 1


def pattern(entry: str, at: int = 0) -> tuple[str, int]:
    """Patterns one after another are one pattern, checked."""
    out = ""
    while at < len(entry) and entry[at] == "~":
        part, at = delimited(entry, at)
        out += part
    try:
        posix_regex(out)
    except (ValueError, KeyError) as e:
        raise RuleError(f"bad pattern {out!r}: {e}") from e
    return out, at


def name(entry: str, at: int = 0) -> tuple[str, int]:
    """A bare or quoted name, raw, up to a dot or the end."""
    if entry[at : at + 1] == '"':
        m = re.compile(r'"((?:[^"]|"")+)"').match(entry, at)
        if not m:
            raise RuleError(f"unterminated quoted name in {entry!r}")
        return m[1].replace('""', '"'), m.end()
    end = entry.find(".", at)
    end = len(entry) if end < 0 else end
    if end == at:
        raise RuleError(f"empty name in {entry!r}")
    return entry[at:end], end


def parse_table(section: str, entry: str) -> Rule:
    """schema.table, where either is a name or a pattern."""
    found: dict[str, str] = {}
    at = 0
    for part in ("nspname", "relname"):
        if entry[at : at + 1] == "~":
            found[f"{part}_re"], at = pattern(entry, at)
        else:
            found[part], at = name(entry, at)
        if part == "nspname":
            if entry[at : at + 1] != ".":
                raise RuleError(f"{entry!r} in [{section}] lacks a schema or a table")
            at += 1
    if at != len(entry):
        raise RuleError(f"{entry[at:]!r} is left over in {entry!r}")
    return Rule(section, **found)


def parse_schema(section: str, entry: str) -> Rule:
    if is_pattern(entry):
        text, at = pattern(entry)
        if at != len(entry):
            raise RuleError(f"{entry[at:]!r} is left over in {entry!r}")
        return Rule(section, nspname_re=text)
    text, at = name(entry)
    return Rule(section, nspname=text if at == len(entry) else entry)


def parse_rules(text: str) -> Rules:
    """Rules of an INI text: entries without values, comments by ; and # at the start of a line."""
    ini = configparser.RawConfigParser(allow_no_value=True, delimiters=("\x00",), comment_prefixes=(";", "#"), strict=False)
    ini.optionxform = str
    ini.read_string(text)
    if unknown := set(ini.sections()) - set(SECTIONS):
        raise RuleError(f"unknown sections {sorted(unknown)}")
    rules = Rules([(parse_schema if s in SCHEMA_SECTIONS else parse_table)(s, e.strip()) for s in SECTIONS if ini.has_section(s) for e in ini.options(s)])
    _ = rules.kind
    return rules


def read_rules(path: str) -> Rules:
    with open(path, encoding="utf-8") as f:
        return parse_rules(f.read())
