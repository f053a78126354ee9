"""Tables that say what they are made from: built in that order, named where a source is missing, kept where nothing changed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources import versions

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Table:
    """A stored table: its sources, files or other tables, and the function that makes it from them.

    ``settings`` are what else its rows depend on, besides its sources and the code of this package.
    """

    name: str
    sources: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    settings: str = ""


def in_order(tables: Iterable[Table], files: Iterable[str]) -> list[Table]:
    """The tables, each behind its sources. Names every source that nothing provides, or the tables of a circle."""
    waiting, known = {t.name: t for t in tables}, set(files)
    missing = {f"{t.name} needs {s}" for t in waiting.values() for s in t.sources if s not in known and s not in waiting}
    if missing:
        raise ValueError(f"missing sources: {'; '.join(sorted(missing))}")
    ordered: list[Table] = []
    while waiting:
        ready = [t for t in waiting.values() if known.issuperset(t.sources)]
        if not ready:
            raise ValueError(f"tables made from each other: {', '.join(sorted(waiting))}")
        ordered += ready
        known.update(t.name for t in ready)
        waiting = {name: t for name, t in waiting.items() if name not in known}
    return ordered


def code_mark() -> str:
    """A digest of the package's own modules: with other code, every table is made anew."""
    package = Path(__file__).parents[1]
    modules = sorted(p for p in package.rglob("*.py") if p.relative_to(package).parts[0] != "llm")
    return hashlib.sha256(b"\0".join(p.read_bytes() for p in modules)).hexdigest()


def fingerprints(ordered: Iterable[Table], files: Mapping[str, str], code: str) -> dict[str, str]:
    """What each table's rows depend on, as a digest: its sources' digests, its settings and the code."""
    found = dict(files)
    for t in ordered:
        parts = [code, t.name, t.settings, *[found[s] for s in t.sources]]
        found[t.name] = hashlib.sha256("\n".join(parts).encode()).hexdigest()
    return found


class _Built(dict):
    """Sources by name; a file is opened when a table that is rebuilt asks for it."""

    def __init__(self, opened: Callable[[str], DataFrame]):
        super().__init__()
        self.opened = opened

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.opened(name)
        return self[name]


def build(
    spark: SparkSession, base: str, tables: Iterable[Table], files: Mapping[str, str | None], opened: Callable[[str], DataFrame]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Bring all tables below ``base`` up to date; (tables by name, names of those that were rebuilt).

    ``files`` has a fingerprint for each file, None for one that is not there: then no job is started. ``opened`` reads one.
    """
    there = {name: mark for name, mark in files.items() if mark is not None}
    ordered = in_order(tables, there)
    marks = fingerprints(ordered, there, code_mark())
    stored, rebuilt = _Built(opened), []
    for t in ordered:
        pointer = versions.read_pointer(spark, f"{base}/{t.name}")
        if pointer and pointer["made_from"] == marks[t.name]:
            stored[t.name] = versions.read_table(spark, f"{base}/{t.name}")
        else:
            stored[t.name] = versions.replace_table(t.build(stored), f"{base}/{t.name}", marks[t.name])
            rebuilt.append(t.name)
    return {t.name: stored[t.name] for t in ordered}, rebuilt
