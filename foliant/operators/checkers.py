"""Checkers as plug-ins: functions of one model of a run's documents, kept in order in a registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators import document
from foliant.operators.qa import FAULTS
from foliant.sources.scratch import saved


@dataclass(frozen=True)
class Model:
    """documents, pages, items (with types and texts), cells and sections as in operators.document, and what an earlier run had of pages and items."""

    documents: DataFrame
    pages: DataFrame
    items: DataFrame
    cells: DataFrame
    sections: DataFrame
    old_pages: DataFrame
    old_items: DataFrame


Check = Callable[[Model], DataFrame]


@dataclass
class Checkers:
    """Checkers by name, in the order in which they were added; a name that is added again is replaced in place."""

    checks: dict[str, Check] = field(default_factory=dict)

    def add(self, name: str, check: Check | None = None):
        """Adds a check; without one, a decorator. A check gives doc_id, page_index, item, severity and reason; what it lacks is null, page 0, a warning."""
        if check is None:
            return lambda f: self.add(name, f)
        self.checks[name] = check
        return check

    def without(self, *names: str) -> Checkers:
        return Checkers({n: c for n, c in self.checks.items() if n not in names})

    def __iter__(self) -> Iterator[tuple[str, Check]]:
        return iter(self.checks.items())


def _shaped(found: DataFrame, name: str) -> DataFrame:
    default = {"page_index": F.lit(0), "item": F.lit(None), "severity": F.lit("warning"), "reason": F.lit(name)}
    col = lambda c, kind: (F.col(c) if c in found.columns else default[c]).cast(kind).alias(c)
    return found.select("doc_id", F.lit(name).alias("checker"), col("page_index", "int"), col("item", "string"), col("severity", "string"), col("reason", "string"))


def findings(model: Model, checkers: Checkers) -> DataFrame:
    """The findings of all checkers with checker_order. Each is run here and now, so that one with a fault becomes an error finding of every document and the others still count."""
    out = []
    for i, (name, check) in enumerate(checkers):
        try:
            found = saved(_shaped(check(model), name), f"findings-{name}")
        except FAULTS as e:
            found = _shaped(model.documents.select("doc_id", F.lit("error").alias("severity"), F.lit(f"check failed: {type(e).__name__}").alias("reason")), name)
        out.append(found.withColumn("checker_order", F.lit(i)))
    return reduce(DataFrame.unionByName, out)


def standard() -> Checkers:
    """The seven checkers, in their order, in a registry of one's own to add to."""
    c = Checkers()
    c.add("schema", lambda m: document.check_schema(m.documents, m.pages))
    c.add("sums", lambda m: document.check_sums(m.cells))
    c.add("sections", lambda m: document.check_sections(m.sections))
    c.add("quality", lambda m: document.check_quality(m.pages))
    c.add("balance", lambda m: document.check_balance(m.items, m.cells))
    c.add("references", lambda m: document.check_references(m.items, m.sections))
    c.add("snapshot", lambda m: document.check_snapshot(m.pages, m.items, m.old_pages, m.old_items))
    return c
