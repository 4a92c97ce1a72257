"""What a consumer may see: no column derived from a hidden one, no row after the day, nested by subject.

A frame is judged by its analysed plan before it runs. Hidden are all columns of its sources with a hidden name;
whatever is made of them, by renaming, an expression, an aggregate, a window or a generator, is hidden, too.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Leak(Exception):
    """An output derives from a hidden column."""


class Unbounded(Exception):
    """A source is read without its bound in time."""


def _items(seq) -> Iterator:
    return (seq.apply(k) for k in range(seq.size()))


def _id(attribute) -> int:
    return attribute.exprId().id()


def _references(expression) -> set[int]:
    return {_id(a) for a in _items(expression.references().toSeq())}


def _hidden_ids(plan, hidden: set[str]) -> set[int]:
    """Ids of all attributes in ``plan`` that derive from hidden names at its leaves."""
    children = list(_items(plan.children()))
    if not children:
        return {_id(a) for a in _items(plan.output()) if a.name() in hidden}
    found: set[int] = set()
    for child in children:
        found |= _hidden_ids(child, hidden)
    below = {_id(a) for child in children for a in _items(child.output())}
    outputs = list(_items(plan.output()))
    if plan.nodeName() in ("Union", "Intersect", "Intersect All", "Except", "Except All"):  # columns by their place
        for child in children:
            found |= {_id(mine) for mine, theirs in zip(outputs, _items(child.output()), strict=True) if _id(theirs) in found}
        return found
    inner = any(_id(a) in _hidden_ids(sub, hidden) for sub in _items(plan.subqueries()) for a in _items(sub.output()))
    used: set[int] = set()
    for expression in _items(plan.expressions()):
        own = _references(expression)
        used |= own
        if expression.getClass().getSimpleName() == "Alias" and (inner or own & found):
            found.add(_id(expression))
            below.add(_id(expression))
        elif expression.getClass().getSimpleName() == "Alias":
            below.add(_id(expression))
    # what else is new here, as a generator's columns: hidden if anything that the node reads is
    found |= {_id(a) for a in outputs if _id(a) not in below and (inner or used & found)}
    return found


def hidden_outputs(df: DataFrame, hidden: set[str]) -> list[str]:
    """The output columns of ``df`` that derive from columns named ``hidden``. Rows may be chosen by hidden columns."""
    plan = df._jdf.queryExecution().analyzed()
    found = _hidden_ids(plan, set(hidden))
    return [a.name() for a in _items(plan.output()) if _id(a) in found]


def shown(df: DataFrame, hidden: set[str]) -> DataFrame:
    """``df``, if nothing in it is hidden."""
    if bad := hidden_outputs(df, hidden):
        raise Leak(f"hidden columns reach: {', '.join(bad)}")
    return df


def assembled(subjects: DataFrame, parts: dict[str, tuple[DataFrame, list[str]]], key: str, hidden: set[str], asked: DataFrame | None = None) -> DataFrame:
    """``subjects`` (one row a ``key``) with an array for each of ``parts`` (frame, order): its rows of the subject in that
    order, empty where there are none. Everything is :func:`shown`; of ``asked`` (key), who is unknown raises.

    A subject's arrays are its view: as long as what it did, and made by one shuffle for each part."""
    if asked is not None:
        if lost := asked.select(key).distinct().join(subjects.select(key), key, "left_anti").head(3):
            raise KeyError(f"no subject: {', '.join(str(r[0]) for r in lost)}")
        subjects = subjects.join(asked.select(key).distinct(), key, "left_semi")
    out = shown(subjects, hidden)
    for name, (part, order) in parts.items():
        rest = [c for c in part.columns if c not in (key, *order)]
        rows = shown(part, hidden).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *rest))).alias(name))
        out = out.join(rows, key, "left").withColumn(name, F.coalesce(name, F.array().cast(rows.schema[name].dataType)))
    return out


class AsOf:
    """Sources as they were known at the end of a day.

    ``dated`` names for each table the column that its rows are dated by; ``timeless`` tables hold nothing that comes to be
    known. A frame built on other reads is refused by :meth:`checked`, before it runs.
    """

    MARK = "__as_of"

    def __init__(self, day: str, dated: dict[str, tuple[DataFrame, str]], timeless: dict[str, DataFrame] | None = None):
        self.day, self.dated, self.timeless = day, dated, timeless or {}
        for name, (df, column) in dated.items():
            if column not in df.columns:
                raise Unbounded(f"table '{name}' has no column {column}")

    def bound(self, column: str) -> Column:
        """On or before the day; without a function over the column, so that it reaches the scan."""
        return F.col(column) < F.date_add(F.lit(self.day).cast("date"), 1).cast("timestamp")

    def read(self, name: str) -> DataFrame:
        if name in self.timeless:
            return self.timeless[name].alias(self.MARK)
        if name not in self.dated:
            raise Unbounded(f"table '{name}' has no date to be bound by")
        df, column = self.dated[name]
        return df.where(self.bound(column)).alias(self.MARK)

    def checked(self, df: DataFrame) -> DataFrame:
        """``df``, if every source in its plan came through :meth:`read`."""

        def open_leaves(plan) -> Iterator[str]:
            if plan.nodeName() == "SubqueryAlias" and plan.alias() == self.MARK:
                return
            children = list(_items(plan.children()))
            if not children and plan.nodeName() not in ("OneRowRelation", "LocalRelation", "Range"):
                yield ", ".join(a.name() for a in _items(plan.output()))
            for child in (*children, *_items(plan.subqueries())):
                yield from open_leaves(child)

        for leaf in open_leaves(df._jdf.queryExecution().analyzed()):
            raise Unbounded(f"a source is read without its bound: {leaf}")
        return df
