"""The set and graph computations of a packager: dependency closure, deny list, comparison of two version lists."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Edges that a step of the closure follows.
HOPS = 4


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``name`` of every package that ``roots`` (name) need through ``edges`` (name, needs), the roots included.

    A step follows ``HOPS`` edges from the names found last and drops those that were seen, so a cycle ends.  A step is
    one checkpoint, of the names that it found; the edges are cut once, so their source is read once.
    """
    from ..plans.steps import cut

    edges = cut(edges.select("name", "needs").where("name is not null and needs is not null and name <> needs").distinct())
    seen = new = cut(roots.select("name").where("name is not null").distinct())
    while not new.isEmpty():
        reached, found = new, []
        for _ in range(HOPS):
            reached = reached.join(edges, "name").select(F.col("needs").alias("name")).distinct()
            found.append(reached.select(F.struct("name").alias("r")))
        new = cut(reduce(DataFrame.union, found).select("r.name").distinct().join(seen, "name", "left_anti"))
        seen = seen.union(new)
    return seen


def without(installed: DataFrame, denied: DataFrame) -> DataFrame:
    """The rows of ``installed`` whose name isn't denied."""
    return installed.join(denied.select("name"), "name", "left_anti")


def version_key(column):
    """A version's numbers as an array that compares part by part."""
    return F.transform(F.split(column, r"[^0-9]+"), lambda x: F.coalesce(x.try_cast("bigint"), F.lit(0)))


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """``name``, ``old_version``, ``new_version``, ``change`` of two lists (name, version): added, removed, upgraded, downgraded, same."""
    o = old.select("name", F.col("version").alias("old_version"))
    n = new.select("name", F.col("version").alias("new_version"))
    a, b = version_key(F.col("old_version")), version_key(F.col("new_version"))
    change = F.when(F.col("old_version").isNull(), "added").when(F.col("new_version").isNull(), "removed").when(a < b, "upgraded").when(a > b, "downgraded").otherwise("same")
    return o.join(n, "name", "full_outer").select("name", "old_version", "new_version", change.alias("change"))


def needs_major(old: DataFrame, new: DataFrame) -> bool:
    """Does the next release break its users: is a package gone or older?"""
    return not compare(old, new).where(F.col("change").isin("removed", "downgraded")).isEmpty()


@dataclass(frozen=True, order=True)
class Version:
    """Four numbers that compare from the left; what is left out is zero."""

    numbers: tuple[int, int, int, int]

    @staticmethod
    def of(text: str) -> Version:
        parts = text.split(".")
        if len(parts) > 4 or not all(p.isdecimal() for p in parts):
            raise ValueError(f"'{text}' is no version of up to four numbers")
        return Version(tuple([*map(int, parts), 0, 0, 0][:4]))  # type: ignore[arg-type]

    def raised(self, place: int) -> Version:
        """The next version: the number at ``place`` (0 to 3) is raised, those after it are zero."""
        return Version(tuple(x if k < place else x + 1 if k == place else 0 for k, x in enumerate(self.numbers)))  # type: ignore[arg-type]

    def __str__(self) -> str:
        return ".".join(map(str, self.numbers))


def next_version(version: str, major: bool) -> str:
    """A breaking release raises the first number, another one the second."""
    return str(Version.of(version).raised(0 if major else 1))
