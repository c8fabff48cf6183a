"""Column names of a table fed by sources that name their fields freely.

Spark matches column names without case, and the table has columns of its own
(lineage, partition, rescue). A registry remembers for every source name which
column holds it: spellings that differ in case only share a column, a name that
the table needs itself is moved aside to ``source_<name>``, and where one record (or
one file's header) has several spellings at once, each further one gets a column of
its own, so no value is lost. The registry only grows; it is stored with the
table's commits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns that every bronze table has itself, and the prefix of internal ones.
RESERVED = ("file_path", "ingestion_time", "batch_id")
INTERNAL = "_tl_"


@dataclass
class Group:
    """Spellings of one name, by first sight, and the columns for the first, second, ... one in a record."""

    spellings: list[str]
    columns: list[str]


class ColumnNames:
    def __init__(self, state: Iterable[Sequence] = (), reserved: Iterable[str] = RESERVED) -> None:
        self.groups = {key: Group(list(spellings), list(columns)) for key, spellings, columns in state}
        self._taken = {c.lower() for c in reserved} | {c.lower() for g in self.groups.values() for c in g.columns}

    @property
    def state(self) -> list[list]:
        return [[key, g.spellings, g.columns] for key, g in self.groups.items()]

    @property
    def columns(self) -> list[str]:
        return [c for g in self.groups.values() for c in g.columns]

    def _free(self, name: str) -> str:
        if name.lower().startswith(INTERNAL) or name.lower() in self._taken:
            name = f"source_{name}"
        while name.lower() in self._taken:
            name += "_"
        self._taken.add(name.lower())
        return name

    def learn(self, names: Iterable[str]) -> None:
        for name in names:
            group = self.groups.get(name.lower())
            if group is None:
                group = self.groups[name.lower()] = Group([], [self._free(name)])
            if name not in group.spellings:
                group.spellings.append(name)

    def widen(self, key: str, places: int) -> None:
        """Columns for ``places`` spellings of a name in one record."""
        group = self.groups[key]
        while len(group.columns) < places:
            number = len(group.columns) + 1
            name = f"{group.columns[0]}_{number}"
            while name.lower() in self._taken:
                name += "_"
            self._taken.add(name.lower())
            group.columns.append(name)

    def header(self, names: Sequence[str]) -> list[str]:
        """The column of each name of a header; spellings that stand there together get a column each."""
        self.learn(names)
        together: dict[str, list[str]] = {}
        for name in names:
            together.setdefault(name.lower(), []).append(name)
        column = {}
        for key, some in together.items():
            self.widen(key, len(some))
            group = self.groups[key]
            for place, name in enumerate(sorted(some, key=group.spellings.index)):
                column[name] = group.columns[place]
        return [column[n] for n in names]

    def several(self) -> dict[str, list[str]]:
        """Names of more than one spelling."""
        return {key: g.spellings for key, g in self.groups.items() if len(g.spellings) > 1}

    def select(self, value: Callable[[str], Column]) -> list[Column]:
        """All columns of a record; ``value`` gives a spelling's value (NULL where the record lacks it)."""
        out = []
        for group in self.groups.values():
            if len(group.spellings) == 1:
                values = [value(group.spellings[0])]
            else:
                found = F.filter(F.array(*map(value, group.spellings)), lambda v: v.isNotNull())
                values = [F.get(found, place) for place in range(len(group.columns))]
            out += [v.alias(c) for v, c in zip(values, group.columns, strict=False)]
            out += [F.lit(None).cast("string").alias(c) for c in group.columns[len(values) :]]
        return out


def most_together(spellings: Iterable[str], value: Callable[[str], Column]) -> Column:
    """Aggregate: the most spellings that a record holds at once."""
    return F.max(F.size(F.filter(F.array(*map(value, spellings)), lambda v: v.isNotNull())))
