"""Descriptions of relational tables: columns, key, versions and locales in which they are visible, arrays as numbered columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALL_VERSIONS = (1 << 63) - 1


@dataclass(frozen=True)
class Column:
    """One column. slots > 1: an array kept as name1..nameN, or name0.. with base 0. versions: a bit mask."""

    name: str
    type: T.DataType
    key: bool = False
    slots: int = 1
    base: int = 1
    versions: int = ALL_VERSIONS
    locale: str | None = None
    nullable: bool = True

    def numbered(self) -> list[str]:
        return [self.name] if self.slots == 1 else [f"{self.name}{i + self.base}" for i in range(self.slots)]


@dataclass(frozen=True)
class TableSpec:
    """A table: where it goes, what it holds, which column records the build of the observation."""

    name: str
    columns: tuple[Column, ...]
    target: str = "world"
    versions: int = ALL_VERSIONS
    build: str | None = None
    defaults: dict = field(default_factory=dict)

    @property
    def key(self) -> list[str]:
        return [c.name for c in self.columns if c.key]

    @property
    def values(self) -> list[str]:
        return [c.name for c in self.columns if not c.key]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, c.nullable) for c in self.columns])


def visible(spec: TableSpec, version: int, locale: str | None = None) -> list[Column]:
    """The columns of spec for one version bit and locale; none where the table itself isn't there.

    A name that is visible more than once is an error.
    """
    if not spec.versions & version:
        return []
    found = [c for c in spec.columns if c.versions & version and (c.locale is None or c.locale == locale)]
    if len({c.name for c in found}) != len(found):
        raise ValueError(f"{spec.name}: a column has more than one visible definition")
    return found


def project_for_version(df: DataFrame, spec: TableSpec, version: int, locale: str | None = None) -> DataFrame:
    """df with the columns that version and locale show; no column where the table is hidden."""
    return df.select(*(c.name for c in visible(spec, version, locale)))


def expand_arrays(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Array columns as numbered columns, null where the array is shorter."""
    out = []
    for c in spec.columns:
        out += [F.col(c.name)] if c.slots == 1 else [F.get(F.col(c.name), i).alias(n) for i, n in enumerate(c.numbered())]
    return df.select(*out)


def collapse_arrays(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Numbered columns as array columns."""
    return df.select(*(F.col(c.name) if c.slots == 1 else F.array(*c.numbered()).alias(c.name) for c in spec.columns))


def table_defaults(catalog: DataFrame, spec: TableSpec) -> DataFrame:
    """The defaults of a table as one row, from catalog rows (table_name, column_name, column_default as text); numbered columns go to their array slot."""
    own = catalog.where(F.col("table_name") == spec.name)
    slot = F.regexp_extract("column_name", r"^([A-Za-z_-]+)(\d+)$", 2)
    rows = own.select("column_name", "column_default", slot.alias("slot"))
    pick = lambda n: F.max(F.when(F.col("column_name") == n, F.col("column_default")))
    out = []
    for c in spec.columns:
        if c.slots == 1:
            out.append(pick(c.name).cast(c.type).alias(c.name))
        else:
            out.append(F.array(*(pick(n).cast(c.type.elementType) for n in c.numbered())).alias(c.name))
    return rows.agg(*out)
