"""First-wins stores and duplicates. A hot key is summed before it is shuffled, so no task holds all of its rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key by the columns of order, ascending, nulls first; all columns as they were.

    Rows that tie on order are told apart by their other values, so the result
    does not depend on partitioning (columns of map type excepted).
    """
    rest = [c for c, t in df.dtypes if not t.startswith("map") and "variant" not in t]
    rank = F.struct(*(F.col(o).alias(f"o{k}") if isinstance(o, str) else o.alias(f"o{k}") for k, o in enumerate(order)), F.struct(*rest).alias("rest"))
    return df.groupBy(*(F.col(k).alias(f"__{k}") for k in key)).agg(F.min_by(F.struct(*df.columns), rank).alias("row")).select("row.*")


def first_seen(df: DataFrame, key: list[str], ts: str = "ts", number: str = "number") -> DataFrame:
    """One row per key: the one seen first."""
    return first_of(df, key, [ts, number])


def first_match(df: DataFrame, key: list[str], tie_break: list[str]) -> DataFrame:
    return first_of(df, key, tie_break)


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def dedupe_pk(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows with a value, the first of each primary key; null is a key value like any other."""
    return first_of(drop_all_null_rows(df), key, order)


def dedupe_exact_fields(df: DataFrame, known: DataFrame, fields: list[str]) -> DataFrame:
    """The rows of df that known does not contain: a known row matches if it equals all fields that df's row has values in.

    A known row is looked up as it looks with the fields of a row of df only, once
    for each set of fields that some row has values in (as many as occur, at most
    2 ** fields).
    """
    mask = functools.reduce(lambda a, b: a + b, [F.col(f).isNotNull().cast("int") * (1 << k) for k, f in enumerate(fields)])
    given = [r[0] for r in df.select(mask.alias("m")).distinct().collect()]  # small numbers, no rows
    if not given:
        return df
    seen = F.array(*(F.struct(*(F.when(F.lit(bool(m >> k & 1)), F.col(f)).alias(f"__{f}") for k, f in enumerate(fields))) for m in sorted(given)))
    looks = known.select(F.inline(seen)).distinct()
    return df.join(looks, functools.reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(F.col(f"__{f}")) for f in fields]), "left_anti")


def dedupe_spatial(df: DataFrame, order: list[str], position: tuple[str, ...] = ("x", "y", "z"), same: tuple[str, ...] = ("entry", "map", "create_type")) -> DataFrame:
    """The first row of each exact position with the same entry, map, create type and set of phases."""
    rows = df.withColumn("__phases", F.sort_array("phases")) if "phases" in df.columns else df.withColumn("__phases", F.lit(None))
    return first_of(rows, [*same, "__phases", *position], order).drop("__phases")


def dedupe_spatial_grid(df: DataFrame, order: list[str], cell: float = 0.02, position: tuple[str, ...] = ("x", "y", "z"), same: tuple[str, ...] = ("entry", "map", "create_type")) -> DataFrame:
    """As dedupe_spatial(), with one row for each grid cell instead of each exact position."""
    cells = {f"__{p}": F.floor(F.col(p) / cell) for p in position}
    return dedupe_spatial(df.withColumns(cells), order, tuple(cells), same).drop(*cells)


def multi_map(df: DataFrame, key: list[str], values: list[str], order: list[str]) -> DataFrame:
    """key with the list of its values in the given order: for the edge of a plan, as a key's values meet in one row."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct(*order, F.struct(*values).alias("v")))), lambda x: x["v"])
    return df.groupBy(*key).agg(listed.alias("values"))
