"""Structs to flat columns, arrays to rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fields of an order item, their names and types in silver.
ITEM_FIELDS = {
    "name": ("item__name", None),
    "price": ("item__price", "double"),
    "qty": ("item__quantity", "int"),
    "sku": ("item__sku", None),
}


def _leaves(struct: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in struct.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten_structs(df: DataFrame, sep: str = "__") -> DataFrame:
    """Every struct leaf as a top-level column named by its joined path."""
    def reach(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{part}`" for part in path))

    return df.select(*[reach(p).alias(sep.join(p)) for p in _leaves(df.schema)])


def explode_items(df: DataFrame, array: str, fields: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """One row per array element; parents with a null or empty array keep one row."""
    kept = [c for c in df.columns if c != array]
    rows = df.select(*kept, F.explode_outer(array).alias("_element"))
    picked = []
    for source, (name, dtype) in fields.items():
        value = F.col("_element")[source]
        picked.append((value.cast(dtype) if dtype else value).alias(name))
    return rows.select(*kept, *picked)


def flatten_orders(documents: DataFrame) -> DataFrame:
    return explode_items(flatten_structs(documents), "items", ITEM_FIELDS)
