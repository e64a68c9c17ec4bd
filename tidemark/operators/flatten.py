"""One nested array of a document to one row per element."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col, names, quote
from tidemark.session import scratch_dir


def flatten(df: DataFrame, array: str, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """Parent columns, then the element's fields named `prefix + field`.

    A parent whose array is NULL or empty keeps one row with NULL child fields. A prefix
    that ends in a dot gives column names with a literal dot in them.
    """
    parents = names([c for c in df.columns if c != array])
    children = [f"{quote(array)}.{quote(f)} AS {quote(prefix + f)}" for f in fields]
    return df.selectExpr(*parents, f"explode_outer({quote(array)}) AS {quote(array)}").selectExpr(*parents, *children)


def _at(path: str, name: str) -> str:
    return f"{path}.{name}" if path else name


def _name(path: str) -> str:
    return path.rsplit(".", 1)[-1]


def _split(dtype: T.DataType, path: str, levels: Collection[str]) -> list[T.StructField]:
    """Fields of an element that become tables of their own."""
    fields = dtype if isinstance(dtype, T.StructType) else []
    return [f for f in fields if _at(path, f.name) in levels]


def _element(value: Column, dtype: T.DataType, path: str, levels: Collection[str]) -> list[Column]:
    """The fields of an element that stay with it; of an array with a table of its own, the number of its elements."""
    if not isinstance(dtype, T.StructType):
        return [value.alias(*_element_names(dtype, path, levels))]
    split = {f.name for f in _split(dtype, path, levels)}
    size = {n: F.when(value.getField(n).isNotNull(), F.size(value.getField(n))) for n in split}
    return [size.get(n, value.getField(n)).alias(out) for n, out in zip(dtype.names, _element_names(dtype, path, levels))]


def _level_types(dtype: T.StructType, levels: Sequence[str]) -> dict[str, T.DataType]:
    """The type of an element at each level, parents first."""
    found: dict[str, T.DataType] = {"": dtype}
    for path in sorted(levels, key=lambda p: p.count(".")):
        above, _, name = path.rpartition(".")
        parent = found.get(above)
        there = {f.name: f.dataType for f in parent} if isinstance(parent, T.StructType) else {}
        if not isinstance(there.get(name), T.ArrayType):
            raise ValueError(f"{path!r} is no array of {'the rows' if not above else repr(above)}; name the levels above it too")
        found[path] = there[name].elementType
    return found


def flatten_levels(df: DataFrame, keys: Sequence[str], levels: Sequence[str]) -> dict[str, DataFrame]:
    """Rows with nested arrays as one table for the rows (`""`) and one for each of `levels`: `"orders"`,
    `"orders.lines"`, several at one level or below another.

    A row of a child table has the `keys` of its row, its place in each array above it (`orders_pos`, `lines_pos`, from
    0), and its fields under the array's name (`lines_no`); a bare value is `lines_value`. In its parent stands the number
    of elements (`orders_n`; `orders_lines_n`), so an empty array (0) and none (NULL) are told apart; neither has child rows.
    A NULL element is a row of NULLs. Names that would be there twice raise a ValueError.

    `df` is read once: all tables come out of one pass without a shuffle, as partitions of one staged folder, and a
    table that is read opens its own files only.
    """
    types = _level_types(df.schema, levels)
    order = list(types)

    def row(value: Column, path: str, places: list[Column]) -> Column:
        slots = [
            F.struct(*_element(value, t, p, levels)).alias(f"__e{i}")
            if p == path
            else F.when(F.lit(False), F.struct(*_element(F.lit(None).cast(t), t, p, levels))).alias(f"__e{i}")
            for i, (p, t) in enumerate(types.items())
        ]
        return F.struct(F.lit(order.index(path)).alias("__level"), F.array(*places).cast("array<int>").alias("__places"), *slots)

    def rows(value: Column, path: str, places: list[Column]) -> Column:
        """An element's row and those of all below it."""
        found = [F.array(row(value, path, places))]
        for f in _split(types[path], path, levels):
            elements = F.coalesce(value.getField(f.name), F.array().cast(f.dataType))
            found.append(F.flatten(F.transform(elements, below(_at(path, f.name), places))))
        return F.concat(*found)

    def below(path: str, places: list[Column]) -> Callable[[Column, Column], Column]:
        return lambda element, place: rows(element, path, [*places, place])

    names_of = {p: [*keys, *_places(p), *_element_names(t, p, levels)] if p else _element_names(t, p, levels) for p, t in types.items()}
    for path, found in names_of.items():
        if twice := sorted({n for n in found if found.count(n) > 1}):
            raise ValueError(f"columns {twice} would be twice in the table of {path or 'the rows'!r}")
    carried = [col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    whole = df.select(*carried, F.struct(*names(df.columns)).alias("__row"))
    opened = whole.select(*[f"__k{i}" for i in range(len(keys))], F.explode(rows(F.col("__row"), "", [])).alias("__r"))
    path = scratch_dir(df.sparkSession, "levels")
    flat = opened.select(*[f"__k{i}" for i in range(len(keys))], "__r.*")
    flat.write.mode("errorifexists").partitionBy("__level").parquet(path)
    staged = df.sparkSession.read.schema(flat.schema).parquet(path)
    tables = {}
    for i, p in enumerate(order):
        lead = [F.col(f"__k{j}").alias(k) for j, k in enumerate(keys)] if p else []
        lead += [F.col("__places")[j].alias(n) for j, n in enumerate(_places(p))]
        tables[p] = staged.where(F.col("__level") == i).select(*lead, f"__e{i}.*")
    return tables


def _places(path: str) -> list[str]:
    return [f"{name}_pos" for name in path.split(".")] if path else []


def _element_names(dtype: T.DataType, path: str, levels: Collection[str]) -> list[str]:
    prefix, split = f"{_name(path)}_" if path else "", {f.name for f in _split(dtype, path, levels)}
    return [f"{prefix}{n}_n" if n in split else prefix + n for n in dtype.names] if isinstance(dtype, T.StructType) else [f"{prefix}value"]
