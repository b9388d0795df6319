"""Sinks: per-type CSV / JSON lines, N-Triples.

CSV cannot hold arrays or structs, so ``serialize_columns`` first applies the
per-column serializers (K4): a name struct becomes ``"Last, First"``, a name
list becomes ``[[first,last],...]`` JSON, other arrays/structs become JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarweave.functions.names import name_label, names_to_lists
from scholarweave.operators.triples import PREFIXES, n3_lines, ntriples_lines


def _is_name(dt: T.DataType) -> bool:
    return isinstance(dt, T.StructType) and [f.name for f in dt.fields] == ["firstname", "lastname"]


def serializer_for(field: T.StructField) -> Column:
    """Column serializer by type."""
    c, dt = F.col(f"`{field.name}`"), field.dataType
    if _is_name(dt):
        return name_label(c)
    if isinstance(dt, T.ArrayType) and _is_name(dt.elementType):
        return F.to_json(names_to_lists(c))
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c


def serialize_columns(df: DataFrame, overrides: dict[str, Column] | None = None) -> DataFrame:
    """Apply serializers to every column; ``overrides`` replaces a column's serializer."""
    overrides = overrides or {}
    return df.select(*[(overrides.get(f.name, serializer_for(f))).alias(f.name) for f in df.schema.fields])


def entity_path(out_dir: str, source: str, item_type: str) -> str:
    """``<out>/<source>_<ItemType>`` (K1)."""
    return f"{out_dir.rstrip('/')}/{source}_{item_type}"


def write_entities(df: DataFrame, out_dir: str, source: str, item_type: str, fmt: str = "csv") -> str:
    """Write one item type of one source; replaces only that source's output (K1, K2, K3)."""
    path = entity_path(out_dir, source, item_type)
    w = serialize_columns(df).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)   # JSON lines keep arrays and structs as they are
    else:
        raise ValueError(f"unknown format {fmt}")
    return path


def write_ntriples(triples: DataFrame, path: str) -> str:
    """N-Triples text files; part files concatenate into one valid graph (K5)."""
    ntriples_lines(triples).write.mode("overwrite").text(path)
    return path


def write_n3(triples: DataFrame, path: str) -> str:
    """N3 text files with short predicates; the first part holds the prefix bindings, and only it (K5, K7).

    The parts in the order of their names are one valid document.  Bindings and triples are written by
    one job, so its commit publishes all of them or none.
    """
    head = triples.sparkSession.createDataFrame([(line,) for line in prefix_lines()], "line string").coalesce(1)
    head.union(n3_lines(triples)).write.mode("overwrite").text(path)
    return path


def prefix_lines() -> list[str]:
    """Turtle/N3 prefix bindings foaf/core/ero/vcard (LOCAL is not bound) (K7)."""
    return [f"@prefix {k}: <{v}> ." for k, v in PREFIXES.items()]
