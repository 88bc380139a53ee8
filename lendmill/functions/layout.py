"""One description of a nested message, used both to build and to take it apart.

A layout maps message fields to flat columns: a string names a column, a dict is
a struct, a one-element list is an array of structs. At most one array is
allowed; flattening turns each of its elements into a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

Layout = Mapping[str, object]


class Leaf(NamedTuple):
    column: str
    path: tuple[str, ...]
    in_array: bool


def layout_schema(layout: Layout, types: StructType) -> StructType:
    """Schema of the message; leaf types come from the flat table."""

    def kind(node: object) -> DataType:
        if isinstance(node, Mapping):
            return layout_schema(node, types)
        if isinstance(node, list):
            return ArrayType(kind(node[0]))
        return types[node].dataType

    return StructType([StructField(name, kind(node)) for name, node in layout.items()])


def layout_struct(layout: Layout) -> Column:
    """Struct column holding the message of a flat row.

    A leaf may also be a ``Column``, e.g. an array of documents built beforehand.
    """

    def build(node: object) -> Column:
        if isinstance(node, Mapping):
            return layout_struct(node)
        if isinstance(node, list):
            return F.array(*[build(item) for item in node])
        return node if isinstance(node, Column) else F.col(node)

    return F.struct(*[build(node).alias(name) for name, node in layout.items()])


def array_path(layout: Layout) -> tuple[str, ...] | None:
    """Where the array lies, or None for a message without one."""
    found = [path for path, node in _walk(layout) if isinstance(node, list)]
    if len(found) > 1:
        raise ValueError(f"a layout holds at most one array, got {found}")
    return found[0] if found else None


def layout_leaves(layout: Layout) -> list[Leaf]:
    """Flat columns in message order. Paths in the array start at its element."""
    leaves: list[Leaf] = []
    for path, node in _walk(layout):
        if isinstance(node, list):
            leaves += [Leaf(leaf, inner, True) for inner, leaf in _walk(node[0])]
        else:
            leaves.append(Leaf(node, path, False))
    return leaves


def narrow_layout(layout: Layout, columns: set[str]) -> dict[str, object]:
    """The layout cut down to some flat columns, so that less JSON is materialised.

    The array stays even if none of its fields is wanted: it decides how many
    rows a message yields.
    """
    kept: dict[str, object] = {}
    for name, node in layout.items():
        if isinstance(node, Mapping):
            if inner := narrow_layout(node, columns):
                kept[name] = inner
        elif isinstance(node, list):
            element = node[0]
            kept[name] = [narrow_layout(element, columns) or dict([next(iter(element.items()))])]
        elif node in columns:
            kept[name] = node
    return kept


def _walk(layout: Layout, prefix: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], object]]:
    for name, node in layout.items():
        if isinstance(node, Mapping):
            yield from _walk(node, (*prefix, name))
        else:
            yield (*prefix, name), node
