"""XML columns to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def shred(df: DataFrame, column: str, node: str, attributes: dict[str, str], subtree: str | None = None) -> DataFrame:
    """One row per ``node`` element below the root, one column per attribute.

    ``attributes`` maps attribute names to types; ``subtree`` names a column for
    the element itself as XML text.
    """
    inner = ",".join(f"_{name}:{kind}" for name, kind in attributes.items())
    parsed = F.from_xml(F.col(column), f"struct<{node}:array<struct<{inner}>>>")
    rows = df.withColumn("_node", F.explode(parsed[node]))
    found = [F.col(f"_node._{name}").alias(name) for name in attributes]
    if subtree:
        found.append(element(node, {name: F.col(f"_node._{name}") for name in attributes}).alias(subtree))
    return rows.select(*[F.col(c) for c in df.columns if c != column], *found)


def element(node: str, attributes: dict[str, Column]) -> Column:
    """An empty element with attributes as XML text."""
    parts: list[Column] = [F.lit(f"<{node}")]
    for name, value in attributes.items():
        parts += [F.lit(f' {name}="'), _escaped(value.cast("string")), F.lit('"')]
    return F.concat(*parts, F.lit("/>"))


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text
