"""Nested JSON messages: build, take apart, synthesise.

Pure DataFrame -> DataFrame, so the same code serves batch and streams. Nothing
here shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    FractionalType,
    IntegralType,
    StringType,
    StructType,
)

from lendmill.functions import pick
from lendmill.functions.layout import (
    Layout,
    array_path,
    layout_leaves,
    layout_schema,
    layout_struct,
    narrow_layout,
)
from lendmill.schemas import FLAT, MESSAGE_LAYOUT

# What a synthetic application is made of.
REGIONS = ("DE-HE", "DE-BY", "DE-BE", "US-CA", "US-NY", "RU-MOW", "RU-SPE", "FR-IDF")
RISK_LEVELS = ("low", "medium", "high")
DECISIONS = ("approved", "rejected", "manual_review", "pending")
DOCUMENT_STATUSES = ("verified", "pending", "rejected")
DOCUMENT_TYPE = "passport"
SUBMITTED_AT = "2026-05-01T10:15:11Z"
CUSTOMERS = 9999
AMOUNTS, LOWEST_AMOUNT = 49000, 1000
TERMS, SHORTEST_TERM = 58, 6
SCORES, LOWEST_SCORE = 650, 350


def pack_messages(df: DataFrame, layout: Layout = MESSAGE_LAYOUT) -> DataFrame:
    """One JSON text per row, in a single column ``value``. Null fields are left out."""
    # The text of a struct is never null. Saying so lets Catalyst drop null checks
    # downstream, which would otherwise build the text a second time.
    body = F.coalesce(F.to_json(layout_struct(layout)), F.lit("{}"))
    return df.select(body.alias("value"))


def flatten_messages(
    messages: DataFrame,
    layout: Layout = MESSAGE_LAYOUT,
    types: StructType = FLAT,
    *,
    columns: Sequence[str] | None = None,
    corrupt_column: str | None = None,
    rescued_column: str | None = None,
) -> DataFrame:
    """Parse the column ``value`` and give one row per array element.

    A message with a null, missing or empty array gives one row with null element
    fields. Null bodies are dropped. A body that is no JSON object of this shape
    gives an all-null row, and a field of the wrong type is null while its
    siblings are kept; ``corrupt_column`` adds the raw text of such bodies, to
    split them off.

    ``rescued_column`` adds a map from places such as ``loan.amount`` or ``documents[].type`` to
    the JSON of every value of the message, or of its element, that has no column or does not
    fit into its column; null if all fit. A body that is no JSON is rescued whole under
    ``$``, and so is one that is no object. A name with a dot stands in backticks. A number fits a column of its kind if it
    is in its range, any single value fits text, and JSON null fits everywhere.

    ``columns`` limits the result, and what the JSON parser materialises, to some
    flat columns; the number of rows stays the same. The rescued values are those of the
    whole layout.
    """
    known = [leaf.column for leaf in layout_leaves(layout)]
    if columns is not None and (unknown := [c for c in columns if c not in known]):
        raise ValueError(f"columns {unknown} are not in the layout")
    if rescued_column is not None:
        if corrupt_column is not None:
            raise ValueError("what does not parse is among the rescued values already")
        return _flatten_rescuing(messages, layout, types, columns or known, rescued_column)
    if columns is not None:
        layout = narrow_layout(layout, set(columns))
    schema, options = layout_schema(layout, types), {}
    if corrupt_column is not None:
        schema = schema.add(corrupt_column, StringType())
        options = {"columnNameOfCorruptRecord": corrupt_column}

    body = F.col("value").cast("string")
    kept = [] if corrupt_column is None else [body.alias("body")]
    rows = messages.where(F.col("value").isNotNull()).select(
        F.from_json(body, schema, options).alias("message"), *kept
    )
    if array := array_path(layout):
        elements = _field("message", array)
        rows = rows.select("*", F.explode_outer(elements).alias("element"))

    fields = {
        leaf.column: _field("element" if leaf.in_array else "message", leaf.path)
        for leaf in layout_leaves(layout)
    }
    picked = [fields[c].alias(c) for c in (columns or fields)]
    if corrupt_column is not None:
        # The parser gives nothing at all for a blank body, not even its text.
        raw = F.when(F.col("message").isNull(), F.col("body"))
        picked.append(F.coalesce(_field("message", [corrupt_column]), raw).alias(corrupt_column))
    return rows.select(*picked)


# Kinds of JSON numbers, as Spark names those of a variant.
WHOLE, ANY_NUMBER = "^(BIGINT)$", "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"
NESTED = "^(OBJECT|ARRAY|VARIANT)"


def _flatten_rescuing(
    messages: DataFrame, layout: Layout, types: StructType, columns: Sequence[str], rescued: str
) -> DataFrame:
    """The body is parsed once, to a variant, from which typed values and the rest are taken."""
    body = F.col("value").cast("string")
    rows = messages.where(F.col("value").isNotNull()).select(
        F.try_parse_json(body).alias("message"), body.alias("body")
    )
    leaves, array = layout_leaves(layout), array_path(layout)
    is_object = F.schema_of_variant("message").startswith("OBJECT")
    rest = [
        F.when(
            F.coalesce(is_object, F.lit(False)), F.lit(None).cast("map<string,string>")
        ).otherwise(F.create_map(F.lit("$"), F.col("body")))
    ]
    rest += _strangers("message", layout, ())
    if array:
        found = F.try_variant_get("message", _json_path(array), "variant")
        elements = F.try_variant_get("message", _json_path(array), "array<variant>")
        rest.append(_misfit(".".join(array), found, elements.isNull() & _present(found)))
        rows = rows.withColumn("element", F.explode_outer(elements))
        place = ".".join(array) + "[]"
        node = layout
        for name in array:
            node = node[name]
        rest += _strangers("element", node[0], (), place + ".")
        whole = F.col("element")
        odd = _present(whole) & ~F.schema_of_variant(whole).startswith("OBJECT")
        rest.append(_misfit(place, whole, odd))
    picked = {}
    for leaf in leaves:
        root = "element" if leaf.in_array else "message"
        value = F.try_variant_get(root, _json_path(leaf.path), "variant")
        place = (".".join(array) + "[]." if leaf.in_array else "") + ".".join(leaf.path)
        kind = types[leaf.column].dataType
        fits = _fits(value, kind)
        typed = F.try_variant_get(root, _json_path(leaf.path), kind.simpleString())
        picked[leaf.column] = F.when(fits, typed).alias(leaf.column)
        rest.append(_misfit(place, value, _present(value) & (~fits | typed.isNull())))
    parts = F.filter(F.array(*rest), lambda part: part.isNotNull())
    entries = F.flatten(F.transform(parts, F.map_entries))
    kept = F.when(F.size(entries) > 0, F.map_from_entries(entries))
    return rows.select(*[picked[c] for c in columns], kept.alias(rescued))


def _json_path(path: Sequence[str]) -> str:
    return "$" + "".join(f"['{name}']" for name in path)


def _present(value: Column) -> Column:
    """Neither missing nor JSON null."""
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def _fits(value: Column, kind: DataType) -> Column:
    """If a JSON value is of the kind of a column; the range is left to the cast."""
    found = F.schema_of_variant(value)
    if isinstance(kind, StringType):
        return ~found.rlike(NESTED)
    if isinstance(kind, BooleanType):
        return found == "BOOLEAN"
    if isinstance(kind, IntegralType):
        return found.rlike(WHOLE)
    if isinstance(kind, (FractionalType, DecimalType)):
        return found.rlike(ANY_NUMBER)
    return found == "STRING"


def _misfit(place: str, value: Column, test: Column) -> Column:
    return F.when(test, F.create_map(F.lit(place), F.to_json(value)))


def _quoted(name: Column) -> Column:
    """A name that could be taken for a place is set in backticks."""
    marked = F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
    return F.when(name.rlike(r"[.$`\[]"), marked).otherwise(name)


def _strangers(root: str, layout: Layout, path: tuple[str, ...], prefix: str = "") -> list[Column]:
    """The fields of an object that the layout does not name, and those of its inner objects;
    also what stands in place of an inner object."""
    fields = F.try_variant_get(root, _json_path(path), "map<string,variant>")
    names = F.array(*[F.lit(name) for name in layout])
    strange = F.map_filter(fields, lambda name, _: ~F.array_contains(names, name))
    before = prefix + "".join(f"{name}." for name in path)
    texts = F.transform_values(strange, lambda _, value: F.coalesce(F.to_json(value), F.lit("null")))
    found = [F.transform_keys(texts, lambda name, _: F.concat(F.lit(before), _quoted(name)))]
    for name, node in layout.items():
        if isinstance(node, Mapping):
            inner = F.try_variant_get(root, _json_path((*path, name)), "variant")
            odd = _present(inner) & ~F.schema_of_variant(inner).startswith("OBJECT")
            found.append(_misfit(before + name, inner, odd))
            found += _strangers(root, node, (*path, name), prefix)
    return found


def _field(root: str, path: Sequence[str]) -> Column:
    return reduce(lambda column, name: column[name], path, F.col(root))


def synth_applications(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """One flat application per number, each field a function of that number."""
    n = F.col(id_column).cast("long")
    return ids.select(
        F.concat(F.lit("loan_"), n).alias("application_id"),
        F.concat(F.lit("cust_"), n % CUSTOMERS).alias("customer_id"),
        pick(REGIONS, n).alias("region"),
        (n % AMOUNTS + LOWEST_AMOUNT).cast("int").alias("loan_amount"),
        (n % TERMS + SHORTEST_TERM).cast("int").alias("term_months"),
        (n % SCORES + LOWEST_SCORE).cast("int").alias("score"),
        pick(RISK_LEVELS, n).alias("risk_level"),
        F.lit(DOCUMENT_TYPE).alias("doc_type"),
        pick(DOCUMENT_STATUSES, n).alias("doc_status"),
        pick(DECISIONS, n).alias("decision_status"),
        F.lit(SUBMITTED_AT).alias("submitted_at"),
    )


def synth_messages(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """One nested JSON application per number."""
    return pack_messages(synth_applications(ids, id_column))
