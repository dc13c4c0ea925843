"""Access to semi-structured extraction results (VARIANT columns)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def text_at(v: Column, *paths: str) -> Column:
    """First non-NULL of the given paths as text; JSON null counts as missing."""
    picks = [F.try_variant_get(v, f"$.{p}", "string") for p in paths]
    return picks[0] if len(picks) == 1 else F.coalesce(*picks)


def first_of(v: Column, *paths: str, default: str = "UNKNOWN") -> Column:
    return F.coalesce(*[text_at(v, p) for p in paths], F.lit(default))


def unwrap(v: Column) -> Column:
    """Content of the ``response`` envelope where there is one."""
    return F.coalesce(F.try_variant_get(v, "$.response", "variant"), v)


def texts_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "array<string>")


def fields_at(v: Column, path: str, kinds: dict[str, str]) -> Column:
    """Struct of the named fields of the object at ``path``, read in one pass over it; a field that is missing or of
    another kind is NULL, as is the struct where there is no object."""
    return F.try_variant_get(v, path, f"struct<{','.join(f'{name}:{kind}' for name, kind in kinds.items())}>")


def line_item_count(v: Column) -> Column:
    """Size of a record array, else of the longest array inside the line object; NULL without lines."""
    records = F.try_variant_get(v, "$.line_items", "array<variant>")
    columns = F.try_variant_get(v, "$.line_items", "map<string,array<string>>")
    longest = F.array_max(F.transform(F.map_values(columns), lambda a: F.size(a)))
    return F.coalesce(
        F.when(records.isNotNull(), F.size(records)),
        F.when(columns.isNotNull(), F.coalesce(longest, F.lit(0))),
    )


def error_object(message: Column) -> Column:
    return F.to_variant_object(F.struct(message.alias("error")))


def as_json(v: Column) -> Column:
    return F.to_json(v)
