"""JSON documents: access, containment, path tests, type dispatch (F-11 to F-16, F-20)."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"


def get_json(doc: Column, path: str) -> Column:
    """``->``: the part as JSON text, quotes kept."""
    return F.to_json(F.try_variant_get(F.parse_json(doc), path, "variant"))


def get_text(doc: Column, path: str) -> Column:
    """``->>``: the part as plain text."""
    return F.get_json_object(doc, path)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _elements(v: Column) -> Column:
    return F.when(_kind(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def _same_scalar(v: Column, want) -> Column:
    if want is None:
        return F.is_variant_null(v)
    if isinstance(want, bool):
        return (_kind(v) == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(want))
    if isinstance(want, (int, float)):
        return _kind(v).rlike(_NUMBER) & (F.try_variant_get(v, "$", "double") == F.lit(float(want)))
    return (_kind(v) == "STRING") & (F.try_variant_get(v, "$", "string") == F.lit(want))


def _any_holds(items: Column, want) -> Column:
    return F.exists(items, lambda e: F.coalesce(_holds(e, want), F.lit(False)))


def _holds(v: Column, want, top: bool = False) -> Column:
    if isinstance(want, dict):
        tests = [_kind(v).startswith("OBJECT")]
        for key, sub in want.items():
            tests.append(_holds(F.try_variant_get(v, f'$["{key}"]', "variant"), sub))
        return reduce(lambda a, b: a & b, tests)
    if isinstance(want, list):
        items = _elements(v)
        tests = [items.isNotNull()]
        for sub in want:
            tests.append(_any_holds(items, sub))
        return reduce(lambda a, b: a & b, tests)
    same = _same_scalar(v, want)
    if top:
        return same | F.exists(_elements(v), lambda e: _same_scalar(e, want))
    return same


def contains(doc: Column, pattern) -> Column:
    """``@>``: every part of the pattern occurs in the document, arrays as sets (F-13).

    ``pattern`` is JSON text or the Python value; the test is built once, on
    the driver, as an expression over the parsed document.
    """
    want = json.loads(pattern) if isinstance(pattern, str) else pattern
    return F.coalesce(_holds(F.parse_json(doc), want, top=True), F.lit(False))


def has_key(doc: Column, key: str, path: str = "$") -> Column:
    """``?``: a top-level key of an object, or a string element of an array (F-14)."""
    part = F.parse_json(doc) if path == "$" else F.try_variant_get(F.parse_json(doc), path, "variant")
    keys = F.json_object_keys(F.to_json(part))
    in_object = F.when(_kind(part).startswith("OBJECT"), F.array_contains(keys, key))
    in_array = F.exists(_elements(part), lambda e: _same_scalar(e, key))
    return F.coalesce(in_object, in_array, F.lit(False))


def elements(doc: Column, path: str) -> Column:
    """The elements of a JSON array as variants, ready for ``explode`` (F-12)."""
    return F.try_variant_get(F.parse_json(doc), path, "array<variant>")


_TEST = re.compile(r"^\s*(\$[^\s=!<>]*)\s*(==|!=|<>|<=|>=|<|>)\s*(.+?)\s*$")


def path_is(doc: Column, test: str) -> Column:
    """``$.path op literal`` is true (F-15); a missing path or another type is not."""
    found = _TEST.match(test)
    if not found:
        raise ValueError(f"not a path test: {test}")
    path, op, literal = found.group(1), found.group(2), json.loads(found.group(3))
    v = F.try_variant_get(F.parse_json(doc), path, "variant")
    if op in ("==", "!=", "<>"):
        same = F.coalesce(_same_scalar(v, literal), F.lit(False))
        return same if op == "==" else v.isNotNull() & ~same
    typed, cast = ((_kind(v) == "STRING", "string") if isinstance(literal, str)
                   else (_kind(v).rlike(_NUMBER), "double"))
    value = F.try_variant_get(v, "$", cast)
    lit = F.lit(literal if isinstance(literal, str) else float(literal))
    outcome = {"<": value < lit, "<=": value <= lit, ">": value > lit, ">=": value >= lit}[op]
    return F.coalesce(typed & outcome, F.lit(False))


def dispatch(v: Column) -> Column:
    """By type: number squared, text upper-cased, list sorted, anything else marked (F-20)."""
    items = F.try_variant_get(v, "$", "array<string>")
    return (F.when(_kind(v) == "BIGINT", (F.try_variant_get(v, "$", "bigint") * F.try_variant_get(v, "$", "bigint")).cast("string"))
            .when(_kind(v) == "STRING", F.upper(F.try_variant_get(v, "$", "string")))
            .when(_kind(v).startswith("ARRAY"), F.array_join(F.array_sort(items), ","))
            .otherwise(F.concat(F.lit("generic: "), F.to_json(v))))


def type_class(v: Column) -> Column:
    """``number``, ``text``, ``collection`` or ``other``."""
    return (F.when(_kind(v).rlike(_NUMBER), "number").when(_kind(v) == "STRING", "text")
            .when(_kind(v).rlike("^(ARRAY|OBJECT)"), "collection").otherwise("other"))
