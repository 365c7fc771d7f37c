"""Readable one-line summaries of the JSON findings in audit rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHECKS = "struct<column:string,check:string,failed:string,more:bigint>"
DRIFT_ITEMS = "struct<domain:string,metric:string,note:string,more:bigint>"
CLUSTERS = "struct<size:bigint,max_similarity:double,more:bigint,max_size:bigint>"
RAW_LIST = "array<string>"


def parse_json_or_default(value: Column, schema: str, default: Column) -> Column:
    """Parsed JSON; the default for null, blank, malformed text or the wrong outer shape."""
    opening = "{" if schema.startswith("map") else "["
    shaped = F.when(F.ltrim(value).startswith(opening), value)
    return F.coalesce(F.from_json(shaped, schema), default.cast(schema))


def parse_items(value: Column, item: str) -> Column:
    """The items of a JSON list in order, null for each that is no object.

    Items are taken as raw text first, so one of another kind leaves the others readable.
    """
    raw = parse_json_or_default(value, RAW_LIST, F.array())
    return F.transform(raw, lambda r: F.when(F.ltrim(r).startswith("{"), F.from_json(r, item)))


def _or(value: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(fallback))


def _total(items: Column) -> Column:
    """Number of findings; an entry ``{"more": k}`` stands for k of them."""
    return F.aggregate(
        items, F.lit(0).cast("bigint"), lambda acc, i: acc + F.coalesce(i["more"], F.lit(1))
    )


def _first_three(items: Column, render: Callable[[Column], Column]) -> Column:
    """The objects among the first three items; a plain count when there is none."""
    shown = F.filter(F.slice(items, 1, 3), lambda i: i.isNotNull() & i["more"].isNull())
    parts = F.array_compact(F.transform(shown, render))
    total = _total(items)
    rest = total - F.size(parts)
    tail = F.when(rest > 0, F.concat(F.lit("; +"), rest.cast("string"), F.lit(" more")))
    return (
        F.when(F.size(items) == 0, "None")
        .when(F.size(parts) == 0, F.concat(total.cast("string"), F.lit(" finding(s)")))
        .otherwise(F.concat(F.array_join(parts, "; "), F.coalesce(tail, F.lit(""))))
    )


def summarize_checks(text: Column) -> Column:
    """First three failing checks as ``column: n failed (check)``."""

    def render(item: Column) -> Column:
        count = F.coalesce(F.concat(item["failed"], F.lit(" failed")), F.lit("failed"))
        return F.concat(
            _or(item["column"], "row"), F.lit(": "), count,
            F.lit(" ("), _or(item["check"], "check"), F.lit(")"),
        )

    return _first_three(parse_items(text, CHECKS), render)


def _drift_item(item: Column) -> Column:
    note = F.nullif(item["note"], F.lit(""))
    shown = F.coalesce(F.concat(F.lit(" ("), note, F.lit(")")), F.lit(""))
    return F.concat(_or(item["domain"], "domain"), F.lit(": "), _or(item["metric"], "metric"), shown)


def summarize_drift(text: Column) -> Column:
    """First three drift findings as ``domain: metric (note)``."""
    return _first_three(parse_items(text, DRIFT_ITEMS), _drift_item)


def drift_line(items: Column, total: Column) -> Column:
    """The same line from findings that are rows: the first three, and how many there are."""
    rest = total - F.size(items)
    tail = F.when(rest > 0, F.concat(F.lit("; +"), rest.cast("string"), F.lit(" more")))
    return F.concat(F.array_join(F.transform(items, _drift_item), "; "), F.coalesce(tail, F.lit("")))


def summarize_nulls(text: Column) -> Column:
    """First five columns holding nulls, by name; only numbers count."""
    counts = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    entries = F.map_entries(F.coalesce(counts, F.create_map().cast("map<string,variant>")))
    read = F.transform(
        entries,
        lambda e: F.struct(
            e["key"].alias("key"),
            F.when(
                F.schema_of_variant(e["value"]).rlike("^(BIGINT|DOUBLE|DECIMAL)"),
                F.try_variant_get(e["value"], "$", "string"),
            ).alias("value"),
        ),
    )
    found = F.filter(F.sort_array(read), lambda e: e["value"].try_cast("double") > 0)
    shown = F.transform(
        F.slice(found, 1, 5), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    hidden = F.size(found) - 5
    tail = F.when(hidden > 0, F.concat(F.lit("; +"), hidden.cast("string"), F.lit(" more")))
    return F.when(F.size(found) == 0, "None").otherwise(
        F.concat(F.array_join(shown, "; "), F.coalesce(tail, F.lit("")))
    )


def summarize_duplicates(text: Column) -> Column:
    """Cluster count, largest size and highest similarity."""
    items = parse_items(text, CLUSTERS)
    size = F.coalesce(
        F.array_max(F.transform(items, lambda i: F.coalesce(i["size"], i["max_size"]))), F.lit(0)
    )
    similarity = F.coalesce(
        F.array_max(F.transform(items, lambda i: i["max_similarity"])), F.lit(0.0)
    )
    return F.when(F.size(items) == 0, "None").otherwise(
        F.format_string("%d cluster(s); max size %d; max similarity %.3f", _total(items), size, similarity)
    )
