"""Declarative row rules, and counts over their outcome."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import (
    JUNK_RATIO_CAP,
    RELEVANCE_FLOOR,
    TEXT_CHAR_CAP,
    TEXT_CHAR_FLOOR,
    TITLE_CHAR_CAP,
)
from tidemark.functions.text import is_error_page, passes_junk

REASONS = "_failure_reasons"
_DUPLICATED = "_id_duplicated"
_LOWERED = "_text_lowered"


@dataclass(frozen=True)
class Rule:
    """One named check on one column; ``failed`` is true on the rows that break it."""

    column: str
    check: str
    failed: Column

    @property
    def reason(self) -> str:
        return f"{self.column}: {self.check}"


def _required(column: str) -> Rule:
    return Rule(column, "not_null", F.col(column).isNull())


def _when_present(column: str, check: str, ok: Column) -> Rule:
    """A check that a null value does not break."""
    return Rule(column, check, F.col(column).isNotNull() & ~F.coalesce(ok, F.lit(True)))


def bronze_rules(*, unique_id: bool = True) -> list[Rule]:
    """The rules of the bronze table.

    ``unique_id`` needs :func:`with_duplicate_flag`; leave it out for rows that went through
    ``keep_first`` on the id, which makes it true by construction.
    """
    text = F.col("text")
    rules = [
        _required("bronze_id"),
        _when_present(
            "bronze_id", "matches_id_format", F.col("bronze_id").rlike("^bronze_[0-9a-f]{64}$")
        ),
    ]
    if unique_id:
        rules.append(Rule("bronze_id", "unique", F.col(_DUPLICATED)))
    return rules + [
        _required("source_url"),
        _when_present("source_url", "matches_http_scheme", F.col("source_url").rlike("^https?://")),
        _required("source_domain"),
        _when_present(
            "title", f"length_le_{TITLE_CHAR_CAP}", F.length("title") <= TITLE_CHAR_CAP
        ),
        _required("text"),
        _when_present(
            "text",
            f"length_{TEXT_CHAR_FLOOR}_to_{TEXT_CHAR_CAP}",
            F.length(text).between(TEXT_CHAR_FLOOR, TEXT_CHAR_CAP),
        ),
        _when_present("text", f"junk_ratio_le_{JUNK_RATIO_CAP}", passes_junk(text)),
        _when_present(
            "text", "no_error_page_sentinel", ~is_error_page(text, F.col(_LOWERED))
        ),
        _when_present(
            "relevance_score", f"ge_{RELEVANCE_FLOOR}", F.col("relevance_score") >= RELEVANCE_FLOOR
        ),
        _required("query"),
        _when_present("query", "length_ge_1", F.length("query") >= 1),
        _required("crawled_at"),
        _required("ingested_at"),
        _required("source_file"),
    ]


def with_duplicate_flag(df: DataFrame, key: str = "bronze_id") -> DataFrame:
    """Flag rows whose key occurs more than once.

    Counting combines before the shuffle and only repeated keys are joined back, usually few
    enough to broadcast; a hot key never gathers its rows in one window.
    """
    repeated = (
        df.groupBy(key).count().where(F.col("count") > 1).select(key, F.lit(True).alias(_DUPLICATED))
    )
    return df.join(repeated, key, "left").withColumn(
        _DUPLICATED, F.coalesce(_DUPLICATED, F.lit(False))
    )


def failure_reasons(rules: Sequence[Rule]) -> Column:
    """The reasons a row fails, in rule order; empty when it passes."""
    none = F.array().cast("array<string>")
    # Plain arrays rather than a lambda over them: this compiles, a lambda would be interpreted.
    return F.concat(*[F.when(r.failed, F.array(F.lit(r.reason))).otherwise(none) for r in rules])


def apply_rules(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Evaluate every rule on every row, in one pass, into ``_failure_reasons``."""
    if rules is None:
        df, rules = with_duplicate_flag(df), bronze_rules()
    prepared = df.withColumn(_LOWERED, F.lower("text"))
    return prepared.withColumn(REASONS, failure_reasons(rules)).drop(_DUPLICATED, _LOWERED)


def failed_rows(checked: DataFrame, run_id: str) -> DataFrame:
    """The rows with at least one reason, stamped with the run."""
    return checked.where(F.size(REASONS) > 0).withColumn("_quality_run_id", F.lit(run_id))


def check_summary(checked: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Failed rows per (column, check), most first.

    One count per rule in a single aggregate: reasons are never exploded into rows.
    """
    named = list(rules or bronze_rules())
    counts = checked.agg(
        *[
            F.count_if(F.array_contains(REASONS, r.reason)).alias(f"_{i}")
            for i, r in enumerate(named)
        ]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(r.column).alias("column"),
                F.lit(r.check).alias("check"),
                F.col(f"_{i}").alias("failed"),
            )
            for i, r in enumerate(named)
        ]
    )
    summary = counts.select(F.inline(entries)).where(F.col("failed") > 0)
    return summary.orderBy(F.desc("failed"), "column", "check")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, as (column, nulls) rows; zeros for an empty frame."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in names]
    )
    return counts.select(F.inline(pairs))


def quality_counts(checked: DataFrame) -> DataFrame:
    """Rows in, passed and failed, one row."""
    failed = F.size(REASONS) > 0
    return checked.agg(
        F.count("*").alias("rows_in"),
        F.count_if(~failed).alias("rows_passed"),
        F.count_if(failed).alias("rows_failed"),
    )


def quality_profile(
    checked: DataFrame, rules: Sequence[Rule], columns: Sequence[str]
) -> tuple[dict[str, int], list[dict], dict[str, int]]:
    """Row counts, failing checks (most first) and null counts, all from one pass."""
    reasons = [r.reason for r in rules]
    row = checked.agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.size(REASONS) > 0).alias("rows_failed"),
        *[F.count_if(F.array_contains(REASONS, r)).alias(f"_r{i}") for i, r in enumerate(reasons)],
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)],
    ).first()
    summary = [
        {"column": r.column, "check": r.check, "failed": row[f"_r{i}"]}
        for i, r in enumerate(rules)
        if row[f"_r{i}"]
    ]
    summary.sort(key=lambda entry: (-entry["failed"], entry["column"], entry["check"]))
    counts = {
        "rows_in": row["rows_in"],
        "rows_passed": row["rows_in"] - row["rows_failed"],
        "rows_failed": row["rows_failed"],
    }
    return counts, summary, {c: row[f"_n{i}"] for i, c in enumerate(columns)}


def status_of(rows_failed: Column, findings: Column) -> Column:
    """fail on failed rows, warn on drift or duplicate findings, else pass."""
    return F.when(rows_failed > 0, "fail").when(findings > 0, "warn").otherwise("pass")


def schema_findings(df: DataFrame, schema: T.StructType) -> list[dict]:
    """Table-level rules: declared columns must exist with their type; more columns are fine.

    They appear in the summary and fail no row. Only the plan's schema is looked at.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    findings = []
    for field in schema.fields:
        if field.name not in have:
            findings.append({"column": field.name, "check": "column_in_dataframe", "failed": 1})
        elif have[field.name] != field.dataType:
            check = f"dtype_{field.dataType.simpleString()}"
            findings.append({"column": field.name, "check": check, "failed": 1})
    return findings
