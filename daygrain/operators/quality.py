"""Declarative row rules: every violated rule adds its reason, rejects go to quarantine.

A rule block is a dict, as in `rules.yaml`::

    reject: {corrupt_record: true, not_null: [c], positive: [c], allowed_values: {c: [..]},
             valid_timestamp: [c], ts_range: {column, min, max},
             required_when: [{column, when_column, equals}],
             date_order: [{earlier, later}], unique: [c or [c, d]]}
    warn:   (the same kinds)
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daygrain.operators.copies import mark_copies
from daygrain.sinks import files
from daygrain.sources.schemas import CORRUPT

DEFAULT_RULES = Path(__file__).resolve().parents[1] / "rules.yaml"

Violation = tuple[Column, str]


def load_rules(path: str | Path = DEFAULT_RULES, spark: SparkSession | None = None) -> dict:
    """Table name to rule blocks. With a session the file may be on any Hadoop file system."""
    text = files.read_text(spark, str(path)) if spark else Path(path).read_text()
    if text is None:
        raise FileNotFoundError(str(path))
    return yaml.safe_load(text)


def corrupt_record(wanted: bool) -> Iterator[Violation]:
    if wanted:
        yield F.col(CORRUPT).isNotNull(), "corrupt_record"


def not_null(columns: Sequence[str]) -> Iterator[Violation]:
    for c in columns:
        yield F.col(c).isNull(), f"null:{c}"


def positive(columns: Sequence[str]) -> Iterator[Violation]:
    for c in columns:
        yield F.col(c) <= 0, f"non_positive:{c}"


def allowed_values(allowed: dict[str, list]) -> Iterator[Violation]:
    for c, values in allowed.items():
        yield ~F.col(c).isin(*values), f"bad_value:{c}"


def valid_timestamp(columns: Sequence[str]) -> Iterator[Violation]:
    """Text was there but did not parse; `parse_ts` keeps it in `<c>_raw`."""
    for c in columns:
        yield F.col(f"{c}_raw").isNotNull() & F.col(c).isNull(), f"bad_timestamp:{c}"


def ts_range(spec: dict[str, str]) -> Iterator[Violation]:
    """Both ends belong to the range; the bounds are UTC, like the converted column."""
    low, high = (F.lit(str(spec[end])).cast("timestamp") for end in ("min", "max"))
    yield ~F.col(spec["column"]).between(low, high), f"out_of_range:{spec['column']}"


def required_when(specs: Sequence[dict[str, str]]) -> Iterator[Violation]:
    for s in specs:
        applies = F.col(s["when_column"]) == s["equals"]
        reason = f"missing_when:{s['column']}:{s['when_column']}={s['equals']}"
        yield applies & F.col(s["column"]).isNull(), reason


def date_order(specs: Sequence[dict[str, str]]) -> Iterator[Violation]:
    for s in specs:
        reason = f"date_order:{s['later']}<{s['earlier']}"
        yield F.col(s["later"]) < F.col(s["earlier"]), reason


# Reasons are listed in this order. `unique` comes last; it is the one that needs a shuffle.
ROW_RULES: dict[str, Callable[..., Iterator[Violation]]] = {
    "corrupt_record": corrupt_record,
    "not_null": not_null,
    "positive": positive,
    "allowed_values": allowed_values,
    "valid_timestamp": valid_timestamp,
    "ts_range": ts_range,
    "required_when": required_when,
    "date_order": date_order,
}


def _violations(block: dict) -> list[Violation]:
    unknown = set(block) - set(ROW_RULES) - {"unique"}
    if unknown:
        raise ValueError(f"unknown rule kinds: {sorted(unknown)}")
    return [v for kind, rule in ROW_RULES.items() if kind in block for v in rule(block[kind])]


def with_reasons(
    df: DataFrame,
    block: dict | None,
    out: str,
    order_by: Sequence[Column | str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """Add `out`: comma-separated reasons of the violated rules, '' for none.

    A rule whose condition is NULL is not violated: missing values are for `not_null` alone.
    Copies under `unique` are counted among the rows that share the `within` columns, whatever
    else is wrong with them.
    """
    block = block or {}
    violations = _violations(block)
    marks = []
    for key in block.get("unique", []):
        columns = [key] if isinstance(key, str) else list(key)
        mark = f"_copy_{'_'.join(columns)}"
        df = mark_copies(df, [*within, *columns], mark, order_by)
        violations.append((F.col(mark), f"duplicate:{'+'.join(columns)}"))
        marks.append(mark)
    # concat_ws skips the NULL a rule that holds leaves behind.
    reasons = [F.when(violated, F.lit(reason)) for violated, reason in violations]
    return df.withColumn(out, F.concat_ws(",", *reasons) if reasons else F.lit("")).drop(*marks)


def tag_rows(
    df: DataFrame,
    rules: dict,
    order_by: Sequence[Column | str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """All rows with `dq_reason` (reject rules) and `dq_warn` (warn rules)."""
    tagged = with_reasons(df, rules.get("reject"), "dq_reason", order_by, within)
    return with_reasons(tagged, rules.get("warn"), "dq_warn", order_by, within)


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = tagged.where(F.col("dq_reason") == "").drop("dq_reason")
    return valid, tagged.where(F.col("dq_reason") != "")


def apply_rules(
    df: DataFrame, rules: dict, order_by: Sequence[Column | str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid with dq_warn, bad with dq_reason and dq_warn); together they are the input.

    Both are lazy. A caller that needs both should write `tag_rows` and split what was written.
    """
    return split_tagged(tag_rows(df, rules, order_by))


def reason_counts(bad: DataFrame) -> DataFrame:
    """Rejected rows per single reason; a row with two reasons counts under both."""
    return (
        bad.groupBy("dq_reason")
        .agg(F.count("*").alias("rows"))
        .select(F.explode(F.split("dq_reason", ",")).alias("reason"), "rows")
        .groupBy("reason")
        .agg(F.sum("rows").alias("rows"))
    )


def reason_report(tagged: DataFrame) -> DataFrame:
    """Per reason: rows, and their share of all rows of the table in percent (3 decimals)."""
    total = tagged.agg(F.count("*").alias("total"))
    bad = tagged.where(F.col("dq_reason") != "")
    return reason_counts(bad).select("reason", "rows", total.scalar().alias("total"))


def known_reasons(rules: dict | None) -> list[str]:
    """Every reason the reject rules of a table can give."""
    block = (rules or {}).get("reject") or {}
    keys = [[k] if isinstance(k, str) else list(k) for k in block.get("unique", [])]
    return [reason for _, reason in _violations(block)] + [f"duplicate:{'+'.join(k)}" for k in keys]


class Tally:
    """Counts of a tagged table that are taken while it is written, without a job of their own.

    One number per reason the rules know. Attach it last before the write: tasks of a write are
    counted once, however often an earlier stage is repeated.
    """

    def __init__(self, table: str, rules: dict | None):
        self.table, self.reasons, self.seen = table, known_reasons(rules), Observation()

    def attach(self, tagged: DataFrame) -> DataFrame:
        bad = F.col("dq_reason") != ""
        warned = F.col("dq_warn") != "" if "dq_warn" in tagged.columns else F.lit(False)
        given = F.split("dq_reason", ",")
        return tagged.observe(
            self.seen,
            F.count(F.lit(1)).alias("total"),
            F.count_if(bad).alias("quarantined"),
            F.count_if(warned & ~bad).alias("warned"),
            *[
                F.count_if(bad & F.array_contains(given, reason)).alias(f"reason_{k}")
                for k, reason in enumerate(self.reasons)
            ],
        )

    def summary(self) -> dict:
        """Numbers of the table's run; waits for the write."""
        found = self.seen.get
        counts = {r: found[f"reason_{k}"] for k, r in enumerate(self.reasons)}
        return {
            **summary_of(self.table, found["total"], found["quarantined"], counts),
            "warned": found["warned"],
        }


def summary_of(table: str, total: int, quarantined: int, by_reason: Mapping[str, int]) -> dict:
    """Rows, quarantined, their share, and rows per reason, the most frequent first."""
    given = [(reason, n) for reason, n in by_reason.items() if n]
    return {
        "table": table,
        "total": total,
        "quarantined": quarantined,
        "pct": round(100.0 * quarantined / total, 3) if total else 0.0,
        "by_reason": dict(sorted(given, key=lambda kv: (-kv[1], kv[0]))),
    }


def summarize(table: str, total: int, bad: DataFrame) -> dict:
    """The same numbers of rows that were rejected before, in one job.

    The driver gets one entry per combination of reasons, whose number the rules bound.
    """
    combos = bad.groupBy("dq_reason").agg(F.count("*").alias("rows")).collect()
    by_reason: Counter = Counter()
    for r in combos:
        for reason in r["dq_reason"].split(","):
            by_reason[reason] += r["rows"]
    return summary_of(table, total, sum(r["rows"] for r in combos), by_reason)
