"""Merging a staged day into a table that has no MERGE: the merged state as a new frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions.values import distinct_from

KEEP, UPDATE, INSERT = "keep", "update", "insert"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    compare: Sequence[str] | None = None,
    update: Sequence[str] | None = None,
    when_changed: bool = True,
    guard: Column | None = None,
    action: str | None = None,
) -> DataFrame:
    """State of `target` after merging `source`, both unique on `keys`.

    A matched row takes the source's `update` columns when any `compare` column differs, NULL
    being a value of its own; with `when_changed=False` it always does. Rows only the source
    has are inserted, rows only the target has stay. `guard` is a further condition for an
    update, written on the columns `t.<name>` and `s.<name>`. `action` names a column that
    tells what happened to each row.
    """
    keys = list(keys)
    names = target.columns
    values = [c for c in names if c not in keys]
    update = values if update is None else list(update)
    compare = update if compare is None else list(compare)

    t = target.withColumn("_there", F.lit(True)).alias("t")
    s = source.select(*names).withColumn("_there", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, on, "full_outer")

    is_new = F.col("t._there").isNull()
    take = F.col("t._there").isNotNull() & F.col("s._there").isNotNull()
    if when_changed:
        take = take & distinct_from(
            [F.col(f"t.{c}") for c in compare], [F.col(f"s.{c}") for c in compare]
        )
    if guard is not None:
        take = take & F.coalesce(guard, F.lit(False))

    picked = {k: F.coalesce(f"t.{k}", f"s.{k}") for k in keys}
    for c in values:
        from_source = (take | is_new) if c in update else is_new
        picked[c] = F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
    out = [picked[c].alias(c) for c in names]
    if action:
        out.append(
            F.when(is_new, INSERT).when(take, UPDATE).otherwise(KEEP).alias(action)
        )
    return both.select(*out)
