"""Conditional merge of a change batch into a target, as a DataFrame.

Clauses are tried in order and the first that holds decides what happens to a
matched row.  Conditions and assignments are SQL expressions over the aliases
``target`` and ``source``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from smeltery.functions.columns import instant, quoted
from smeltery.operators.dedupe import pick_one_per_key, total_order
from smeltery.operators.sizing import BROADCAST_BYTES, BROADCAST_ROWS, BatchSize, fits_broadcast, measure

ACTION = "_merge_action"
_FOUND = "_source_found"


class AmbiguousMatchError(ValueError):
    """Several source rows carry a key that exists in the target."""


@dataclass(frozen=True)
class Matched:
    """What to do with a matched row when ``condition`` is true."""

    action: str
    condition: str | None = None
    assign: Mapping[str, str | Column] = field(default_factory=dict)
    delete: bool = False


@dataclass(frozen=True)
class Missing:
    """Values of the row to insert when the key is not in the target."""

    values: Mapping[str, str | Column]
    condition: str | None = None
    action: str = "insert"


def _expr(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"target.{quoted(k)}") == F.col(f"source.{quoted(k)}") for k in keys])


def require_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str], size: BatchSize | None = None) -> None:
    """Fail when one target row would match several source rows."""
    size = size or measure(source, keys)
    if size.max_copies <= 1:
        return
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)
    hit = target.select(*keys).join(repeated, list(keys), "left_semi")
    if not hit.isEmpty():
        raise AmbiguousMatchError(
            f"several source rows match one target row on {list(keys)}; reduce the batch with latest_by first"
        )


def latest_by(source: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Newest source row per key; equal sequences resolve by the remaining columns."""
    return pick_one_per_key(source, keys, sequence, latest=True)


def widen(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the columns only the source has, as typed nulls."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in source.schema.fields if f.name not in target.columns}
    return target.withColumns(absent) if absent else target


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], matched: Sequence[Matched],
          missing: Missing | None, *, strategy: str = "auto", with_action: bool = False,
          size: BatchSize | None = None, broadcast_bytes: int = BROADCAST_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Target after the merge.

    A left join decides the fate of the target rows and an anti join finds the
    rows to insert.  Both shapes let adaptive execution split a skewed target
    key, which a full outer join does not.  Batches measured below the limits
    are broadcast, and then the target is not shuffled at all; larger ones go
    through shuffled joins.  ``size`` saves measuring a batch twice.  ``strategy`` may force ``"shuffle"``; a forced
    ``"broadcast"`` still needs a batch within the limits.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    if len({clause.action for clause in matched}) < len(matched):
        raise ValueError("matched clauses need distinct action names")
    keys = list(keys)
    size = size or measure(source, keys)
    require_single_match(target, source, keys, size)
    small = strategy != "shuffle" and fits_broadcast(source, size.rows, broadcast_bytes, broadcast_rows)

    kept = _merge_matched(target, source, keys, matched, small)
    if missing is not None:
        kept = kept.unionByName(_insert_missing(target, source, keys, missing, size, small))
    return kept if with_action else kept.drop(ACTION)


def _merge_matched(target: DataFrame, source: DataFrame, keys: list[str], matched: Sequence[Matched],
                   small: bool) -> DataFrame:
    incoming = source.withColumn(_FOUND, F.lit(True))
    # A null key matches nothing; leaving it out keeps null rows off one reducer.
    incoming = incoming.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    incoming = F.broadcast(incoming) if small else incoming
    joined = target.alias("target").join(incoming.alias("source"), _same_key(keys), "left")

    action = F.lit("keep")
    for clause in reversed(matched):
        holds = F.lit(True) if clause.condition is None else F.expr(clause.condition)
        action = F.when(holds, clause.action).otherwise(action)
    action = F.when(F.col(f"source.{_FOUND}"), action).otherwise("keep")
    joined = joined.withColumn(ACTION, action)

    gone = [c.action for c in matched if c.delete]
    if gone:
        joined = joined.filter(~F.col(ACTION).isin(*gone))
    types = {f.name: f.dataType for f in target.schema.fields}
    out = []
    for name in target.columns:
        value = F.col(f"target.{quoted(name)}")
        for clause in matched:
            if name in clause.assign:
                new = _expr(clause.assign[name]).cast(types[name])
                value = F.when(F.col(ACTION) == clause.action, new).otherwise(value)
        out.append(value.alias(name))
    return joined.select(*out, F.col(ACTION))


def _insert_missing(target: DataFrame, source: DataFrame, keys: list[str], missing: Missing, size: BatchSize,
                    small: bool) -> DataFrame:
    existing = size.within_range(target.select(*keys))
    if small:
        # Keys of the batch that the target has: never more than the batch itself.
        found = existing.join(F.broadcast(source.select(*keys)), keys, "left_semi").distinct()
        new = source.join(F.broadcast(found), keys, "left_anti")
    else:
        new = source.join(existing.distinct(), keys, "left_anti")
    new = new.alias("source")
    if missing.condition is not None:
        new = new.filter(F.expr(missing.condition))
    types = {f.name: f.dataType for f in target.schema.fields}
    values = [
        _expr(missing.values[name]).cast(types[name]).alias(name) if name in missing.values
        else F.lit(None).cast(types[name]).alias(name)
        for name in target.columns
    ]
    return new.select(*values, F.lit(missing.action).alias(ACTION))


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action of a merge that kept its action column."""
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("rows"))


# The customer dimension, what counts as a change and what a merge sets.
CUSTOMER_KEY = "customer_id"
CUSTOMER_COMPARED = ("email", "country", "lifetime_value")
CUSTOMER_UPDATED = ("full_name", "email", "country", "is_active", "lifetime_value", "updated_ts")
CUSTOMER_SOFT_DELETED = ("is_active", "lifetime_value", "updated_ts")
CDC_RECORD_SOURCE = "CRM_CDC"
INITIAL_RECORD_SOURCE = "CRM_INITIAL"


def bootstrap_customers(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    return df.withColumns({"load_ts": instant(as_of), "record_source": F.lit(INITIAL_RECORD_SOURCE)})


def changed(columns: Sequence[str], null_safe: bool) -> str:
    """Any column differs; the strict form is unknown, hence false, when a side is null."""
    test = "NOT (source.{0} <=> target.{0})" if null_safe else "source.{0} != target.{0}"
    return " OR ".join(test.format(quoted(c)) for c in columns)


def merge_scd1(target: DataFrame, source: DataFrame, *, as_of: dt.datetime | None = None,
               null_safe: bool = True, delete_inactive: bool = False, evolve: bool = False,
               strategy: str = "auto", with_action: bool = False) -> DataFrame:
    """Customer dimension merge: soft delete, then update on change, then insert.

    ``null_safe`` also sees a change from or to null; without it comparisons
    follow plain SQL.  ``delete_inactive`` removes matched rows flagged
    inactive instead of marking them.  ``evolve`` carries new source columns
    into the target.
    """
    extra: list[str] = []
    if evolve:
        extra = [c for c in source.columns if c not in target.columns]
        target = widen(target, source)
    loaded = instant(as_of)
    from_source = {c: f"source.{c}" for c in (*CUSTOMER_UPDATED, *extra)}
    inactive = "source.is_active = FALSE"
    if delete_inactive:
        first = Matched("delete", inactive, delete=True)
    else:
        marked = {c: f"source.{c}" for c in CUSTOMER_SOFT_DELETED}
        first = Matched("soft_delete", inactive, marked | {"load_ts": loaded})
    update = Matched("update", changed(CUSTOMER_COMPARED, null_safe), from_source | {"load_ts": loaded})
    insert = Missing(
        {CUSTOMER_KEY: f"source.{CUSTOMER_KEY}"} | from_source
        | {"load_ts": loaded, "record_source": F.lit(CDC_RECORD_SOURCE)}
    )
    return merge(target, source, [CUSTOMER_KEY], [first, update], insert,
                 strategy=strategy, with_action=with_action)


def merge_report(target: DataFrame, new_id_floor: int) -> DataFrame:
    """Total, inactive and newly numbered rows of the dimension in one pass."""
    return target.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("is_active")).alias("inactive_rows"),
        F.count_if(F.col(CUSTOMER_KEY) > new_id_floor).alias("new_rows"),
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, newer_by: str | Sequence[str] | None = None,
           strategy: str = "auto", size: BatchSize | None = None) -> DataFrame:
    """Replace matched rows by the source row and add the others.

    With ``newer_by`` an older source row leaves the target as it is, so
    replays and late batches do no harm. Rows compare in the order of
    :func:`latest_by`, nulls being the oldest, so batches may come in any order.
    """
    values = {c: f"source.{quoted(c)}" for c in target.columns}
    condition = None
    if newer_by:
        order = total_order(target, keys, [newer_by] if isinstance(newer_by, str) else newer_by)
        side = "struct({})".format
        condition = " >= ".join(side(", ".join(f"{s}.{quoted(c)} AS c{i}" for i, c in enumerate(order)))
                                for s in ("source", "target"))
    return merge(target, source, keys, [Matched("update", condition, values)], Missing(values), strategy=strategy,
                 size=size)
