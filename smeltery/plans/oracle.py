"""Building blocks of the oracle SQL: inputs as CTEs and exact rounding."""

from __future__ import annotations

from smeltery.plans import fixtures as X

BASE = {name: name for name in X.TABLES}


def day(column: str) -> str:
    return f"CAST(try_strptime({column}, '%Y-%m-%d') AS DATE)"


def total(column: str) -> str:
    return f"CAST(round(sum(CAST({column} AS DECIMAL(24,6))), 2) AS DOUBLE)"


def mean(column: str) -> str:
    """Average of non-negative amounts in whole cents, rounded half up in integers."""
    cents = f"CAST(round({column} * 100) AS HUGEINT)"
    return f"CAST((2 * sum({cents}) + count({column})) // (2 * count({column})) AS DOUBLE) / 100.0"


CONFORMED = f"""
SELECT claim_id, member_id, npi, date_of_service, {day('claim_date')} AS claim_date,
       TRY_CAST(paid_amount AS DOUBLE) AS paid_amount, TRY_CAST(allowed_amount AS DOUBLE) AS allowed_amount,
       TRY_CAST(quantity AS INTEGER) AS quantity, upper(trim(claim_type)) AS claim_type, cpt_code, icd_code,
       tie_part, tie_supp, {day('date_of_service')} AS service_date, trim(icd_code) AS diagnosis_code,
       trim(cpt_code) AS procedure_code, trim(member_id) AS patient_id, trim(npi) AS provider_id
FROM claims_raw"""

_ORDER = ", ".join(f"{c} NULLS FIRST" for c in (
    "tie_part", "tie_supp", "quantity", "member_id", "npi", "date_of_service", "claim_date", "paid_amount",
    "allowed_amount", "claim_type", "cpt_code", "icd_code", "diagnosis_code", "provider_id",
))

SILVER = f"""
SELECT * EXCLUDE (pick) FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_id, patient_id, service_date, procedure_code ORDER BY {_ORDER}) AS pick
  FROM conformed) WHERE pick = 1"""

# Name -> (inputs it reads, SQL); inputs come first in the dict.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "claims_raw": ((), X.CLAIMS_RAW.format(**BASE)),
    "conformed": (("claims_raw",), CONFORMED),
    "silver": (("conformed",), SILVER),
    "events_feed": ((), X.EVENTS_FEED.format(**BASE)),
    "orders_feed": ((), X.ORDERS_FEED.format(**BASE)),
    "orders_v2": ((), X.ORDERS_V2.format(**BASE)),
    "target": ((), X.CUSTOMER_TARGET.format(**BASE)),
    "source": (("target",), X.branches_sql("target", X.CHANGES)),
    "change_log": (("target",), X.branches_sql("target", X.LOGGED)),
    "orders_as_source": ((), X.ORDERS_AS_SOURCE.format(**BASE)),
    "order_lines": ((), (X.orders_flat_sql() + X.ITEM_LEFT_JOIN).format(**BASE)),
    "lines_valued": (("order_lines",), """
SELECT *, round(item__quantity * item__price, 2) AS item__total,
       CASE WHEN item__price < 50 THEN 'Y' ELSE 'N' END AS item__discount_applied,
       CASE WHEN payment__amount_cents >= 500 THEN 'high' WHEN payment__amount_cents >= 100 THEN 'medium' ELSE 'low' END
         AS order__value_tier,
       CAST(coalesce(payment__amount_cents, 0) AS DOUBLE) AS payment__amount
FROM order_lines"""),
}


def _needed(name: str, seen: list[str]) -> None:
    for parent in CTES[name][0]:
        _needed(parent, seen)
    if name not in seen:
        seen.append(name)


def over(names: str, body: str) -> str:
    """``body`` with the named inputs, and what they read, in front."""
    order: list[str] = []
    for name in names.split():
        _needed(name, order)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in order) + f"\n{body}"


def merged(null_safe: bool = True, source: str = "source", delete: bool = False, extra: str = "",
           columns: str = "*") -> str:
    """Dimension after the merge, written as one full outer join."""
    differs = "s.{0} IS DISTINCT FROM t.{0}" if null_safe else "s.{0} <> t.{0}"
    change = " OR ".join(differs.format(c) for c in ("email", "country", "lifetime_value"))
    loaded = "TIMESTAMP '2024-01-03 00:00:00'"

    def pick(name: str, on_delete: bool) -> str:
        gone = f"WHEN action = 'soft_delete' THEN s_{name} " if on_delete else ""
        return (f"CASE WHEN action IN ('insert', 'update') THEN s_{name} {gone}ELSE t_{name} END AS {name}")

    updated = [
        pick("full_name", False), pick("email", False), pick("country", False), pick("is_active", True),
        pick("lifetime_value", True), pick("updated_ts", True),
    ]
    if extra:
        updated.append(f"CASE WHEN action IN ('insert', 'update') THEN s_{extra} END AS {extra}")
    aliased = ", ".join(
        f"{side}.{c} AS {side}_{c}" for side in "ts"
        for c in ("full_name", "email", "country", "is_active", "lifetime_value", "updated_ts")
    )
    more = f", s.{extra} AS s_{extra}" if extra else ""
    inactive = "'delete'" if delete else "'soft_delete'"
    return f"""
SELECT {columns} FROM (
SELECT customer_id, {', '.join(updated)},
       CASE WHEN action = 'keep' THEN t_load_ts ELSE {loaded} END AS load_ts,
       CASE WHEN action = 'insert' THEN 'CRM_CDC' ELSE t_record_source END AS record_source, action
FROM (
  SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, {aliased}{more},
         t.load_ts AS t_load_ts, t.record_source AS t_record_source,
         CASE WHEN t.customer_id IS NULL THEN 'insert' WHEN s.customer_id IS NULL THEN 'keep'
              WHEN s.is_active = FALSE THEN {inactive} WHEN {change} THEN 'update' ELSE 'keep' END AS action
  FROM target t FULL OUTER JOIN {source} s ON t.customer_id = s.customer_id)
WHERE action <> 'delete')"""
