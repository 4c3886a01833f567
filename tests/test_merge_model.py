"""The merge against a row-by-row model on random batches."""

import datetime as dt
import random

import pytest
from conftest import rows

from smeltery.operators import merge as G

OLD, NEW, AT = (dt.datetime(2024, 1, day) for day in (1, 2, 3))
FIELDS = ("customer_id", "full_name", "email", "country", "is_active", "lifetime_value", "updated_ts")
SHAPE = "customer_id bigint, full_name string, email string, country string, is_active boolean, " \
        "lifetime_value double, updated_ts timestamp"


def random_rows(rng, keys, when):
    return {
        k: dict(zip(FIELDS, (
            k, rng.choice("abc"), rng.choice([None, "x", "y"]), rng.choice([None, "DE", "US"]),
            rng.choice([None, True, False]), rng.choice([None, 0.0, 1.0]), when)))
        for k in keys
    }


def differs(new, old, null_safe):
    pairs = [(new[c], old[c]) for c in ("email", "country", "lifetime_value")]
    return any(a != b if null_safe else None not in (a, b) and a != b for a, b in pairs)


def model(target, source, null_safe, delete):
    out = {k: dict(row) for k, row in target.items()}
    for k, new in source.items():
        if k not in target:
            out[k] = new | {"load_ts": AT, "record_source": "CRM_CDC"}
        elif new["is_active"] is False:
            if delete:
                del out[k]
            else:
                out[k] |= {c: new[c] for c in ("is_active", "lifetime_value", "updated_ts")} | {"load_ts": AT}
        elif differs(new, target[k], null_safe):
            out[k] |= new | {"load_ts": AT}
    return sorted(tuple(str(v) for v in row.values()) for row in out.values())


@pytest.mark.parametrize("seed", range(4))
def test_merge_follows_the_model(spark, seed):
    rng = random.Random(seed)
    target = random_rows(rng, rng.sample(range(60), 40), OLD)
    target = {k: row | {"load_ts": OLD, "record_source": "CRM_INITIAL"} for k, row in target.items()}
    source = random_rows(rng, rng.sample(range(80), 30), NEW)
    left = spark.createDataFrame([tuple(r.values()) for r in target.values()],
                                 SHAPE + ", load_ts timestamp, record_source string")
    right = spark.createDataFrame([tuple(r.values()) for r in source.values()], SHAPE)
    null_safe, delete = bool(seed % 2), seed >= 2
    for strategy in ("broadcast", "shuffle"):
        out = G.merge_scd1(left, right, as_of=AT, null_safe=null_safe, delete_inactive=delete, strategy=strategy)
        got = sorted(tuple(str(v) for v in row) for row in rows(out))
        assert got == model(target, source, null_safe, delete)
