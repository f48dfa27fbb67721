"""Distinct party rows by sale and profile: the same rows as a whole-row distinct."""

from __future__ import annotations

import re

import pytest

from estrella.plans import QUERIES
from estrella.plans import audits as A
from estrella.plans import warehouse as W
from estrella.sources.ordered import RANGE_BYTES
from estrella.sources.tables import SCHEMAS, Tables


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Sales, customers and suppliers that come twice, are unknown or have no key."""
    folder = tmp_path_factory.mktemp("parties")
    rows = {
        "customer": [(k, f"c{k}", k % 3 if k else None, 1.0, "m") for k in [*range(1, 200), 3, 5, None, 150, 153]]
        + [(3, "other", 1, 1.0, "m")],
        "supplier": [(k, f"s{k}", 1, -1.0) for k in [*range(1, 70), 2, None]],
        "orders": [(k, c, "P", 10.0, None, "1") for k, c in [*((i, i % 210) for i in range(1, 400)), (7, 7), (None, 3), (9, None)]],
        "lineitem": [
            (o, 1, s, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", None)
            for o, s in [*((i % 90, i % 80) for i in range(600)), (5, None), (5, 900), (5, 901), (None, 2)]
        ],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, SCHEMAS[name]).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


def _sorted(df):
    return sorted(map(repr, df.collect()))


def test_profiles_give_the_rows_of_a_whole_row_distinct(spark, odd):
    t = Tables(spark, odd)
    whole = W.sale_parties(*W.party_reports_by_sale(t))
    mine = W.sale_parties_of(t)
    assert mine.columns == whole.columns
    assert _sorted(mine) == _sorted(whole)
    conflicts = A.party_key_conflicts_of(W.party_profiles(t))
    expected = _sorted(A.conflict_rows_of(whole, conflicts))
    assert expected and _sorted(A.conflict_rows(t)) == expected


@pytest.mark.parametrize("name", ["party_union", "conflict_detail"])
def test_whole_rows_are_not_shuffled_by_all_their_columns(spark, odd, name):
    plan = QUERIES[name](spark, odd)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert keys and not any("estado_civil" in k for k in keys)


def test_a_range_of_the_review_list_fits_a_task():
    # the review list takes about 35 times a range's written bytes where a task sorts it
    assert RANGE_BYTES * 35 < 1 << 30
