"""The sales of a mart are moved once for all that is joined to them by the sale."""

import re

import pytest
from pyspark.sql import functions as F

from estrella.plans import QUERIES
from estrella.plans import marts as M
from estrella.plans import staging as S
from estrella.plans import warehouse as W
from estrella.sources.tables import Tables


def _moves(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning[^\n]*", df._jdf.queryExecution().toString())


@pytest.mark.parametrize("key", ["dash_rebuilt", "collections_mart", "commercial_mart"])
def test_joins_by_sale_do_not_move_the_sales_again(spark, sf_small, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moves = _moves(QUERIES[key](spark, sf_small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moves
    assert not [m for m in moves if "coalesce(id_venta" in m]  # a second dealing of the sales
    assert not [m for m in moves if "comision_empresa" in m]  # the dashboard's 33 columns


def test_dashboard_columns_are_those_of_the_distinct_rows(spark, sf_small):
    t = Tables(spark, sf_small)
    names = ["id_venta", "precio_m2_venta", "requiere_factura"]
    whole, some = S.staged_dashboard(t).select(*names), S.dashboard_columns(t, *names)
    assert some.columns == names and whole.count() == some.count()
    assert whole.exceptAll(some).count() == 0 == some.exceptAll(whole).count()


def test_a_missing_sale_matches_a_missing_sale(spark):
    sales = W.with_match(spark.createDataFrame([(0,), (1,), (None,)], "id_venta long"))
    paid = W.with_match(spark.createDataFrame([(0, 5), (None, 7), (None, 1)], "id_venta long, n long"))
    per_sale = paid.groupBy(*W.MATCH).agg(F.sum("n").alias("n"))
    got = M._by_sale(sales, per_sale, W.MATCH).select("id_venta", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(0, 5), (1, None), (None, 8)], key=str)
