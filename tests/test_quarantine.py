"""Rejected values, the seed's contract, and bucketed facts."""

import collections
import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from estrella.functions import safe_date, safe_int_with_words
from estrella.operators.quarantine import CastRule, rejects, split_rejects
from estrella.plans import marts as M
from estrella.sources import versions as V
from estrella.sources.lookup import accepted_seed, read_seed_csv, seed_findings


def test_rejects_against_brute_force(spark, tmp_path):
    texts = [None, "", "  ", "NULL", " null ", "2024-02-30", "2024-02-29", "yesterday", "41", " 42 ", "CUARENTA Y DOS", "4x", "99999999999"]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate((x, y) for x in texts for y in texts)], "id long, d string, n string")
    rules = [CastRule("day", "d", safe_date("d"), "date"), CastRule("age", "n", safe_int_with_words("n"), "integer")]
    staged = df.select("id", safe_date("d").alias("day"), safe_int_with_words("n").alias("age"), rejects(rules))
    clean, found = split_rejects(staged, ["id"], str(tmp_path / "t"))
    assert clean.count() == df.count() and clean.columns == ["id", "day", "age"]

    def given(x):
        return x is not None and x.strip() != "" and x.strip().upper() != "NULL"

    def day(x):
        try:
            return dt.date.fromisoformat(x.strip())
        except ValueError:
            return None

    def age(x):
        x = x.strip()
        return 42 if x == "CUARENTA Y DOS" else int(x) if re.fullmatch(r"\d+", x) and int(x) < 2**31 else None

    want = collections.Counter()
    for r in df.collect():
        if given(r["d"]) and day(r["d"]) is None and not re.fullmatch(r" *(41|42) *", r["d"]):
            want[(r["id"], "day", r["d"], "date")] += 1
        if given(r["n"]) and age(r["n"]) is None:
            want[(r["id"], "age", r["n"], "integer")] += 1
    got = collections.Counter(map(tuple, found.collect()))
    # a bare number is a year to the date cast: both sides leave it out
    got = collections.Counter({k: n for k, n in got.items() if not (k[1] == "day" and re.fullmatch(r" *(41|42) *", k[2]))})
    assert got == want and want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "age:int" not in plan.split("ReadSchema")[1]  # the cleaned columns are not read


def test_seed_with_faults(spark, tmp_path):
    text = """GRUPO,DESARROLLO_CORTO,DESARROLLO_LARGO,GRUPO_2
g,N1,NORTE UNO,Peninsula
g, n1 ,Norte  Uno,PENÍNSULA
g,N2,SUR,Centro
g,,OESTE,Centro
g,N4,ESTE,
"""
    (tmp_path / "seed.csv").write_text(text, encoding="utf-8")
    seed = read_seed_csv(spark, str(tmp_path / "seed.csv"))
    found = seed_findings(seed, ("desarrollo_largo", "desarrollo_corto"), "grupo_2").collect()
    got = collections.Counter((r["problem"], r["desarrollo_largo"], r["n"]) for r in found)
    assert got == {
        ("blank", "OESTE", 1): 1, ("blank", "ESTE", 1): 1,
        ("repeated_pair", "NORTE UNO", 2): 1, ("repeated_pair", "Norte  Uno", 2): 1,
        ("group_spelling", "NORTE UNO", 2): 1, ("group_spelling", "Norte  Uno", 2): 1,
    }
    kept = accepted_seed(seed, ("desarrollo_largo", "desarrollo_corto"), "grupo_2").collect()
    assert sorted(map(tuple, kept)) == [("NORTE UNO", "N1", "PENINSULA"), ("SUR", "N2", "CENTRO")]
    assert seed_findings(seed.limit(0), ("desarrollo_largo", "desarrollo_corto"), "grupo_2").collect() == []


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_marts_join_bucketed_facts_without_a_shuffle(spark, sf_small, tmp_path, no_broadcast):
    from estrella.plans.build import build_all

    out = build_all(spark, sf_small, str(tmp_path), audits=False)
    per_sale = M.payments_per_sale(out["fct_payments"], "venta_key")
    joined = M._by_sale(out["fct_sales"], per_sale, "venta_key")
    joined = joined.join(M._overdue_per_sale(out["fct_overdue"], "venta_key"), "venta_key", "left")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    mart = M.collections_by_sale(out["fct_sales"], out["dim_units"], out["fct_payments"], key="venta_key")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(venta_key", plan)
    before = sorted(map(tuple, out["fct_sales"].collect()))
    at = V.describe(spark, f"{tmp_path}/warehouse/fct_sales")
    spark.sql(f"DROP TABLE {json.loads(at.notes[V.BUCKETED])[2]}")  # as in another session
    again = V.read_version(spark, f"{tmp_path}/warehouse/fct_sales")
    assert sorted(map(tuple, again.collect())) == before
    agg = again.groupBy("venta_key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in agg
