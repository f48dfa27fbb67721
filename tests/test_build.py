"""The materialised full build yields the same marts as the standalone queries."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import norm

MARTS = ["collections_mart", "commercial_mart", "overdue_mart", "period_mart", "invoice_mart",
         "dash_legacy", "dash_rebuilt"]


@pytest.fixture(scope="module")
def built(spark, sf_small, tmp_path_factory):
    from estrella.plans.build import build_all

    return build_all(spark, sf_small, str(tmp_path_factory.mktemp("build")))


@pytest.mark.parametrize("mart", MARTS)
def test_built_mart_equals_standalone_query(spark, sf_small, built, mart):
    standalone = entry.queries()[mart](spark, sf_small)
    got = built[mart]
    assert sorted(got.columns) == sorted(standalone.columns)
    cols = sorted(got.columns)
    a = sorted(tuple(norm(r[c]) for c in cols) for r in got.collect())
    b = sorted(tuple(norm(r[c]) for c in cols) for r in standalone.collect())
    assert a == b


def test_built_review_list_equals_the_standalone_one(spark, sf_small, built):
    """No key conflicts at this scale: the table is there, with its columns, and empty."""
    standalone = entry.queries()["conflict_report"](spark, sf_small)
    assert built["conflict_report"].columns == standalone.columns
    assert built["conflict_report"].collect() == standalone.collect()


def test_review_list_of_conflicting_parties(spark, tmp_path):
    from estrella.plans.audits import REVIEW_ORDER, conflict_rows_of, party_key_conflicts_of
    from estrella.sources import read_ordered, write_ordered

    cols = ["persona_natural_key", "id_venta", "rol_persona_en_venta", "nombre_completo", "rfc", "curp", "email",
            "telefono_celular", "edad"]
    rows = [
        ("k2", 5, "main", "Z", "r1", "c", " A@X ", "1", 30),
        ("k2", 4, "main", "A", "r2", "c", "a@x", "1", 30),
        ("k2", 9, "co", None, "r1", "c", "a@x", None, 30),
        ("k1", 7, "main", "Q", "r", "c1", "q", "2", 30),
        ("k1", 6, "main", "Q", "r", "c2", "q", "2", 30),
        ("k3", 1, "main", "B", "r", "c", "b", "3", 30),  # one value of each: no conflict
        ("k3", 2, "main", "B", "r", None, "B ", "4", 30),
        (None, 3, "main", "N", "r8", "c8", "n", "5", 30),  # no key: in no conflict
        (None, 8, "main", "N", "r9", "c9", "m", "5", 30),
    ]
    parties = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c in ('id_venta', 'edad') else 'string'}" for c in cols))
    review = conflict_rows_of(parties, party_key_conflicts_of(parties))
    write_ordered(review, str(tmp_path / "review"), REVIEW_ORDER, range_bytes=1)
    got = read_ordered(spark, str(tmp_path / "review"), position="position").collect()
    assert [(r["persona_natural_key"], r["nombre_completo"], r["id_venta"], r["email"], r["position"]) for r in got] == [
        ("k1", "Q", 6, "q", 1), ("k1", "Q", 7, "q", 2),
        ("k2", None, 9, "a@x", 3), ("k2", "A", 4, "a@x", 4), ("k2", "Z", 5, "a@x", 5),
    ]
