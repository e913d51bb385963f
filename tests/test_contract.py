from datetime import date

import pytest
from conftest import activity, nullable, rows
from pyspark.sql import types as T

from commutewell.contract import (
    ACTIVITY,
    BONUS_TABLE,
    CSV_FIXED,
    ELIGIBILITY_TABLE,
    HISTORY_FIXED,
    REFERENCE,
    ContractViolation,
    conform,
    contract_diff,
    missing_fields,
)


def test_layout_sizes():
    assert (len(ACTIVITY), len(REFERENCE)) == (22, 23)
    assert REFERENCE.names[-1] == "source_donnees"


def test_conform_orders_casts_and_fills(spark, activities):
    df = activities(activity(date_naissance="6/1/1962", date_embauche="2010-09-01", latitude=1.0, calories=3))
    got = conform(df, REFERENCE, HISTORY_FIXED)
    assert got.columns == REFERENCE.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in REFERENCE]
    row = got.first()
    assert (row.date_naissance, row.date_embauche) == (date(1962, 1, 6), date(2010, 9, 1))
    assert (row.latitude, row.calories, row.date_activite) == (None, None, None)
    assert (row.distance_km, row.date_geocodage, row.evolution_conges) == (5.0, "1970-01-01", 1)
    assert row.source_donnees == "INITIAL_LOAD_BIS"


def test_csv_defaults_differ_in_leave_and_source(activities):
    row = conform(activities(activity()), REFERENCE, CSV_FIXED).first()
    assert (row.evolution_conges, row.source_donnees, row.distance_km) == (None, "INITIAL_LOAD", 5.0)


def test_conform_turns_bad_text_into_null(spark):
    df = spark.createDataFrame([("x", "31/02/2020")], "id_salarie string, date_naissance string")
    row = conform(df, REFERENCE).first()
    assert (row.id_salarie, row.date_naissance) == (None, None)


def test_contract_diff():
    assert contract_diff(ACTIVITY, REFERENCE.names) == []
    assert contract_diff(["a", "b", "source_donnees"], ["a", "source_donnees"], strict=False) == ["b", "source_donnees"]
    with pytest.raises(ContractViolation, match="b"):
        contract_diff(["a", "b"], ["a"])


def test_missing_fields(spark):
    observed = spark.createDataFrame([("k",), ("k",), ("z",)], "f string")
    assert rows(missing_fields(spark, ["k", "latitude"], observed)) == [("latitude",)]


def test_enforce_adds_defaults_and_types(spark):
    df = spark.createDataFrame([(1, 2026, "m", 1.0)], "id_salarie bigint, annee_civile int, moyen_de_deplacement string, montant_prime double")
    got = BONUS_TABLE.enforce(df)
    assert got.columns == BONUS_TABLE.columns
    assert got.schema["id_salarie"].dataType == T.IntegerType()
    assert got.first().statut_paiement == "A PAYER"


def test_violations(spark):
    df = spark.createDataFrame(
        [(1, 2026, 1, 1, True, None, "x"), (1, 2026, 2, 1, True, None, "x"), (2, None, 1, 1, True, None, "x"), (2, None, 1, 1, True, None, "x")],
        nullable(ELIGIBILITY_TABLE.schema),
    )
    assert rows(ELIGIBILITY_TABLE.key_violations(df)) == [(1, 2026, 2)]
    assert ELIGIBILITY_TABLE.null_violations(df).count() == 4
    assert BONUS_TABLE.not_null == ["id_salarie", "annee_civile", "moyen_de_deplacement", "date_calcul_dwh", "source_donnees"]
