import pytest
from conftest import rows

from commutewell.operators import monitor, quality

REF = "id_salarie int, nom string, prenom string, distance_km double, latitude double, longitude double"


def reference(spark, *data):
    return spark.createDataFrame(list(data), REF)


@pytest.mark.parametrize(("value", "rejected"), [(-0.01, 1), (0.0, 0), (500.0, 0), (500.01, 1), (None, 0)])
def test_bounds(spark, value, rejected):
    df = reference(spark, (1, "n", "p", value, None, None))
    assert quality.rejects(df, quality.DISTANCE_BOUNDS).count() == rejected


def test_quarantine_keeps_every_find(spark):
    df = reference(spark, (1, "n", "p", 600.0, None, None))
    part = quality.rejects(df, quality.DISTANCE_BOUNDS)
    assert rows(quality.quarantine(part, part)) == [(1, "Distance Hors Bornes", 600.0)] * 2


def test_metric_checks(spark):
    df = reference(spark, (1, "n", "p", 3.0, 43.0, 3.0), (2, "n", "p", -1.0, 53.0, None))
    assert rows(quality.metric_checks(df, quality.REFERENCE_CHECKS)) == [
        ("Distance positive", -1.0, False),
        ("Latitude Max France", 53.0, False),
        ("Latitude Min France", 43.0, True),
        ("Longitude Max France", 3.0, True),
        ("Longitude Min France", 3.0, True),
    ]


def test_checks_on_an_empty_table(spark):
    df = reference(spark)
    assert rows(quality.metric_checks(df, quality.RAW_CHECKS)) == [("row_count", 0.0, False)]
    assert {r[1:] for r in rows(quality.metric_checks(df, quality.REFERENCE_CHECKS))} == {(None, None)}


def test_failing_people_are_distinct_names(spark):
    df = reference(
        spark, (1, "A", "x", 0.0, None, None), (2, "A", "x", 0.0, None, None), (3, "B", None, 0.0, None, None),
        (4, "C", "y", 0.0, None, None),
    )
    rejected = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,), (None,)], "id_salarie int")
    assert rows(quality.failing_people(df, rejected)) == [("A", "x"), ("B", None)]


def test_alert_has_one_row_per_person_and_a_count(spark):
    people = spark.createDataFrame([("A", "x"), ("B", None), ("", ""), (None, None), ("A", "x")], "nom string, prenom string")
    assert rows(quality.alert_rows(people)) == sorted(
        [(4, None, "⚠️ *Alerte Qualité* : 4 anomalies détectées."), *[(None, n, None) for n in ("x A", "B", "Collaborateur", "Collaborateur")]],
        key=repr,
    )


def test_alert_has_the_same_shape_at_every_size(spark):
    alert = quality.alert_rows(spark.range(1000).selectExpr("concat('n', id) nom", "'p' prenom")).collect()
    assert sorted(r.name for r in alert if r.name) == sorted(f"p n{i}" for i in range(1000))
    assert [r.n for r in alert if r.message] == [1000]


def test_nobody_failing_counts_zero(spark):
    alert = quality.alert_rows(spark.createDataFrame([], "nom string, prenom string"))
    assert rows(alert) == [(0, None, "⚠️ *Alerte Qualité* : 0 anomalies détectées.")]


def health(spark, people, facts, rejects, stuck=None, **options):
    frames = spark.range(people), [spark.range(facts)], spark.range(rejects), None if stuck is None else spark.range(stuck)
    return monitor.health(*frames, **options).first()


@pytest.mark.parametrize(
    ("facts", "rejects", "ratio", "alarm"), [(0, 0, 0.0, False), (5, 5, 50.0, False), (4, 6, 60.0, True), (9, 1, 10.0, False)]
)
def test_reject_ratio(spark, facts, rejects, ratio, alarm):
    row = health(spark, 3, facts, rejects)
    assert (row.total_salaries, row.total_faits, row.total_rejets) == (3, facts, rejects)
    assert (row.ratio_rejet, row.alerte_qualite) == (ratio, alarm)


def test_report_of_a_healthy_lake(spark):
    text = health(spark, 3, 9, 1, 0).rapport
    assert text == (
        "État du jour : normal\nRéférence : 3 salariés, faits : 9 lignes\n"
        "Quarantaine : 1 lignes, soit 10.0 % (limite 50 %)\nFichiers en attente depuis plus de 120 min : 0"
    )


def test_report_of_stuck_files_and_rejects(spark):
    row = health(spark, 3, 1, 3, 2, load_name="nightly")
    assert row.alerte_fichiers and row.rapport.startswith("État du jour : à vérifier\n")
    assert "soit 75.0 % (au-dessus de 50 %)" in row.rapport
    assert row.rapport.endswith("plus de 120 min : 2 (voir nightly)")


def test_empty_facts_rule_is_an_option(spark):
    assert not health(spark, 3, 0, 0).alerte_vide
    assert "à vérifier" in health(spark, 3, 0, 0, alarm_when_empty=True).rapport


def test_table_counts_are_a_set(spark):
    assert rows(monitor.table_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
