import csv
import os
import time

import pytest
from conftest import BIKE, BUS, WALK, activity, rows
from pyspark.sql import functions as F

from commutewell.contract import ACTIVITY, HR_HEADERS, ContractViolation
from commutewell.functions.wire import from_json_payload
from commutewell.plans import landing, loads, reports
from commutewell.plans.lake import Lake, Parameters
from commutewell.session import CLUSTER_CONF
from commutewell.sinks.files import drop_batch
from commutewell.sources.files import MissingInput, count_files, read_activities
from commutewell.streaming.bronze import stream_files

CODEC = from_json_payload(ACTIVITY)
ELIGIBLE = ("id_salarie", "annee_civile", "nombre_activites_total", "seuil_applique", "est_eligible", "source_donnees")
BONUS = ("id_salarie", "annee_civile", "moyen_de_deplacement", "salaire_brut_base", "montant_prime", "statut_paiement", "source_donnees")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"{tmp_path}/lake")


def messages(df):
    text = F.to_json(F.struct(*ACTIVITY.names)).cast("binary")
    return df.select(F.concat(F.unhex(F.lit("0000000001")), text).alias("value"))


HISTORY = [
    *[activity(1, BIKE, f"2025-03-{d:02d} 08:00:00", date_naissance="6/1/1962") for d in range(1, 12)],
    activity(1, WALK, "2025-06-01 08:00:00", nom="Durand-Roy", date_naissance="6/1/1962"),
    *[activity(2, BUS, "2025-03-01 08:00:00", salaire=20000.0) for _ in range(3)],
]


def test_history_load(lake, activities):
    assert landing.land_history(lake, messages(activities(*HISTORY)), CODEC) == 15
    for _ in range(2):
        loads.load_history(lake)
        assert rows(lake.eligibility.read(), *ELIGIBLE) == [
            (1, 2025, 12, 10, True, "INITIAL_LOAD_BIS"),
            (2, 2025, 3, 10, False, "INITIAL_LOAD_BIS"),
        ]
        assert rows(lake.bonus.read(), *BONUS) == [
            (1, 2025, WALK, 30000.0, 2.5, "A PAYER", "INITIAL_LOAD_BIS"),
            (1, 2025, BIKE, 30000.0, 27.5, "A PAYER", "INITIAL_LOAD_BIS"),
        ]
        people = rows(lake.reference.read(), "id_salarie", "nom", "salaire_brut", "date_naissance", "distance_km", "source_donnees")
        assert [(r[0], r[1], r[2], str(r[3]), r[4], r[5]) for r in people] == [
            (1, "Durand-Roy", 30000.0, "1962-01-06", 5.0, "INITIAL_LOAD_BIS"),
            (2, "Durand", 20000.0, "None", 5.0, "INITIAL_LOAD_BIS"),
        ]


def test_history_must_exist(lake):
    with pytest.raises(MissingInput):
        loads.load_history(lake)


def test_history_with_two_salaries_is_refused(lake, activities):
    landing.land_history(lake, messages(activities(activity(salaire=1.0), activity(salaire=2.0))), CODEC)
    with pytest.raises(ContractViolation, match="fct_primes_transport"):
        loads.load_history(lake)
    assert lake.bonus.read().count() == lake.eligibility.read().count() == 0


def test_history_is_replaced_on_landing(lake, activities, spark):
    for n in (5, 2):
        landing.land_history(lake, messages(activities(*[activity()] * n)), CODEC, files=1)
    assert read_activities(spark, lake.history).count() == 2


def stream_in(lake, activities, name, *records):
    topic = f"{lake.root}/topic"
    messages(activities(*records)).write.parquet(f"{topic}/{name}")
    source = stream_files(lake.spark, f"{topic}/*", "value binary")
    landing.land_live(lake, source, CODEC, bounded=True).awaitTermination()


def test_live_load(lake, activities, spark):
    stream_in(lake, activities, "a", *[activity(1, commentaire="Top")] * 14, activity(9, jour="abc"))
    drop_batch(activities(activity(1, WALK), activity(2, BIKE, sport=None)), lake.drops, "d")
    assert loads.load_live(lake) == 2
    assert rows(lake.eligibility.read(), *ELIGIBLE) == [(1, 2026, 15, 15, True, "LIVE")]
    assert [r[:3] + r[4:6] for r in rows(lake.bonus.read(), *BONUS)] == [
        (1, 2026, WALK, 1500.0, "A PAYER"),
        (1, 2026, BIKE, 1500.0, "A PAYER"),
        (2, 2026, BIKE, 1500.0, "A PAYER"),
    ]
    assert rows(lake.reference.read(), "id_salarie", "distance_km", "nom", "source_donnees") == [
        (1, 10.5, None, "LIVE"), (2, 10.5, None, "LIVE"), (9, 10.5, None, "LIVE"),
    ]
    assert spark.read.parquet(f"{lake.messages}/*").count() == 16
    assert rows(spark.read.parquet(f"{lake.undated}/*")) == [(9, "Date Invalide", None)]


def test_live_load_takes_each_file_once(lake, activities):
    assert loads.load_live(lake) == 0
    drop_batch(activities(activity(1)), lake.drops, "a")
    assert loads.load_live(lake) > 0
    assert loads.load_live(lake) == 0
    drop_batch(activities(activity(2)), lake.drops, "b")
    assert loads.load_live(lake) > 0
    assert rows(lake.eligibility.read(), "id_salarie", "nombre_activites_total") == [(1, 1), (2, 1)]


def test_an_interrupted_live_load_is_completed_with_its_own_files(lake, activities, monkeypatch):
    parameters = Parameters(live_mode="accumulate")
    drop_batch(activities(activity(1)), lake.drops, "a")
    with monkeypatch.context() as patch:
        patch.setattr(loads.op, "congratulations", lambda df: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            loads.load_live(lake, parameters)
    drop_batch(activities(activity(1), activity(1)), lake.drops, "b")
    loads.load_live(lake, parameters)
    assert rows(lake.eligibility.read(), "nombre_activites_total") == [(1,)]
    loads.load_live(lake, parameters)
    assert rows(lake.eligibility.read(), "nombre_activites_total") == [(3,)]
    assert loads.load_live(lake, parameters) == 0


def test_reset_and_run_again_gives_the_same_facts(lake, activities):
    drop_batch(activities(*[activity(i % 3) for i in range(9)]), lake.drops, "a")
    parameters = Parameters(live_threshold=3, bonus_rate=0.07, live_mode="accumulate")
    loads.load_live(lake, parameters)
    before = rows(lake.eligibility.read(), *ELIGIBLE), rows(lake.bonus.read(), *BONUS)
    loads.reset_live(lake)
    assert lake.eligibility.read().count() == lake.bonus.read().count() == 0
    loads.load_live(lake, parameters)
    assert (rows(lake.eligibility.read(), *ELIGIBLE), rows(lake.bonus.read(), *BONUS)) == before
    assert before[1][0][4] == pytest.approx(2100.0)


def hr_file(path, *records, header=tuple(HR_HEADERS)):
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        csv.writer(out).writerows([header, *records])
    return str(path)


def hr_row(number, name):
    return [number, name, "Noa", "6/1/1962", "R&D", "1/9/2010", 27820.5, "CDI", 25, "1, rue du Lac", WALK]


def test_reference_load_replaces_everyone(lake, tmp_path):
    assert loads.load_reference(lake, hr_file(tmp_path / "a.csv", hr_row(1, "A"), hr_row(2, "B"))) == 2
    assert loads.load_reference(lake, hr_file(tmp_path / "b.csv", hr_row(2, "C"))) == 1
    row = lake.reference.read().first()
    assert (row.id_salarie, row.nom, str(row.date_embauche), row.jours_cp) == (2, "C", "2010-09-01", 25)
    assert (row.distance_km, row.evolution_conges, row.source_donnees) == (5.0, None, "INITIAL_LOAD")


def test_reference_load_with_an_id_twice_keeps_the_old_table(lake, tmp_path):
    loads.load_reference(lake, hr_file(tmp_path / "a.csv", hr_row(1, "A")))
    with pytest.raises(ContractViolation):
        loads.load_reference(lake, hr_file(tmp_path / "b.csv", hr_row(2, "B"), hr_row(2, "C")))
    assert rows(lake.reference.read(), "nom") == [("A",)]


def test_live_update_keeps_the_loaded_person(lake, activities, tmp_path):
    loads.load_reference(lake, hr_file(tmp_path / "a.csv", hr_row(1, "A")))
    drop_batch(activities(activity(1), activity(5)), lake.drops, "a")
    loads.load_live(lake)
    assert rows(lake.reference.read(), "id_salarie", "nom", "latitude", "evolution_conges", "source_donnees") == [
        (1, "A", 43.6, 0, "INITIAL_LOAD"), (5, None, 43.6, 0, "LIVE"),
    ]


def test_injected_events_reach_the_facts(lake, tmp_path):
    path = tmp_path / "events.csv"
    record = activity(jour="04/05/2026", latitude="NULL", adresse_domicile="3, rue du Port")
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out).writerows([ACTIVITY.names, *[["" if record[n] is None else record[n] for n in ACTIVITY.names]] * 5])
    landing.inject_events(lake, str(path), "five")
    loads.load_live(lake)
    assert rows(lake.eligibility.read(), *ELIGIBLE[:3]) == [(1, 2026, 5)]


def test_large_injected_file_is_shared_among_tasks(lake, spark, tmp_path):
    path = tmp_path / "events.csv"
    with open(path, "w", encoding="utf-8", newline="") as out:
        records = [activity(n, jour="04/05/2026", adresse_domicile=f"{n}, rue du Port") for n in range(300)]
        csv.writer(out).writerows([ACTIVITY.names, *[["" if r[c] is None else r[c] for c in ACTIVITY.names] for r in records]])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        dropped = landing.inject_events(lake, str(path), "large")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", CLUSTER_CONF["spark.sql.files.maxPartitionBytes"])
    assert lake.waiting(lake.drops) == ["large.parquet"]
    assert count_files(spark, dropped) >= os.path.getsize(path) // 4096
    assert rows(read_activities(spark, dropped), "id_salarie", "adresse_domicile") == sorted(
        [(n, f"{n}, rue du Port") for n in range(300)], key=repr
    )
    assert landing.inject_events(lake, str(path), "small", files=1) and count_files(spark, f"{lake.drops}/small.parquet") == 1


def test_audit(lake, activities, spark):
    landing.land_history(lake, messages(activities(*HISTORY)), CODEC)
    loads.load_history(lake)
    drop_batch(activities(activity(1), activity(3, jour="abc")), lake.drops, "a")
    loads.load_live(lake)
    for _ in range(2):
        report = reports.audit(lake)
        assert rows(lake.quarantine.read()) == [(1, "Prime Hors Bornes", 1500.0), (3, "Date Invalide", None)]
    verdicts = {r.check_name: r.passed for r in report["checks"].collect()}
    assert verdicts["Seuil alerte prime"] is False and verdicts["row_count"] is True
    assert rows(report["people"]) == [("Durand-Roy", "Lou"), (None, None)]
    assert rows(report["alert"]) == sorted(
        [(2, None, "⚠️ *Alerte Qualité* : 2 anomalies détectées."), (None, "Collaborateur", None), (None, "Lou Durand-Roy", None)], key=repr
    )


def test_health_report_of_an_empty_lake(lake):
    row = reports.health_report(lake, alarm_when_empty=True).first()
    assert (row.total_salaries, row.total_faits, row.total_rejets, row.fichiers_bloques) == (0, 0, 0, 0)
    assert row.ratio_rejet == 0.0 and row.alerte_vide


def test_health_report_sees_files_that_wait_too_long(lake, activities, tmp_path):
    drop_batch(activities(activity(1)), lake.drops, "old")
    drop_batch(activities(activity(1)), lake.drops, "new")
    aged = time.time() - 3 * 3600
    folder = tmp_path / "lake" / "bronze" / "drops" / "old.parquet"
    for file in folder.iterdir():
        os.utime(file, (aged, aged))
    assert reports.health_report(lake).first().fichiers_bloques == 1
    loads.load_live(lake)
    row = reports.health_report(lake).first()
    assert row.fichiers_bloques == 0
    assert (row.total_salaries, row.total_faits) == (1, 2)


def test_waiting_entries_of_the_stream_zone(lake, activities):
    stream_in(lake, activities, "a", activity(1))
    assert lake.waiting_entries().count() > 0
    loads.load_live(lake)
    assert lake.waiting_entries().count() == 0


def test_fact_counts(lake, activities):
    drop_batch(activities(activity(1), activity(1, WALK)), lake.drops, "a")
    loads.load_live(lake)
    assert rows(reports.fact_counts(lake)) == [("Eligibilité", 1), ("Primes", 2)]


def test_command_line(lake, activities, tmp_path, capsys):
    from commutewell.__main__ import main

    export = hr_file(tmp_path / "a.csv", hr_row(1, "A"))
    drop_batch(activities(activity(1)), lake.drops, "a")
    main([lake.root, "load-reference", export])
    main([lake.root, "load-live", "--rate", "0.1", "--threshold", "1"])
    main([lake.root, "audit"])
    main([lake.root, "health"])
    main([lake.root, "counts"])
    text = capsys.readouterr().out
    assert "1 employees loaded" in text and "Noa A" in text and "Quarantaine : 1 lignes" in text
    assert rows(lake.bonus.read(), "montant_prime") == [(3000.0,)]
    main([lake.root, "expire"])
    assert rows(lake.bonus.read(), "montant_prime") == [(3000.0,)]
    main([lake.root, "reset-live"])
    assert lake.bonus.read().count() == 0


def test_history_rows_without_a_date_are_set_aside(lake, activities, spark):
    landing.land_history(lake, messages(activities(*HISTORY, activity(5, jour="abc"), activity(6, jour="2025-03-01 foo"))), CODEC)
    loads.load_history(lake)
    assert rows(spark.read.parquet(f"{lake.undated}/*")) == [(5, "Date Invalide", None), (6, "Date Invalide", None)]
    reports.audit(lake)
    assert rows(lake.quarantine.read(), "id_salarie") == [(5,), (6,)]


def test_live_zones_only_hold_what_waits(lake, activities):
    stream_in(lake, activities, "a", activity(1))
    drop_batch(activities(activity(2)), lake.drops, "d")
    assert len(lake.waiting(lake.live)) == len(lake.waiting(lake.drops)) == 1
    loads.load_live(lake)
    assert lake.waiting(lake.live) == lake.waiting(lake.drops) == []
    assert lake.storage.names(lake.archive) == ["batch=0"]
    loads.reset_live(lake)
    assert loads.load_live(lake) == 1 and rows(lake.eligibility.read(), "id_salarie") == [(1,), (2,)]


@pytest.mark.parametrize(("column", "value"), [("Salaire brut", "27 820,50"), ("ID salarié", "3000000000"), ("Date de naissance", "45321")])
def test_an_export_with_a_value_that_does_not_fit_is_refused(lake, tmp_path, column, value):
    loads.load_reference(lake, hr_file(tmp_path / "a.csv", hr_row(1, "A")))
    bad = dict(zip(HR_HEADERS, hr_row(2, "B"))) | {column: value}
    with pytest.raises(ContractViolation, match="do not fit"):
        loads.load_reference(lake, hr_file(tmp_path / "b.csv", list(bad.values())))
    assert rows(lake.reference.read(), "nom") == [("A",)]


def test_a_stored_table_without_a_contract_column_stops_the_load(lake, tmp_path, spark):
    loads.load_reference(lake, hr_file(tmp_path / "a.csv", hr_row(1, "A")))
    (folder,) = (tmp_path / "lake" / "gold" / "ref_salaries" / "data" / f"v={lake.reference.version}").glob("_bucket=*")
    spark.read.parquet(str(folder)).drop("calories").write.parquet(f"{tmp_path}/old")
    for file in folder.glob("*.parquet"):
        file.unlink()
    for file in (tmp_path / "old").glob("*.parquet"):
        file.rename(f"{folder}/{file.name}")
    with pytest.raises(ContractViolation, match="calories"):
        loads.load_reference(lake, hr_file(tmp_path / "b.csv", hr_row(2, "B")))
