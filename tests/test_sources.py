import csv
from datetime import datetime

import pytest
from conftest import activity, rows
from pyspark.sql import functions as F

from commutewell.contract import ACTIVITY, CSV_FIXED, HR_HEADERS, REFERENCE, ContractViolation, conform
from commutewell.operators.monitor import stuck_files
from commutewell.sinks.files import drop_batch, overwrite
from commutewell.sinks.jdbc import upsert_statement, upsert_table
from commutewell.sources import files
from commutewell.sources.jdbc import jdbc_options, partitioned
from commutewell.sources.topic import topic_options


def test_missing_zone_is_empty_or_an_error(spark, tmp_path):
    assert files.read_activities(spark, f"{tmp_path}/none").count() == 0
    assert files.read_activities(spark, f"{tmp_path}/none/*.parquet").columns == ACTIVITY.names
    with pytest.raises(files.MissingInput):
        files.read_activities(spark, f"{tmp_path}/none", required=True)


def write_csv(path, header, *records):
    with open(path, "w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(records)
    return str(path)


def event(**more):
    row = activity(jour="04/05/2026", latitude="NULL", longitude="NULL", adresse_domicile="3, rue du Port") | more
    return ["" if row[n] is None else row[n] for n in ACTIVITY.names]


def test_activity_csv(spark, tmp_path):
    path = write_csv(tmp_path / "e.csv", ACTIVITY.names, event(), event(nom="NULL", evolution_conges=1, calories=450))
    df = files.read_activity_csv(spark, path)
    assert [f.dataType for f in df.schema] == [f.dataType for f in ACTIVITY]
    first, second = df.collect()
    assert (first.latitude, first.adresse_domicile, first.date_activite) == (None, "3, rue du Port", "04/05/2026")
    assert (second.nom, second.evolution_conges, second.calories) == (None, 1, 450)


def test_activity_csv_with_another_header_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "e.csv", ACTIVITY.names[::-1], event())
    with pytest.raises(Exception, match="(?i)header"):
        files.read_activity_csv(spark, path).collect()


def hr_row(number, address="1, rue du Lac"):
    return [number, "Petit", "Noa", "6/1/1962", "R&D", "1/9/2010", "27820.5", "CDI", 25, address, "Marche/running"]


def test_hr_csv(spark, tmp_path):
    header = ["\ufeffID salarié ", *[f" {h} " for h in list(HR_HEADERS)[1:]]]
    path = write_csv(tmp_path / "hr.csv", header, hr_row(1), hr_row(2, "sans virgule"))
    df = conform(files.read_hr_csv(spark, path), REFERENCE, CSV_FIXED)
    assert rows(df, "id_salarie", "date_naissance", "salaire_brut", "jours_cp", "adresse_domicile", "distance_km") == [
        (1, datetime(1962, 1, 6).date(), 27820.5, 25, "1, rue du Lac", 5.0),
        (2, datetime(1962, 1, 6).date(), 27820.5, 25, "sans virgule", 5.0),
    ]


def test_hr_csv_without_birth_date_column_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "hr.csv", ["ID salarié", "Nom"], [1, "Petit"])
    with pytest.raises(ContractViolation, match="Date de naissance"):
        files.read_hr_csv(spark, path)


def test_overwrite_replaces_and_counts(activities, spark, tmp_path):
    zone = f"{tmp_path}/historique"
    assert overwrite(activities(activity(), activity()), zone) == 2
    assert overwrite(activities(activity()), zone, files=1) == 1
    assert files.count_files(spark, zone) == 1
    assert files.read_activities(spark, zone).count() == 1
    assert overwrite(activities(), zone) == 0


def test_drops_add_files_and_leave_no_marker(activities, spark, tmp_path):
    zone = f"{tmp_path}/live"
    before = files.count_files(spark, zone)
    path = drop_batch(activities(activity(), activity()), zone, "b1", files=1)
    assert before == 0 and files.count_files(spark, zone) == 1
    assert not (tmp_path / "live" / "b1.parquet" / "_SUCCESS").exists()
    assert path.endswith("/live/b1.parquet")
    with pytest.raises(Exception, match="(?i)exists"):
        drop_batch(activities(activity()), zone, "b1")
    assert "/test_batch_20" in drop_batch(activities(activity()), zone)


def test_inventory_lists_entries(activities, spark, tmp_path):
    zone = f"{tmp_path}/live"
    drop_batch(activities(*[activity()] * 4).repartition(2), zone, "b1")
    (tmp_path / "live" / "f.parquet").write_bytes(b"x")
    (tmp_path / "live" / "note.txt").write_text("x")
    (tmp_path / "live" / "deep").mkdir()
    (tmp_path / "live" / "deep" / "g.parquet").write_bytes(b"x")
    assert rows(files.inventory(spark, zone), "entry", "n_files") == [("b1.parquet", 2), ("f.parquet", 1)]


@pytest.mark.parametrize(("minute", "stuck"), [(0, 0), (1, 1)])
def test_stuck_after_more_than_two_hours(spark, minute, stuck):
    found = spark.createDataFrame([("a.parquet", 1, datetime(2026, 1, 1, 8, 0))], files.INVENTORY)
    as_of = F.lit(f"2026-01-01 10:0{minute}:00").cast("timestamp")
    assert stuck_files(found, as_of).count() == stuck


def test_topic_options():
    assert topic_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"}
    assert topic_options("h:1", "t", bounded=True, extra={"minPartitions": "9"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest",
        "minPartitions": "9",
    }


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t", user="u") == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    assert partitioned("id", 1, 9, 3)["numPartitions"] == "3"


def test_upsert_statement():
    assert upsert_statement("t", "stage", ["k", "a", "b"], ["k"], ["a"]) == (
        "INSERT INTO t (k, a, b) SELECT k, a, b FROM stage ON CONFLICT (k) DO UPDATE SET a = excluded.a"
    )
    assert upsert_statement("t", "stage", ["k"], ["k"], []).endswith("ON CONFLICT (k) DO NOTHING")


class Connection:
    def __init__(self, fail=False):
        self.log, self.fail = [], fail

    def cursor(self):
        return self

    def execute(self, sql):
        self.log.append(sql.split()[0])
        if self.fail:
            raise RuntimeError("refused")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_upsert_table_is_one_transaction(activities, monkeypatch):
    staged = []
    monkeypatch.setattr("commutewell.sinks.jdbc.refresh_table", lambda *a, **k: staged.append(a[2]))
    connection = Connection()
    upsert_table(activities(), "jdbc:x", "t", "stage", ["id_salarie"], ["nom"], lambda: connection)
    assert staged == ["stage"]
    assert connection.log == ["INSERT", "DROP", "close", "commit", "close"]


def test_upsert_table_passes_errors_on(activities, monkeypatch):
    monkeypatch.setattr("commutewell.sinks.jdbc.refresh_table", lambda *a, **k: None)
    connection = Connection(fail=True)
    with pytest.raises(RuntimeError, match="refused"):
        upsert_table(activities(), "jdbc:x", "t", "stage", ["id_salarie"], ["nom"], lambda: connection)
    assert connection.log == ["INSERT", "close", "rollback", "close"]
