"""Named queries over the given tables, each with the SQL that must give the same rows.

The tables stand in for activity records through thin projections: ``orders`` and ``events`` play
activities, ``customer`` the employee reference. Each projection keeps the table whole.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.contract import (
    ACTIVITY,
    BONUS_TABLE,
    ELIGIBILITY_TABLE,
    HISTORY_FIXED,
    HR_HEADERS,
    QUARANTINE,
    REFERENCE,
    conform,
    key_violations,
    missing_fields,
)
from commutewell.functions.dates import as_date
from commutewell.functions.geo import distance_to_office_km
from commutewell.functions.text import congratulation
from commutewell.functions.wire import decode, from_json_payload
from commutewell.operators import facts, monitor, quality
from commutewell.operators.dedup import distinct_of, latest_per_key
from commutewell.operators.dispatch import json_layout, resolve
from commutewell.operators.filters import matching_modes
from commutewell.operators.lookup import geocode
from commutewell.operators.merge import add, apply_changes, unprocessed, upsert
from commutewell.plans import landing, loads, reports
from commutewell.plans.contributions import CONTRIBUTE, stream_contributions
from commutewell.plans.lake import Lake, Parameters
from commutewell.session import work_dir
from commutewell.sinks.changes import ChangedTable
from commutewell.sinks.files import drop_batch, overwrite
from commutewell.sinks.snapshot import SnapshotTable
from commutewell.sources.files import count_files, entry_of, inventory, read_activity_csv, read_parquet
from commutewell.streaming.bronze import land, stream_files
from commutewell.streaming.delivery import once
from commutewell.streaming.facts import ACCUMULATE, GEO_UPDATE, REPLACE, stream_facts

try:  # the only guard: the subpackage and its pipeline may both be absent
    import corpus_pipeline
    from commutewell.llm import queries as llm
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "commutewell.llm"):
        raise
    corpus_pipeline = llm = None

MODES = ("1-URGENT", "2-HIGH")


# --- Tables and their projections -----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The one-letter glob makes a single file as good as a directory of files.
    return stream_files(spark, f"{sf_dir}/{name}.parque[t]", table(spark, sf_dir, name).schema)


def order_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_salarie"),
        F.col("o_orderdate").alias("date_activite"),
        F.col("o_orderpriority").alias("moyen_de_deplacement"),
        F.col("o_orderstatus").alias("type_sport"),
        F.col("o_totalprice").alias("salaire_brut"),
        "o_orderkey",
    )


def as_event_activities(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("id_salarie"),
        F.col("ts").alias("date_activite"),
        F.col("event_type").alias("moyen_de_deplacement"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("type_sport"),
        F.col("value").alias("salaire_brut"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_salarie"),
        F.col("c_name").alias("nom"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("prenom"),
        F.col("c_acctbal").alias("distance_km"),
        F.when(F.col("c_nationkey") != 0, 40.0 + F.col("c_custkey") % 12).alias("latitude"),
        (-5.0 + F.col("c_custkey") % 15).alias("longitude"),
        "c_nationkey",
        "c_mktsegment",
    )


def contract_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the full activity contract, with one salary per employee."""
    orders = table(spark, sf_dir, "orders")
    return conform(
        orders.select(
            F.col("o_custkey").alias("id_salarie"),
            F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("nom"),
            F.lit("").alias("prenom"),
            F.lit("6/1/1962").alias("date_naissance"),
            (F.col("o_custkey") % 1000 + 1000).cast("float").alias("salaire_brut"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "Marche/running")
            .when(F.col("o_orderpriority") == "2-HIGH", "Vélo/Trottinette/Autres")
            .otherwise("Transports en commun")
            .alias("moyen_de_deplacement"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date_activite"),
            F.when(F.col("o_orderstatus") != "P", "Natation").alias("type_sport"),
            F.when(F.col("o_orderstatus") == "F", "Top").alias("commentaire"),
        ),
        ACTIVITY,
    )


def messages(records: DataFrame) -> DataFrame:
    """Records as framed topic messages with a JSON payload."""
    text = F.to_json(F.struct(*records.columns)).cast("binary")
    header = F.unhex(F.lit("0000000007"))
    return records.select(F.concat(header, text).alias("value"))


def fresh_lake(spark: SparkSession, name: str) -> Lake:
    return Lake(spark, work_dir(spark, name))


# --- Facts ----------------------------------------------------------------------------------------


def q01_bonus_rate(spark, sf_dir):
    rows = order_activities(spark, sf_dir)
    return facts.bonus_by_rate(rows, modes=MODES, tie_break=["o_orderkey"]).drop("date_calcul_dwh")


def q02_bonus_distance(spark, sf_dir):
    rows = order_activities(spark, sf_dir)
    band = rows.withColumn("salaire_brut", F.floor(F.col("salaire_brut") / 100000) * F.lit(100000.0))
    return facts.bonus_by_distance(band, modes=MODES).drop("date_calcul_dwh")


def q03_eligibility(spark, sf_dir):
    rows = as_event_activities(table(spark, sf_dir, "events"))
    return facts.eligibility(rows, threshold=53).drop("date_calcul_dwh")


def q04_mode_regex(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return matching_modes(orders, "urgent|high", "o_orderpriority")


def q05_messages(spark, sf_dir):
    last = F.when(F.col("c_nationkey") % 5 == 0, "").otherwise(F.col("nom"))
    comment = F.when(F.col("c_nationkey") % 3 == 1, "").when(F.col("c_nationkey") % 3 == 2, F.col("c_mktsegment"))
    text = congratulation(F.col("prenom"), last, comment).alias("message")
    return people(spark, sf_dir).select(F.col("id_salarie").alias("c_custkey"), text)


def q06_latest_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


def q07_distinct_pairs(spark, sf_dir):
    return distinct_of(table(spark, sf_dir, "events"), "user_id", "event_type")


# --- Upsert and table rules -----------------------------------------------------------------------


def _halves(spark, sf_dir, *aggregates, mode=False):
    """Orders reduced by employee and year (and mode), for the first and the second half-year."""
    rows = order_activities(spark, sf_dir)
    keys = ["id_salarie", "annee_civile", *(["moyen_de_deplacement"] if mode else [])]
    rows = rows.withColumns(
        {"annee_civile": F.year("date_activite"), "h1": F.month("date_activite") <= 6}
    )
    return [rows.where(half).groupBy(*keys).agg(*aggregates) for half in ("h1", "not h1")]


def q08_upsert_partial(spark, sf_dir):
    top = F.max("salaire_brut")
    first, second = _halves(
        spark, sf_dir, top.alias("salaire_brut_base"), (top * 0.05).alias("montant_prime"), mode=True
    )
    target = first.withColumn("statut_paiement", F.lit("PAYE"))
    keys = ["id_salarie", "annee_civile", "moyen_de_deplacement"]
    return upsert(target, second, keys, ["montant_prime"], {"statut_paiement": "A PAYER"}, True, full_keys=True)


def q09_upsert_replace(spark, sf_dir):
    first, second = _halves(spark, sf_dir, F.count("*").alias("nombre_activites_total"))

    def judged(df, threshold):
        return df.withColumns(
            {
                "seuil_applique": F.lit(threshold),
                "est_eligible": F.col("nombre_activites_total") >= threshold,
            }
        )

    update = ["nombre_activites_total", "est_eligible"]
    keys = ["id_salarie", "annee_civile"]
    return upsert(judged(first, 3), judged(second, 2), keys, update, unique_source=True, full_keys=True)


def q10_upsert_all_columns(spark, sf_dir):
    users = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey"))
    target = users.agg(F.max("event_type").alias("c_name"), F.max("value").alias("c_acctbal"))
    return upsert(target, table(spark, sf_dir, "customer").select(*target.columns), ["c_custkey"])


def q11_key_violations(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("annee_civile", F.year("o_orderdate"))
    return key_violations(orders, ["o_custkey", "annee_civile", "o_orderpriority"])


def q27_upsert_accumulate(spark, sf_dir):
    first, second = _halves(spark, sf_dir, F.count("*").alias("nombre_activites_total"))
    update = {"nombre_activites_total": add}
    return upsert(first, second, ["id_salarie", "annee_civile"], update, unique_source=True, full_keys=True)


def q30_geo_upsert(spark, sf_dir):
    columns = ["id_salarie", "nom", *GEO_UPDATE, "source_donnees"]
    target = conform(people(spark, sf_dir), REFERENCE, HISTORY_FIXED).select(*columns)
    moment = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    source = facts.geo_update(order_activities(spark, sf_dir), as_of=moment)
    return upsert(target, source, ["id_salarie"], GEO_UPDATE, unique_source=True)


# --- Quality and monitoring -----------------------------------------------------------------------

DISTANCE = quality.Bounds("Distance Hors Bornes", "distance_km", 0, 9500)
PRICE = quality.Bounds("Prime Hors Bornes", "salaire_brut", 0, 400000)


def _quarantine(spark, sf_dir):
    return quality.quarantine(
        quality.rejects(people(spark, sf_dir), DISTANCE), quality.rejects(order_activities(spark, sf_dir), PRICE)
    )


def q12_failed_people(spark, sf_dir):
    reference = people(spark, sf_dir).withColumn("prenom", F.col("c_mktsegment"))
    return quality.failing_people(reference, _quarantine(spark, sf_dir))


def q13_quarantine(spark, sf_dir):
    return _quarantine(spark, sf_dir)


def q14_alert_text(spark, sf_dir):
    return quality.alert_rows(people(spark, sf_dir).where("distance_km < 0"))


def q15_health(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return monitor.health(
        customer,
        [table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")],
        customer.where("c_acctbal < 0"),
    )


def q16_metric_checks(spark, sf_dir):
    bonus = order_activities(spark, sf_dir).withColumnRenamed("salaire_brut", "montant_prime")
    return (
        quality.metric_checks(people(spark, sf_dir), quality.REFERENCE_CHECKS)
        .unionByName(quality.metric_checks(bonus, quality.BONUS_CHECKS))
        .unionByName(quality.metric_checks(table(spark, sf_dir, "events"), quality.RAW_CHECKS))
    )


def q26_table_counts(spark, sf_dir):
    return monitor.table_counts({"Primes": table(spark, sf_dir, "orders"), "Eligibilité": table(spark, sf_dir, "events")})


def q28_file_inventory(spark, sf_dir):
    """Two dropped tables, their rows, and whether they wait too long by a clock that runs ahead for one of them."""
    zone = work_dir(spark, "inventory")
    dropped = {name: drop_batch(table(spark, sf_dir, name), zone, name) for name in ("orders", "events")}
    counts = [
        read_parquet(spark, path).agg(F.count("*").alias("n_rows")).select(F.lit(f"{name}.parquet").alias("entry"), "n_rows")
        for name, path in dropped.items()
    ]
    found = inventory(spark, zone)
    clock = F.current_timestamp() + F.when(F.col("entry") == "orders.parquet", F.expr("INTERVAL 3 HOURS")).otherwise(F.expr("INTERVAL 1 HOUR"))
    stuck = monitor.stuck_files(found, clock).select("entry", F.lit(True).alias("stuck"))
    listed = found.join(stuck, "entry", "left").join(counts[0].unionByName(counts[1]), "entry")
    total = found.agg(F.sum("n_files")).scalar() == count_files(spark, zone)
    return listed.select("entry", F.coalesce("stuck", F.lit(False)).alias("stuck"), "n_rows", (F.col("n_files") > 0).alias("has_files"), total.alias("counts_agree"))


# --- Scalar transforms, lookups, contract ---------------------------------------------------------


def q17_haversine(spark, sf_dir):
    distance = F.round(distance_to_office_km(F.col("latitude"), F.col("longitude")), 6)
    return people(spark, sf_dir).select(F.col("id_salarie").alias("c_custkey"), distance.alias("distance_km"))


def q18_geocode_lookup(spark, sf_dir):
    """Keys are shifted, so that some occur in no place."""
    places = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("place"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 5).alias("c_nationkey"))
    return geocode(customers, places, "c_nationkey", "n_nationkey").drop("c_nationkey")


def q19_conform(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_salarie"),
        F.col("c_name").alias("nom"),
        F.col("c_mktsegment").alias("bu"),
        F.col("c_acctbal").alias("salaire_brut"),
    )
    return conform(rows, REFERENCE, HISTORY_FIXED)


def q20_contract_diff(spark, sf_dir):
    keys = table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")))
    return missing_fields(spark, ["k", "latitude", "distance_km"], keys)


def q21_dayfirst_dates(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    written = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("d"))
    return written.select("o_orderkey", as_date(F.col("d")).alias("d"))


def q22_wire_decode(spark, sf_dir):
    framed = F.concat(F.unhex(F.lit("0000000007")), F.col("props").cast("binary")).alias("value")
    topic = table(spark, sf_dir, "events").select("event_id", framed)
    record = T.StructType([T.StructField("k", T.IntegerType())])
    return decode(topic, from_json_payload(record), keep=["event_id"])


def q23_apply_changes(spark, sf_dir):
    deleted = F.when(F.col("event_type") == "error", "true").otherwise("false").alias("__deleted")
    feed = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts", deleted)
    return apply_changes(feed, ["user_id"], ["ts", "event_id"]).drop("ts")


def q29_unprocessed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return unprocessed(orders, table(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"})


# --- Streams --------------------------------------------------------------------------------------


def q24_stream_bronze_append(spark, sf_dir):
    work = work_dir(spark, "bronze")
    source = table_stream(spark, sf_dir, "events")
    land(source, f"{work}/live", f"{work}/checkpoint", bounded=True).awaitTermination()
    return read_parquet(spark, f"{work}/live/*.parquet", source.schema)


def _three_batches(spark, activities, work, fact, bonus=None, **options):
    """Stream ``activities`` into the facts in three micro-batches: the query stops and starts between them."""
    part = F.pmod(F.hash("date_activite", "id_salarie", "moyen_de_deplacement"), F.lit(3))
    for n in range(3):
        drop_batch(activities.where(part == n), f"{work}/in", f"part{n}")
        source = stream_files(spark, f"{work}/in/*.parquet", activities.schema)
        stream_facts(
            source, f"{work}/checkpoint", fact, f"{work}/undated", bonus, bounded=True, mode=ACCUMULATE, **options
        ).awaitTermination()


def q25_stream_facts(spark, sf_dir):
    work = work_dir(spark, "facts")
    fact = SnapshotTable(spark, f"{work}/fact", ELIGIBILITY_TABLE)
    _three_batches(spark, as_event_activities(table(spark, sf_dir, "events")), work, fact, threshold=53)
    return fact.read().select("id_salarie", "annee_civile", "nombre_activites_total", "est_eligible")


# --- Readers, writers and whole loads -------------------------------------------------------------


def q31_csv_scan(spark, sf_dir):
    path = work_dir(spark, "csv")
    contract_activities(spark, sf_dir).write.csv(path, header=True, nullValue="NULL", emptyValue='""')
    return read_activity_csv(spark, path).select(
        "id_salarie", "nom", "date_naissance", "salaire_brut", "moyen_de_deplacement", "type_sport", "latitude"
    )


def q32_reference_load(spark, sf_dir):
    """HR export with byte-order mark, padded headers and day-first dates, loaded as the reference."""
    lake = fresh_lake(spark, "reference")
    born = F.expr("make_date(1960 + c_custkey % 40, 1 + c_custkey % 12, 1 + c_custkey % 28)")
    values = {
        "id_salarie": F.col("c_custkey"),
        "nom": F.col("c_name"),
        "date_naissance": F.date_format(born, "d/M/yyyy"),
        "salaire_brut": F.col("c_acctbal"),
        "adresse_domicile": F.concat(F.col("c_nationkey").cast("string"), F.lit(", rue du Port")),
    }
    titles = {name: title for title, name in HR_HEADERS.items()}
    columns = [
        values.get(name, F.lit(None).cast("string")).alias(("\ufeff" if name == "id_salarie" else "") + titles[name] + " ")
        for name in HR_HEADERS.values()
    ]
    table(spark, sf_dir, "customer").select(*columns).write.csv(f"{lake.root}/export", header=True)
    loads.load_reference(lake, f"{lake.root}/export")
    return lake.reference.read().select(
        "id_salarie", "nom", "date_naissance", "salaire_brut", "adresse_domicile", "distance_km", "date_geocodage",
        "evolution_conges", "source_donnees",
    )


def q33_overwrite_zone(spark, sf_dir):
    path = f"{work_dir(spark, 'zone')}/historique"
    rows = contract_activities(spark, sf_dir)
    overwrite(rows.where("type_sport is null"), path)
    written = overwrite(rows, path)
    zone = read_parquet(spark, path, ACTIVITY)
    return zone.groupBy("moyen_de_deplacement").agg(F.count("*").alias("n")).withColumn("written", F.lit(written).cast("bigint"))


def q34_batch_drops(spark, sf_dir):
    zone = work_dir(spark, "drops")
    events = table(spark, sf_dir, "events")
    drop_batch(events.where("event_type = 'error'"), zone, "error")
    drop_batch(events.where("event_type <> 'error'"), zone, "other")
    dropped = read_parquet(spark, f"{zone}/*.parquet", events.schema)
    entry = entry_of(spark, zone, "_metadata.file_path").alias("entry")
    return dropped.select(entry).groupBy("entry").agg(F.count("*").alias("n"))


def _history(spark, sf_dir, name):
    """A lake whose history was landed from framed messages and loaded."""
    lake = fresh_lake(spark, name)
    landing.land_history(lake, messages(contract_activities(spark, sf_dir)), from_json_payload(ACTIVITY))
    loads.load_history(lake)
    return lake


def q35_history_bonus(spark, sf_dir):
    return _history(spark, sf_dir, "history").bonus.read().drop("date_calcul_dwh")


def q36_history_reference(spark, sf_dir):
    reference = _history(spark, sf_dir, "people").reference.read()
    return reference.select(
        "id_salarie", "nom", "date_naissance", "salaire_brut", "moyen_de_deplacement", "distance_km", "date_geocodage",
        "evolution_conges", "date_activite", "source_donnees",
    )


def _live(spark, sf_dir, name):
    """A lake with one drop that was loaded, reset and loaded again."""
    lake = fresh_lake(spark, name)
    drop_batch(contract_activities(spark, sf_dir), lake.drops, "activities")
    parameters = Parameters(live_threshold=3)
    loads.load_live(lake, parameters)
    loads.reset_live(lake)
    loads.load_live(lake, parameters)
    return lake


def q37_live_eligibility(spark, sf_dir):
    return _live(spark, sf_dir, "live").eligibility.read().drop("date_calcul_dwh")


def q38_live_messages(spark, sf_dir):
    lake = _live(spark, sf_dir, "texts")
    return read_parquet(spark, f"{lake.messages}/*", "id_salarie int, message string")


def q39_audit(spark, sf_dir):
    lake = _history(spark, sf_dir, "audit")
    loads_ = people(spark, sf_dir).select("id_salarie", (F.col("distance_km") / 10).alias("distance_km"))
    lake.reference.merge(loads_, ["distance_km"], unique_source=True)
    return reports.audit(lake)["checks"]


# --- Rows that are set aside, batches onto filled tables, reports of a lake -------------------------------


def q40_date_shapes(spark, sf_dir):
    """Dates of both notations between text that only looks like one."""
    orders = table(spark, sf_dir, "orders")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    shapes = [
        iso, F.concat(F.lit(" \t"), F.date_format("o_orderdate", "d/M/yyyy"), F.lit("\n")), F.col("o_orderkey").cast("string"),
        F.concat(iso, F.lit(" foo")), F.year("o_orderdate").cast("string"), F.date_format("o_orderdate", "yyyy-MM"),
        F.concat(F.lit("\t"), iso, F.lit("T08:30:00")), F.concat(F.lit("31/2/"), F.year("o_orderdate").cast("string")),
    ]
    text = F.element_at(F.array(*shapes), F.pmod("o_orderkey", F.lit(len(shapes))).cast("int") + 1)
    return orders.select("o_orderkey", as_date(text).alias("d"))


def spoiled_activities(spark, sf_dir):
    """Orders as activities, some with an unreadable date, some without an employee."""
    n = F.col("id_salarie") % 10
    rows = contract_activities(spark, sf_dir)
    return conform(
        rows.withColumns(
            {
                "date_activite": F.when(n == 3, "abc").when(n == 4, "45321").otherwise(F.col("date_activite")),
                "id_salarie": F.when(n != 5, F.col("id_salarie")),
            }
        ),
        ACTIVITY,
    )


def q41_history_quarantine(spark, sf_dir):
    lake = fresh_lake(spark, "spoiled")
    landing.land_history(lake, messages(spoiled_activities(spark, sf_dir)), from_json_payload(ACTIVITY))
    loads.load_history(lake)
    return read_parquet(spark, f"{lake.undated}/*", QUARANTINE)


def q42_history_eligibility(spark, sf_dir):
    return _history(spark, sf_dir, "years").eligibility.read().drop("date_calcul_dwh")


def _two_drops(spark, sf_dir, name, mode):
    """A lake after two live loads, the second onto the tables that the first one filled."""
    lake = fresh_lake(spark, name)
    rows = contract_activities(spark, sf_dir)
    late = F.substring("date_activite", 6, 2) > "06"
    for name_, part in (("first", rows.where(~late)), ("second", rows.where(late))):
        drop_batch(part, lake.drops, name_)
        loads.load_live(lake, Parameters(live_threshold=3, live_mode=mode))
    return lake


def q43_live_bonus(spark, sf_dir):
    return _two_drops(spark, sf_dir, "bonus", REPLACE).bonus.read().drop("date_calcul_dwh")


def q44_live_replace(spark, sf_dir):
    return _two_drops(spark, sf_dir, "replace", REPLACE).eligibility.read().drop("date_calcul_dwh")


def q45_live_accumulate(spark, sf_dir):
    return _two_drops(spark, sf_dir, "accumulate", ACCUMULATE).eligibility.read().drop("date_calcul_dwh")


def q46_stream_quarantine(spark, sf_dir):
    work = work_dir(spark, "stream-undated")
    fact = SnapshotTable(spark, f"{work}/fact", ELIGIBILITY_TABLE)
    _three_batches(spark, spoiled_activities(spark, sf_dir), work, fact)
    return read_parquet(spark, f"{work}/undated/*", QUARANTINE)


def q47_stream_bonus(spark, sf_dir):
    work = work_dir(spark, "stream-bonus")
    fact = SnapshotTable(spark, f"{work}/fact", ELIGIBILITY_TABLE)
    bonus = SnapshotTable(spark, f"{work}/bonus", BONUS_TABLE)
    _three_batches(spark, contract_activities(spark, sf_dir), work, fact, bonus)
    return bonus.read().drop("date_calcul_dwh")


def q48_stream_then_live(spark, sf_dir):
    """A stream and the live load number their batches apart, though they fill the same table."""
    lake = fresh_lake(spark, "origins")
    rows = contract_activities(spark, sf_dir)
    work = f"{lake.root}/stream"
    _three_batches(spark, rows.where("salaire_brut % 2 = 0"), work, lake.eligibility, lake.bonus, threshold=3)
    drop_batch(rows.where("salaire_brut % 2 = 1"), lake.drops, "rest")
    loads.load_live(lake, Parameters(live_threshold=3, live_mode=ACCUMULATE))
    return lake.eligibility.read().drop("date_calcul_dwh")


def _audited(spark, sf_dir, name):
    lake = _history(spark, sf_dir, name)
    far = people(spark, sf_dir).select("id_salarie", (F.col("distance_km") / 10).alias("distance_km"))
    lake.reference.merge(far, ["distance_km"], unique_source=True)
    return lake, reports.audit(lake)


def q49_audit_quarantine(spark, sf_dir):
    return _audited(spark, sf_dir, "rejected")[0].quarantine.read()


def q50_audit_people(spark, sf_dir):
    return _audited(spark, sf_dir, "failing")[1]["people"]


def q51_lake_health(spark, sf_dir):
    lake, _ = _audited(spark, sf_dir, "health")
    drop_batch(contract_activities(spark, sf_dir), lake.drops, "waiting")
    later = F.current_timestamp() + F.expr("INTERVAL 3 HOURS")
    return reports.health_report(lake, later).drop("rapport")


def q52_injected_events(spark, sf_dir):
    lake = fresh_lake(spark, "injected")
    contract_activities(spark, sf_dir).write.csv(f"{lake.root}/csv", header=True, nullValue="NULL", emptyValue='""')
    landing.inject_events(lake, f"{lake.root}/csv", "events")
    loads.load_live(lake, Parameters(live_threshold=3))
    return lake.eligibility.read().drop("date_calcul_dwh")


# --- Facts by origin, stored change feeds, repeated delivery ---------------------------------------

BY_ORIGIN = Parameters(live_threshold=3, live_mode=CONTRIBUTE)


def _in_parts(rows, folder, part, n, run):
    """Drop ``rows`` in ``n`` parts by the column ``part`` and call ``run`` with the stream of all drops after each."""
    for i in range(n):
        drop_batch(rows.where(part == i), folder, f"part{i}")
        run(stream_files(rows.sparkSession, f"{folder}/*.parquet", rows.schema)).awaitTermination()


def _stream_by_origin(rows, lake):
    part = F.pmod(F.hash("date_activite", "id_salarie", "moyen_de_deplacement", "salaire_brut"), F.lit(3))
    checkpoint = f"{lake.checkpoints}/facts"
    _in_parts(rows, f"{lake.root}/in", part, 3, lambda s: stream_contributions(s, checkpoint, lake, BY_ORIGIN, bounded=True))


def q53_reset_keeps_streams(spark, sf_dir):
    """Streamed and live activities of the same employees; a reset takes back the live ones only, which come again."""
    lake = fresh_lake(spark, "withdrawn")
    rows = contract_activities(spark, sf_dir)
    live = F.substring("date_activite", 9, 2) > "15"
    _stream_by_origin(rows.where(~live), lake)
    drop_batch(rows.where(live), lake.drops, "rest")
    loads.load_live(lake, BY_ORIGIN)
    loads.reset_live(lake, BY_ORIGIN)
    loads.load_live(lake, BY_ORIGIN)
    return lake.eligibility.read().drop("date_calcul_dwh")


def salaried_activities(spark, sf_dir):
    """Orders as activities with a salary of their own each."""
    salary = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_salarie"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date_activite"),
        F.col("o_totalprice").cast("float").alias("salaire_brut"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Marche/running").otherwise("Transports en commun").alias("moyen_de_deplacement"),
        F.when(F.col("o_orderstatus") != "P", "Natation").alias("type_sport"),
    )
    return conform(salary, ACTIVITY, {"nom": "", "prenom": ""})


def q54_late_salaries(spark, sf_dir):
    """Three micro-batches in no order of time: the salary of the latest activity counts, whenever it arrived."""
    lake = fresh_lake(spark, "salaries")
    _stream_by_origin(salaried_activities(spark, sf_dir), lake)
    return lake.bonus.read().drop("date_calcul_dwh")


def q55_live_withdrawn(spark, sf_dir):
    """History and live activities of the same years; after a reset the history's facts are back."""
    lake = fresh_lake(spark, "history-left")
    rows = contract_activities(spark, sf_dir)
    late = F.substring("date_activite", 6, 2) > "06"
    landing.land_history(lake, messages(rows.where(~late)), from_json_payload(ACTIVITY))
    loads.load_history(lake, BY_ORIGIN)
    drop_batch(rows.where(late), lake.drops, "late")
    loads.load_live(lake, BY_ORIGIN)
    loads.reset_live(lake, BY_ORIGIN)
    return lake.bonus.read().drop("date_calcul_dwh")


def q56_stored_changes(spark, sf_dir):
    """A change feed in three shuffled batches, with deletes that arrive before what they delete."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    present = ChangedTable(spark, work_dir(spark, "changes"), events.schema, ["user_id"], ["ts", "event_id"])
    flag = F.when(F.col("event_type") == "error", "true").otherwise("false").alias("__deleted")
    for n in range(3):
        present.apply(events.select("*", flag).where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n), stream="feed", batch=n)
    return present.read().drop("ts")


def q57_repeated_delivery(spark, sf_dir):
    """A stream in order of arrival that delivers a third of what it had before again with every batch."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx("ts", [0.33, 0.66])).first()[0]
    arrival = F.when(F.col("ts") <= cuts[0], 0).when(F.col("ts") <= cuts[1], 1).otherwise(2)
    again = F.when(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0, F.sequence(arrival, F.lit(2))).otherwise(F.array(arrival))
    delivered = events.select("*", F.explode(again).alias("part"))
    work = work_dir(spark, "delivery")
    _in_parts(
        delivered, f"{work}/in", F.col("part"), 3,
        lambda s: land(once(s, ["event_id"], "ts", "1 hour"), f"{work}/landed", f"{work}/checkpoint", bounded=True),
    )
    landed = read_parquet(spark, f"{work}/landed/*.parquet", delivered.schema)
    return landed.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("n_events"))


def mixed_messages(spark, sf_dir):
    """``events`` as one topic of two layouts, an unknown one, broken payloads and messages without a header."""
    events = table(spark, sf_dir, "events")
    kind = F.pmod("event_id", F.lit(7))
    first = F.to_json(F.struct("event_id", "user_id", "value", F.col("event_type").alias("kind")))
    second = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").cast("int").alias("user_id")))
    text = F.when(kind <= 2, first).when(kind == 5, F.lit("{broken")).otherwise(second)
    header = F.when(kind <= 2, "0000000007").when(kind == 6, "0000000009").otherwise("0000000008")
    framed = F.concat(F.unhex(header), text.cast("binary"))
    return events.select("event_id", F.when(kind == 0, F.lit(None)).when(kind == 1, F.unhex(F.lit("000102"))).otherwise(framed).alias("value"))


def q58_mixed_schemas(spark, sf_dir):
    """Messages of two layouts become one record, with a rename, a promotion and a default; the rest says why not."""
    contract = T.StructType.fromDDL("event_key long not null, user_id long, amount double, kind string")
    first = T.StructType.fromDDL("event_id long, user_id long, value double, kind string")
    second = T.StructType.fromDDL("id long, user_id int")
    layouts = {
        7: json_layout(first, renames={"event_key": "event_id", "amount": "value"}),
        8: json_layout(second, renames={"event_key": "id"}, defaults={"kind": "unknown"}),
    }
    return resolve(mixed_messages(spark, sf_dir), layouts, contract, keep=["event_id"]).drop("value")


def q59_observed_history(spark, sf_dir):
    """What the run that wrote the history zone counted, beside the zone's own rows."""
    lake = fresh_lake(spark, "observed")
    seen = landing.land_history_observed(lake, messages(spoiled_activities(spark, sf_dir)), from_json_payload(ACTIVITY))
    zone = read_parquet(spark, lake.history, ACTIVITY).agg(F.count("*").alias("n"))
    return zone.select("n", *[F.lit(count).cast("bigint").alias(name) for name, count in seen.items()])


def q60_observed_stream(spark, sf_dir):
    """What three micro-batches landed, each counted while it was written."""
    lake = fresh_lake(spark, "observed_live")
    topic = messages(spoiled_activities(spark, sf_dir))
    parts = topic.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)).cast("int"))
    _in_parts(parts, f"{lake.root}/topic", F.col("part"), 3, lambda s: landing.land_live(lake, s, from_json_payload(ACTIVITY), bounded=True))
    counts = landing.live_counts(lake)
    names = [c for c in counts.columns if c != "batch"]
    return counts.agg(F.count("*").alias("batches"), *[F.sum(c).alias(c) for c in names])


# --- Contract with the driver ---------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Who earned the wellness days?"""
    return q03_eligibility(spark, "/root/testdata/sf0.001")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each takes (spark, sf_dir)."""
    named = [(name, value) for name, value in globals().items() if name[0] == "q" and name[1:3].isdigit()]
    return dict(sorted(named)) | llm_queries()


_HISTORY = """
  SELECT CAST(o_custkey AS INTEGER) AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Marche/running' WHEN '2-HIGH' THEN 'Vélo/Trottinette/Autres'
              ELSE 'Transports en commun' END AS moyen_de_deplacement,
         CAST(o_custkey % 1000 + 1000 AS DOUBLE) AS salaire, o_orderstatus, o_orderdate
  FROM orders"""

_UNDATED = """
SELECT CASE WHEN o_custkey % 10 <> 5 THEN CAST(o_custkey AS INTEGER) END AS id_salarie, 'Date Invalide' AS check_name,
       CAST(NULL AS DOUBLE) AS value
FROM orders WHERE o_custkey % 10 IN (3, 4, 5)"""

_SQL = {
    "q01_bonus_rate": """
SELECT o_custkey AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile,
       o_orderpriority AS moyen_de_deplacement,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS salaire_brut_base,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) * CAST(0.05 AS DOUBLE) AS montant_prime,
       'LIVE' AS source_donnees
FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH') GROUP BY 1,2,3""",
    "q02_bonus_distance": """
SELECT o_custkey AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile,
       o_orderpriority AS moyen_de_deplacement,
       floor(o_totalprice / 100000) * CAST(100000 AS DOUBLE) AS salaire_brut_base,
       count(*) * CAST(2.5 AS DOUBLE) AS montant_prime, 'A PAYER' AS statut_paiement,
       'INITIAL_LOAD_BIS' AS source_donnees
FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH') GROUP BY 1,2,3,4""",
    "q03_eligibility": """
SELECT user_id AS id_salarie, CAST(year(ts) AS INTEGER) AS annee_civile, count(*) AS nombre_activites_total,
       CAST(53 AS INTEGER) AS seuil_applique, count(*) >= 53 AS est_eligible, 'LIVE' AS source_donnees
FROM events WHERE NULLIF(event_type,'error') IS NOT NULL GROUP BY 1,2""",
    "q04_mode_regex": """
SELECT o_orderkey, o_orderpriority FROM orders WHERE regexp_matches(o_orderpriority, '(?i)urgent|high')""",
    "q05_messages": """
SELECT c_custkey, 'Bravo ' || CASE WHEN n = '' THEN 'Collaborateur' ELSE n END ||
       CASE WHEN k IS NULL OR k = '' THEN ' !' ELSE ' ! c''est ' || k || ' !' END AS message
FROM (SELECT c_custkey,
             trim(coalesce(NULLIF(c_mktsegment,'BUILDING'),'') || ' ' ||
                  CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE c_name END) AS n,
             CASE c_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment END AS k
      FROM customer)""",
    "q06_latest_per_key": """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "q07_distinct_pairs": "SELECT DISTINCT user_id, event_type FROM events",
    "q08_upsert_partial": """
WITH b AS (SELECT o_custkey AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile,
                  o_orderpriority AS moyen_de_deplacement, month(o_orderdate) <= 6 AS h1,
                  max(o_totalprice) AS salaire_brut_base, max(o_totalprice) * CAST(0.05 AS DOUBLE) AS montant_prime
           FROM orders GROUP BY 1,2,3,4),
     t AS (SELECT * FROM b WHERE h1), s AS (SELECT * FROM b WHERE NOT h1)
SELECT id_salarie, annee_civile, moyen_de_deplacement,
       coalesce(t.salaire_brut_base, s.salaire_brut_base) AS salaire_brut_base,
       coalesce(s.montant_prime, t.montant_prime) AS montant_prime,
       CASE WHEN t.h1 THEN 'PAYE' ELSE 'A PAYER' END AS statut_paiement
FROM t FULL JOIN s USING (id_salarie, annee_civile, moyen_de_deplacement)""",
    "q09_upsert_replace": """
WITH b AS (SELECT o_custkey AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile,
                  month(o_orderdate) <= 6 AS h1, count(*) AS n FROM orders GROUP BY 1,2,3),
     t AS (SELECT * FROM b WHERE h1), s AS (SELECT * FROM b WHERE NOT h1)
SELECT id_salarie, annee_civile, coalesce(s.n, t.n) AS nombre_activites_total,
       CAST(CASE WHEN t.h1 THEN 3 ELSE 2 END AS INTEGER) AS seuil_applique,
       coalesce(s.n >= 2, t.n >= 3) AS est_eligible
FROM t FULL JOIN s USING (id_salarie, annee_civile)""",
    "q10_upsert_all_columns": """
WITH t AS (SELECT user_id AS c_custkey, max(event_type) AS c_name, max(value) AS c_acctbal FROM events GROUP BY 1)
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal
FROM t FULL JOIN customer s ON t.c_custkey = s.c_custkey""",
    "q11_key_violations": """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS annee_civile, o_orderpriority, count(*) AS n
FROM orders GROUP BY 1,2,3 HAVING count(*) > 1""",
    "q12_failed_people": """
WITH q AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9500
           UNION ALL SELECT o_custkey FROM orders WHERE o_totalprice < 0 OR o_totalprice > 400000)
SELECT DISTINCT c.c_name AS nom, c.c_mktsegment AS prenom FROM customer c JOIN q ON c.c_custkey = q.id""",
    "q13_quarantine": """
SELECT c_custkey AS id_salarie, 'Distance Hors Bornes' AS check_name, c_acctbal AS value
FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9500
UNION ALL
SELECT o_custkey, 'Prime Hors Bornes', o_totalprice FROM orders WHERE o_totalprice < 0 OR o_totalprice > 400000""",
    "q14_alert_text": """
WITH p AS (SELECT DISTINCT coalesce(NULLIF(c_mktsegment,'BUILDING'),'') AS prenom, c_name AS nom
           FROM customer WHERE c_acctbal < 0)
SELECT count(*) AS n, CAST(NULL AS VARCHAR) AS name, '⚠️ *Alerte Qualité* : ' || count(*) || ' anomalies détectées.' AS message FROM p
UNION ALL SELECT NULL, trim(prenom || ' ' || nom), NULL FROM p""",
    "q15_health": """
WITH m AS (SELECT (SELECT count(*) FROM customer) AS a,
                  (SELECT count(*) FROM orders) + (SELECT count(*) FROM events) AS f,
                  (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS r),
     x AS (SELECT *, CASE WHEN f + r > 0 THEN CAST(r AS DOUBLE) / CAST(f + r AS DOUBLE) * 100 ELSE 0 END AS p FROM m)
SELECT a AS total_salaries, f AS total_faits, r AS total_rejets, CAST(0 AS BIGINT) AS fichiers_bloques,
       p AS ratio_rejet, p > 50 AS alerte_qualite, false AS alerte_fichiers, false AS alerte_vide,
       'État du jour : ' || CASE WHEN p > 50 THEN 'à vérifier' ELSE 'normal' END || chr(10) ||
       'Référence : ' || a || ' salariés, faits : ' || f || ' lignes' || chr(10) ||
       'Quarantaine : ' || r || ' lignes, soit ' || printf('%.1f', p) ||
       CASE WHEN p > 50 THEN ' % (au-dessus de 50 %)' ELSE ' % (limite 50 %)' END || chr(10) ||
       'Fichiers en attente depuis plus de 120 min : 0' AS rapport
FROM x""",
    "q16_metric_checks": """
WITH g AS (SELECT c_acctbal AS d, CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(40 + c_custkey % 12 AS DOUBLE) END AS lat,
                  CAST(-5 + c_custkey % 15 AS DOUBLE) AS lon FROM customer)
SELECT 'Distance positive' AS check_name, min(d) AS value, min(d) >= 0 AS passed FROM g
UNION ALL SELECT 'Latitude Min France', min(lat), min(lat) >= 40 FROM g
UNION ALL SELECT 'Latitude Max France', max(lat), max(lat) <= 52 FROM g
UNION ALL SELECT 'Longitude Min France', min(lon), min(lon) >= -5 FROM g
UNION ALL SELECT 'Longitude Max France', max(lon), max(lon) <= 10 FROM g
UNION ALL SELECT 'Prime positive', min(o_totalprice), min(o_totalprice) >= 0 FROM orders
UNION ALL SELECT 'Seuil alerte prime', max(o_totalprice), max(o_totalprice) <= 500 FROM orders
UNION ALL SELECT 'row_count', CAST(count(*) AS DOUBLE), count(*) > 0 FROM events""",
    "q17_haversine": """
SELECT c_custkey, round(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)), 6) AS distance_km
FROM (SELECT c_custkey, power(sin(radians(43.5673 - lat) / 2), 2)
             + cos(radians(lat)) * cos(radians(43.5673)) * power(sin(radians(3.8965 - lon) / 2), 2) AS a
      FROM (SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(40 + c_custkey % 12 AS DOUBLE) END AS lat,
                   CAST(-5 + c_custkey % 15 AS DOUBLE) AS lon FROM customer))""",
    "q18_geocode_lookup": """
SELECT c.c_custkey, n.n_name AS place FROM customer c
LEFT JOIN nation n ON c.c_nationkey + 5 = n.n_nationkey""",
    "q19_conform": """
SELECT CAST(c_custkey AS INTEGER) AS id_salarie, c_name AS nom, CAST(NULL AS VARCHAR) AS prenom,
       CAST(NULL AS DATE) AS date_naissance, c_mktsegment AS bu, CAST(NULL AS DATE) AS date_embauche,
       c_acctbal AS salaire_brut, CAST(NULL AS VARCHAR) AS type_contrat, CAST(NULL AS INTEGER) AS jours_cp,
       CAST(NULL AS VARCHAR) AS adresse_domicile, CAST(NULL AS VARCHAR) AS moyen_de_deplacement,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST(5.0 AS DOUBLE) AS distance_km,
       '1970-01-01' AS date_geocodage, CAST(1 AS INTEGER) AS evolution_conges, CAST(NULL AS VARCHAR) AS date_activite,
       CAST(NULL AS VARCHAR) AS type_sport, CAST(NULL AS INTEGER) AS distance_m, CAST(NULL AS INTEGER) AS duree_s,
       CAST(NULL AS INTEGER) AS calories, CAST(NULL AS VARCHAR) AS commentaire, 'INITIAL_LOAD_BIS' AS source_donnees
FROM customer""",
    "q20_contract_diff": """
SELECT f AS missing_column FROM (SELECT unnest(['k','latitude','distance_km']) AS f)
EXCEPT SELECT unnest(json_keys(props)) FROM events""",
    "q21_dayfirst_dates": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders",
    "q22_wire_decode": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "q23_apply_changes": """
SELECT user_id, event_id, event_type, value FROM
  (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type <> 'error'""",
    "q24_stream_bronze_append": "SELECT * FROM events",
    "q25_stream_facts": """
SELECT CAST(user_id AS INTEGER) AS id_salarie, CAST(year(ts) AS INTEGER) AS annee_civile,
       count(*) AS nombre_activites_total, count(*) >= 53 AS est_eligible
FROM events WHERE event_type <> 'error' GROUP BY 1,2""",
    "q26_table_counts": """
SELECT 'Primes' AS "table", count(*) AS n FROM orders UNION SELECT 'Eligibilité', count(*) FROM events""",
    "q27_upsert_accumulate": """
SELECT o_custkey AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile, count(*) AS nombre_activites_total
FROM orders GROUP BY 1,2""",
    "q29_unprocessed": """
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "q30_geo_upsert": """
WITH s AS (SELECT DISTINCT CAST(o_custkey AS INTEGER) AS id FROM orders),
     t AS (SELECT CAST(c_custkey AS INTEGER) AS id, c_name FROM customer)
SELECT coalesce(t.id, s.id) AS id_salarie, t.c_name AS nom,
       CAST(CASE WHEN s.id IS NULL THEN 5.0 ELSE 10.5 END AS DOUBLE) AS distance_km,
       CAST(CASE WHEN s.id IS NOT NULL THEN 43.6 END AS DOUBLE) AS latitude,
       CAST(CASE WHEN s.id IS NOT NULL THEN 3.9 END AS DOUBLE) AS longitude,
       CAST(CASE WHEN s.id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS evolution_conges,
       CASE WHEN s.id IS NULL THEN '1970-01-01' ELSE '2026-01-01 00:00:00' END AS date_geocodage,
       CASE WHEN t.id IS NULL THEN 'LIVE' ELSE 'INITIAL_LOAD_BIS' END AS source_donnees
FROM t FULL JOIN s ON t.id = s.id""",
    "q31_csv_scan": f"""
SELECT id_salarie, 'N' || id_salarie AS nom, '6/1/1962' AS date_naissance, CAST(salaire AS FLOAT) AS salaire_brut,
       moyen_de_deplacement, CASE WHEN o_orderstatus <> 'P' THEN 'Natation' END AS type_sport,
       CAST(NULL AS DOUBLE) AS latitude
FROM ({_HISTORY})""",
    "q32_reference_load": """
SELECT CAST(c_custkey AS INTEGER) AS id_salarie, c_name AS nom,
       make_date(1960 + c_custkey % 40, 1 + c_custkey % 12, 1 + c_custkey % 28) AS date_naissance,
       c_acctbal AS salaire_brut, c_nationkey || ', rue du Port' AS adresse_domicile, CAST(5.0 AS DOUBLE) AS distance_km,
       '1970-01-01' AS date_geocodage, CAST(NULL AS INTEGER) AS evolution_conges, 'INITIAL_LOAD' AS source_donnees
FROM customer""",
    "q33_overwrite_zone": f"""
SELECT moyen_de_deplacement, count(*) AS n, (SELECT count(*) FROM orders) AS written
FROM ({_HISTORY}) GROUP BY 1""",
    "q34_batch_drops": """
SELECT CASE event_type WHEN 'error' THEN 'error' ELSE 'other' END || '.parquet' AS entry, count(*) AS n
FROM events GROUP BY 1""",
    "q35_history_bonus": f"""
SELECT id_salarie, annee_civile, moyen_de_deplacement, salaire AS salaire_brut_base,
       count(*) * CAST(2.5 AS DOUBLE) AS montant_prime, 'A PAYER' AS statut_paiement, 'INITIAL_LOAD_BIS' AS source_donnees
FROM ({_HISTORY}) WHERE moyen_de_deplacement <> 'Transports en commun' GROUP BY 1,2,3,4""",
    "q36_history_reference": f"""
SELECT id_salarie, 'N' || id_salarie AS nom, DATE '1962-01-06' AS date_naissance, salaire AS salaire_brut,
       arg_max(moyen_de_deplacement, (o_orderdate, moyen_de_deplacement)) AS moyen_de_deplacement,
       CAST(5.0 AS DOUBLE) AS distance_km, '1970-01-01' AS date_geocodage, CAST(1 AS INTEGER) AS evolution_conges,
       CAST(NULL AS VARCHAR) AS date_activite, 'INITIAL_LOAD_BIS' AS source_donnees
FROM ({_HISTORY}) GROUP BY id_salarie, salaire""",
    "q37_live_eligibility": f"""
SELECT id_salarie, annee_civile, count(*) AS nombre_activites_total, CAST(3 AS INTEGER) AS seuil_applique,
       count(*) >= 3 AS est_eligible, 'LIVE' AS source_donnees
FROM ({_HISTORY}) WHERE o_orderstatus <> 'P' GROUP BY 1,2""",
    "q38_live_messages": f"""
SELECT id_salarie, 'Bravo N' || id_salarie || CASE o_orderstatus WHEN 'F' THEN ' ! c''est Top !' ELSE ' !' END AS message
FROM ({_HISTORY}) WHERE o_orderstatus <> 'P'""",
    "q39_audit": f"""
WITH h AS ({_HISTORY}),
     p AS (SELECT count(*) * CAST(2.5 AS DOUBLE) AS prime FROM h WHERE moyen_de_deplacement <> 'Transports en commun'
           GROUP BY id_salarie, annee_civile, moyen_de_deplacement)
SELECT 'Distance positive' AS check_name, min(c_acctbal / 10) AS value, min(c_acctbal / 10) >= 0 AS passed FROM customer
UNION ALL SELECT 'Latitude Min France', NULL, NULL
UNION ALL SELECT 'Latitude Max France', NULL, NULL
UNION ALL SELECT 'Longitude Min France', NULL, NULL
UNION ALL SELECT 'Longitude Max France', NULL, NULL
UNION ALL SELECT 'Prime positive', min(prime), min(prime) >= 0 FROM p
UNION ALL SELECT 'Seuil alerte prime', max(prime), max(prime) <= 500 FROM p
UNION ALL SELECT 'row_count', CAST(count(*) AS DOUBLE), count(*) > 0 FROM h""",
    "q28_file_inventory": """
SELECT 'orders.parquet' AS entry, true AS stuck, count(*) AS n_rows, true AS has_files, true AS counts_agree FROM orders
UNION ALL SELECT 'events.parquet', false, count(*), true, true FROM events""",
    "q40_date_shapes": """
SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 6) THEN CAST(o_orderdate AS DATE) END AS d FROM orders""",
    "q41_history_quarantine": _UNDATED,
    "q42_history_eligibility": f"""
SELECT id_salarie, annee_civile, count(*) AS nombre_activites_total, CAST(10 AS INTEGER) AS seuil_applique,
       count(*) >= 10 AS est_eligible, 'INITIAL_LOAD_BIS' AS source_donnees
FROM ({_HISTORY}) WHERE o_orderstatus <> 'P' GROUP BY 1,2""",
    "q43_live_bonus": f"""
SELECT DISTINCT id_salarie, annee_civile, moyen_de_deplacement, salaire AS salaire_brut_base,
       salaire * CAST(0.05 AS DOUBLE) AS montant_prime, 'A PAYER' AS statut_paiement, 'LIVE' AS source_donnees
FROM ({_HISTORY}) WHERE moyen_de_deplacement <> 'Transports en commun'""",
    "q44_live_replace": f"""
WITH b AS (SELECT id_salarie, annee_civile, month(o_orderdate) > 6 AS late, count(*) AS n
           FROM ({_HISTORY}) WHERE o_orderstatus <> 'P' GROUP BY 1,2,3)
SELECT id_salarie, annee_civile, arg_max(n, late) AS nombre_activites_total, CAST(3 AS INTEGER) AS seuil_applique,
       arg_max(n, late) >= 3 AS est_eligible, 'LIVE' AS source_donnees FROM b GROUP BY 1,2""",
    "q46_stream_quarantine": _UNDATED,
    "q49_audit_quarantine": f"""
SELECT CAST(c_custkey AS INTEGER) AS id_salarie, 'Distance Hors Bornes' AS check_name, c_acctbal / 10 AS value
FROM customer WHERE c_acctbal / 10 < 0 OR c_acctbal / 10 > 500
UNION ALL SELECT id_salarie, 'Prime Hors Bornes', count(*) * CAST(2.5 AS DOUBLE) FROM ({_HISTORY})
WHERE moyen_de_deplacement <> 'Transports en commun' GROUP BY id_salarie, annee_civile, moyen_de_deplacement
HAVING count(*) * 2.5 > 500""",
    "q50_audit_people": f"""
WITH r AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal / 10 < 0 OR c_acctbal / 10 > 500
           UNION SELECT id_salarie FROM ({_HISTORY}) WHERE moyen_de_deplacement <> 'Transports en commun'
           GROUP BY id_salarie, annee_civile, moyen_de_deplacement HAVING count(*) * 2.5 > 500)
SELECT DISTINCT CASE WHEN id IN (SELECT o_custkey FROM orders) THEN 'N' || id END AS nom,
       CASE WHEN id IN (SELECT o_custkey FROM orders) THEN '' END AS prenom FROM r""",
    "q51_lake_health": f"""
WITH h AS ({_HISTORY}),
     b AS (SELECT count(*) AS n FROM h WHERE moyen_de_deplacement <> 'Transports en commun'
           GROUP BY id_salarie, annee_civile, moyen_de_deplacement),
     m AS (SELECT (SELECT count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)) AS a,
                  (SELECT count(*) FROM b)
                  + (SELECT count(*) FROM (SELECT DISTINCT id_salarie, annee_civile FROM h WHERE o_orderstatus <> 'P')) AS f,
                  (SELECT count(*) FROM customer WHERE c_acctbal / 10 < 0 OR c_acctbal / 10 > 500)
                  + (SELECT count(*) FROM b WHERE n * 2.5 > 500) AS r)
SELECT a AS total_salaries, f AS total_faits, r AS total_rejets, CAST(1 AS BIGINT) AS fichiers_bloques,
       CAST(r AS DOUBLE) / CAST(f + r AS DOUBLE) * 100 AS ratio_rejet,
       CAST(r AS DOUBLE) / CAST(f + r AS DOUBLE) * 100 > 50 AS alerte_qualite, true AS alerte_fichiers, false AS alerte_vide
FROM m""",
}
_SQL["q54_late_salaries"] = """
SELECT CAST(o_custkey AS INTEGER) AS id_salarie, CAST(year(o_orderdate) AS INTEGER) AS annee_civile, 'Marche/running' AS moyen_de_deplacement,
       CAST(arg_max(CAST(o_totalprice AS FLOAT), (o_orderdate, CAST(o_totalprice AS FLOAT))) AS DOUBLE) AS salaire_brut_base,
       CAST(arg_max(CAST(o_totalprice AS FLOAT), (o_orderdate, CAST(o_totalprice AS FLOAT))) AS DOUBLE) * CAST(0.05 AS DOUBLE) AS montant_prime,
       'A PAYER' AS statut_paiement, 'LIVE' AS source_donnees
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2"""
_SQL["q55_live_withdrawn"] = f"""
SELECT id_salarie, annee_civile, moyen_de_deplacement, salaire AS salaire_brut_base, count(*) * CAST(2.5 AS DOUBLE) AS montant_prime,
       'A PAYER' AS statut_paiement, 'INITIAL_LOAD_BIS' AS source_donnees
FROM ({_HISTORY}) WHERE moyen_de_deplacement <> 'Transports en commun' AND month(o_orderdate) <= 6 GROUP BY 1,2,3,4"""
_SQL["q56_stored_changes"] = _SQL["q23_apply_changes"]
_SQL["q57_repeated_delivery"] = "SELECT user_id, event_type, count(*) AS n, count(*) AS n_events FROM events GROUP BY 1, 2"
_SQL["q58_mixed_schemas"] = """
SELECT event_id, CASE WHEN k IN (2, 3, 4) THEN event_id END AS event_key, CASE WHEN k IN (2, 3, 4) THEN user_id END AS user_id,
       CASE WHEN k = 2 THEN value END AS amount, CASE k WHEN 2 THEN event_type WHEN 3 THEN 'unknown' WHEN 4 THEN 'unknown' END AS kind,
       CAST(CASE k WHEN 2 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 8 WHEN 5 THEN 8 WHEN 6 THEN 9 END AS BIGINT) AS schema_id,
       CASE k WHEN 0 THEN 'no message' WHEN 1 THEN 'no header' WHEN 5 THEN 'unreadable payload' WHEN 6 THEN 'unknown schema' END AS problem
FROM (SELECT *, event_id % 7 AS k FROM events)"""
_SEEN = """count(*) AS landed, count(*) FILTER (o_custkey % 10 IN (3, 4, 5)) AS undated,
       count(*) FILTER (o_custkey % 10 = 5) AS no_employee, CAST(0 AS BIGINT) AS rejected"""
_SQL["q59_observed_history"] = f"SELECT count(*) AS n, {_SEEN} FROM orders"
_SQL["q60_observed_stream"] = f"SELECT CAST(3 AS BIGINT) AS batches, {_SEEN} FROM orders"
# Every one of these loads ends with the eligibility of all activities.
for _name in ("q45_live_accumulate", "q48_stream_then_live", "q52_injected_events", "q53_reset_keeps_streams"):
    _SQL[_name] = _SQL["q37_live_eligibility"]
_SQL["q47_stream_bonus"] = _SQL["q43_live_bonus"]


def oracle_sql() -> dict[str, str]:
    """SQL per query."""
    return _SQL | (llm.oracle_sql() | ({"pipeline": sql} if (sql := corpus_pipeline.ORACLE_SQL) else {}) if llm else {})
