import pytest
from conftest import BIKE, WALK, activity, rows
from pyspark.sql import functions as F

from commutewell.contract import ACTIVITY, BONUS_TABLE, ELIGIBILITY_TABLE
from commutewell.functions.wire import decode, from_json_payload
from commutewell.operators import facts
from commutewell.sinks.files import drop_batch
from commutewell.sinks.snapshot import ImpossibleBatch, SnapshotTable
from commutewell.sources.files import read_activities
from commutewell.streaming.bronze import land, query_id, stream_files
from commutewell.streaming.facts import merge_facts, stream_facts

SHOWN = ("id_salarie", "annee_civile", "nombre_activites_total", "est_eligible")


def some(n, **more):
    return [activity(id_salarie=i % 3, moyen=[BIKE, WALK][i % 2], commentaire=f"c{i}", **more) for i in range(n)]


def run(spark, zone, out, **options):
    land(stream_files(spark, zone, ACTIVITY, **options), f"{out}/live", f"{out}/checkpoint", bounded=True).awaitTermination()
    return read_activities(spark, f"{out}/live/*.parquet")


def test_landed_stream_equals_the_batch(activities, spark, tmp_path):
    zone = f"{tmp_path}/in"
    drop_batch(activities(*some(20)), zone, "a")
    assert rows(run(spark, f"{zone}/*.parquet", tmp_path)) == rows(activities(*some(20)))


def test_a_restart_goes_on_where_it_stopped(activities, spark, tmp_path):
    zone = f"{tmp_path}/in"
    drop_batch(activities(*some(5)), zone, "a")
    assert run(spark, f"{zone}/*.parquet", tmp_path).count() == 5
    assert run(spark, f"{zone}/*.parquet", tmp_path).count() == 5
    drop_batch(activities(*some(3)), zone, "b")
    assert run(spark, f"{zone}/*.parquet", tmp_path).count() == 8


def test_one_decode_serves_batch_and_stream(activities, spark, tmp_path):
    text = F.to_json(F.struct(*ACTIVITY.names)).cast("binary")
    messages = activities(*some(6)).select(F.concat(F.unhex(F.lit("0000000001")), text).alias("value"))
    messages.write.parquet(f"{tmp_path}/topic")
    codec = from_json_payload(ACTIVITY)
    batch = decode(spark.read.parquet(f"{tmp_path}/topic"), codec)
    stream = decode(stream_files(spark, f"{tmp_path}/topic", messages.schema), codec)
    land(stream, f"{tmp_path}/live", f"{tmp_path}/checkpoint", bounded=True).awaitTermination()
    assert rows(read_activities(spark, f"{tmp_path}/live/*.parquet")) == rows(batch) == rows(activities(*some(6)))


@pytest.fixture
def tables(spark, tmp_path):
    return {
        "eligibility": SnapshotTable(spark, f"{tmp_path}/e", ELIGIBILITY_TABLE),
        "bonus": SnapshotTable(spark, f"{tmp_path}/b", BONUS_TABLE),
    }


def test_streamed_facts_equal_the_batch(activities, spark, tmp_path, tables):
    zone = f"{tmp_path}/in"
    for i in range(3):
        drop_batch(activities(*some(10 + i, salaire=100.0 * (i + 1), jour=f"2026-01-0{i + 1} 08:00:00")), zone, f"d{i}", files=1)
    source = stream_files(spark, f"{zone}/*.parquet", ACTIVITY, maxFilesPerTrigger="1")
    stream_facts(
        source, f"{tmp_path}/checkpoint", undated=f"{tmp_path}/undated", bounded=True, mode="accumulate", threshold=11, **tables
    ).awaitTermination()
    everything = read_activities(spark, f"{zone}/*.parquet")
    assert rows(tables["eligibility"].read(), *SHOWN) == rows(facts.eligibility(everything, 11), *SHOWN)
    key = ("id_salarie", "annee_civile", "moyen_de_deplacement", "montant_prime")
    assert rows(tables["bonus"].read(), *key) == rows(facts.bonus_by_rate(everything), *key)
    name = f"stream-{query_id(spark, f'{tmp_path}/checkpoint')}"
    assert tables["eligibility"].applied(name) == 2 and tables["eligibility"].applied("live") == -1


def test_streamed_activities_that_no_fact_counts_are_set_aside(activities, spark, tmp_path, tables):
    drop_batch(activities(activity(1), activity(2, jour="abc"), activity(3, jour="45321")), f"{tmp_path}/in", "a")
    source = stream_files(spark, f"{tmp_path}/in/*.parquet", ACTIVITY)
    stream_facts(source, f"{tmp_path}/checkpoint", undated=f"{tmp_path}/undated", bounded=True, **tables).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/undated/*")) == [(2, "Date Invalide", None), (3, "Date Invalide", None)]


def test_a_new_checkpoint_is_another_stream(activities, spark, tmp_path, tables):
    for n in range(2):
        drop_batch(activities(activity(n)), f"{tmp_path}/in{n}", "a")
        source = stream_files(spark, f"{tmp_path}/in{n}/*.parquet", ACTIVITY)
        stream_facts(source, f"{tmp_path}/checkpoint{n}", undated=f"{tmp_path}/undated", bounded=True, **tables).awaitTermination()
    merge_facts(activities(activity(7)), 0, **tables)
    assert rows(tables["eligibility"].read(), "id_salarie") == [(0,), (1,), (7,)]


def test_a_number_that_the_stream_cannot_repeat_is_refused(activities, tables):
    for batch in (0, 1):
        merge_facts(activities(activity()), batch, **tables)
    with pytest.raises(ImpossibleBatch):
        merge_facts(activities(activity()), 0, **tables)


def test_a_landed_batch_is_not_landed_twice(activities, spark, tmp_path):
    """The reader took the entry away before the query could note that it was done."""
    drop_batch(activities(*some(4)), f"{tmp_path}/in", "a")
    assert run(spark, f"{tmp_path}/in/*.parquet", tmp_path).count() == 4
    (entry,) = (tmp_path / "live").glob("*.parquet")
    entry.rename(tmp_path / "taken.parquet")
    (tmp_path / "checkpoint" / "commits" / "0").unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    land(stream_files(spark, f"{tmp_path}/in/*.parquet", ACTIVITY), f"{tmp_path}/live", f"{tmp_path}/checkpoint", bounded=True).awaitTermination()
    assert list((tmp_path / "live").glob("*.parquet")) == []


def test_replacing_batches_shrink_the_year(activities, tables):
    merge_facts(activities(*[activity()] * 20), 0, **tables)
    merge_facts(activities(*[activity()] * 2), 1, **tables)
    assert rows(tables["eligibility"].read(), *SHOWN) == [(1, 2026, 2, False)]


def test_a_replayed_batch_changes_nothing(activities, tables):
    df = activities(*[activity()] * 8)
    for batch in (0, 0, 1, 1):
        merge_facts(df, batch, mode="accumulate", **tables)
    assert rows(tables["eligibility"].read(), *SHOWN) == [(1, 2026, 16, True)]


def test_a_batch_applied_to_one_table_only_is_completed(activities, tables):
    df = activities(*[activity()] * 8)
    tables["bonus"].merge(facts.bonus_by_rate(df), ["montant_prime"], True, "live", 0)
    merge_facts(df, 0, mode="accumulate", **tables)
    assert rows(tables["eligibility"].read(), *SHOWN) == [(1, 2026, 8, False)]


def test_unknown_mode(activities, tables):
    with pytest.raises(ValueError, match="sum"):
        merge_facts(activities(), 0, mode="sum", **tables)
