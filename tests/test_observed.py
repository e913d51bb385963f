"""Counts taken by the run that writes."""

import json

from conftest import activity
from pyspark.sql import functions as F

from commutewell.contract import ACTIVITY
from commutewell.functions.wire import from_json_payload
from commutewell.operators.dispatch import json_layout
from commutewell.operators.quality import landing_measures
from commutewell.plans import landing
from commutewell.plans.lake import Lake
from commutewell.sinks.files import drop_batch, overwrite_observed
from commutewell.sources.files import read_activities
from commutewell.sources.storage import Storage
from commutewell.streaming.bronze import landed_counts, query_id, stream_files

ODD = [activity(jour="abc"), activity(id_salarie=None), activity(distance_km=900.0), activity(distance_km=-1.0), activity(), activity()]
SEEN = {"landed": 6, "undated": 2, "no_employee": 1, "rejected": 2}


def topic(frame, number=7):
    text = F.to_json(F.struct(*ACTIVITY.names)).cast("binary")
    return frame.select(F.concat(F.unhex(F.lit(f"{number:010x}")), text).alias("value"))


def test_measures_come_from_the_run_that_writes(activities, spark, tmp_path):
    rows = activities(*ODD)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("observed", "")
    try:
        assert overwrite_observed(rows, f"{tmp_path}/zone", landing_measures(rows)) == SEEN
        assert jobs() == 1  # nothing is read again, no footer either
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.read.parquet(f"{tmp_path}/zone").count() == 6


def test_no_rows_are_zero(activities, tmp_path):
    rows = activities()
    assert overwrite_observed(rows, f"{tmp_path}/zone", landing_measures(rows)) == dict.fromkeys(SEEN, 0)


def test_one_row_a_batch_after_a_repeated_one(activities, spark, tmp_path):
    """A run that ended before its mark left counts; the repeated batch replaces them."""
    lake, codec = Lake(spark, str(tmp_path)), from_json_payload(ACTIVITY)
    messages = topic(activities(*ODD))
    assert landing.live_counts(lake).count() == 0
    for name in "ab":
        drop_batch(messages, f"{tmp_path}/topic", name)
        stream = stream_files(spark, f"{tmp_path}/topic/*.parquet", messages.schema)
        landing.land_live(lake, stream, codec, bounded=True).awaitTermination()
    assert {r.batch: r.landed for r in landing.live_counts(lake).collect()} == {0: 6, 1: 6}
    # Undo what came after the counts of batch 1: its commit, its mark and its directory.
    checkpoint, storage = f"{lake.checkpoints}/live", Storage(spark)
    name = f"{query_id(spark, checkpoint)}-{1:012d}"
    storage.delete(f"{checkpoint}/landed/{name}")
    storage.delete(f"{checkpoint}/commits/1")
    storage.delete(f"{checkpoint}/commits/.1.crc")
    storage.delete(f"{lake.live}/{name}.parquet")
    storage.delete(f"{checkpoint}/counts/{name}.json")
    storage.create_text(f"{checkpoint}/counts/{name}.json", json.dumps({"batch": 1, "landed": 99}))
    stream = stream_files(spark, f"{tmp_path}/topic/*.parquet", messages.schema)
    landing.land_live(lake, stream, codec, bounded=True).awaitTermination()
    assert {r.batch: (r.landed, r.undated, r.rejected) for r in landing.live_counts(lake).collect()} == {0: (6, 2, 2), 1: (6, 2, 2)}
    assert read_activities(spark, f"{lake.live}/*.parquet").count() == 12
    assert landed_counts(spark, checkpoint, ["landed"]).columns == ["batch", "landed"]


def test_topics_of_two_schemas_land(activities, spark, tmp_path):
    good = activities(*[activity(id_salarie=i) for i in range(4)])
    renamed = good.withColumnRenamed("nom", "last_name")
    layouts = {7: json_layout(ACTIVITY), 8: json_layout(renamed.schema, renames={"nom": "last_name"})}
    second = renamed.select(F.concat(F.unhex(F.lit("0000000008")), F.to_json(F.struct(*renamed.columns)).cast("binary")).alias("value"))
    messages = topic(good).union(second).union(topic(good, 9))
    lake = Lake(spark, f"{tmp_path}/lake")
    assert landing.land_history_mixed(lake, messages, layouts) == {"landed": 8, "unread": 4}
    assert read_activities(spark, lake.history).where("nom = 'Durand'").count() == 8
    assert {r.schema_id for r in spark.read.parquet(f"{lake.unread}/history").collect()} == {9}
    drop_batch(messages, f"{tmp_path}/topic", "a")
    stream = stream_files(spark, f"{tmp_path}/topic/*.parquet", messages.schema)
    for query in landing.land_live_mixed(lake, stream, layouts, bounded=True):
        query.awaitTermination()
    assert read_activities(spark, f"{lake.live}/*.parquet").count() == 8
    assert spark.read.parquet(f"{lake.unread}/live/*.parquet").count() == 4
