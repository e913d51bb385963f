"""Facts by origin: any cut and order of the batches, withdrawal of one origin, interrupted steps."""

import random

import pytest
from conftest import BIKE, BUS, WALK, activity, rows

from commutewell.operators import facts as op
from commutewell.plans import contributions, loads
from commutewell.plans.contributions import CONTRIBUTE, contribute, contribute_history, stream_contributions, withdraw
from commutewell.plans.lake import Lake, Parameters
from commutewell.sinks.files import drop_batch
from commutewell.sinks.snapshot import SnapshotTable
from commutewell.streaming.bronze import stream_files

ELIGIBLE = ("id_salarie", "annee_civile", "nombre_activites_total", "seuil_applique", "est_eligible", "source_donnees")
BONUS = ("id_salarie", "annee_civile", "moyen_de_deplacement", "salaire_brut_base", "montant_prime", "statut_paiement", "source_donnees")
PARAMETERS = Parameters(live_threshold=3, live_mode=CONTRIBUTE)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"{tmp_path}/lake")


def facts_of(lake):
    return rows(lake.bonus.read(), *BONUS), rows(lake.eligibility.read(), *ELIGIBLE)


def some_activities(seed, n=40):
    rng = random.Random(seed)
    return [
        activity(
            rng.randrange(1, 5), rng.choice((BIKE, WALK, BUS, None)), f"{rng.choice((2025, 2026))}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 5):02d} 08:00:00",
            rng.choice(("Tennis", None)), float(rng.randrange(1, 6) * 1000),
        )
        for _ in range(n)
    ]


def test_any_cut_in_any_order_gives_the_one_batch_facts(spark, activities, tmp_path):
    records = some_activities(1)
    whole = Lake(spark, f"{tmp_path}/whole")
    contribute(whole, activities(*records), "a", 0, PARAMETERS)
    one = facts_of(whole)
    # The one batch itself agrees with the operators that see all rows.
    df = activities(*records)
    assert [r[:5] for r in one[0]] == rows(op.bonus_by_rate(df), *BONUS[:5])
    assert one[1] == rows(op.eligibility(df, 3), *ELIGIBLE)
    for seed in (2, 3):
        shuffled = records[:]
        random.Random(seed).shuffle(shuffled)
        cut = Lake(spark, f"{tmp_path}/cut{seed}")
        for n, (low, high) in enumerate(((0, 7), (7, 25), (25, 40))):
            contribute(cut, activities(*shuffled[low:high]), ("a", "b", "a")[n], n, PARAMETERS)
        assert facts_of(cut) == one


def test_a_late_older_activity_changes_neither_base_nor_bonus(lake, activities):
    contribute(lake, activities(activity(salaire=3000.0)), "a", 0, PARAMETERS)
    contribute(lake, activities(activity(jour="2026-01-01 08:00:00", salaire=2000.0)), "a", 1, PARAMETERS)
    assert [r[3:5] for r in facts_of(lake)[0]] == [(3000.0, 150.0)]
    contribute(lake, activities(activity(jour="2026-12-01 08:00:00", salaire=4000.0)), "a", 2, PARAMETERS)
    assert [r[3:5] for r in facts_of(lake)[0]] == [(4000.0, 200.0)]


def test_a_withdrawn_origin_leaves_the_others(lake, activities):
    contribute(lake, activities(activity(7), activity(8)), "stream-x", 0, PARAMETERS)
    before = facts_of(lake)
    contribute(lake, activities(activity(8, salaire=9.0, jour="2026-11-01"), activity(8, WALK), activity(9, jour="2024-01-01")), "live", 0, PARAMETERS)
    assert facts_of(lake) != before
    withdraw(lake, "live", PARAMETERS)
    assert facts_of(lake) == before
    withdraw(lake, "live", PARAMETERS)
    assert facts_of(lake) == before
    assert lake.contributions.streams() == {"stream-x"}


def test_a_payment_that_was_made_stays_made(lake, activities, spark):
    contribute(lake, activities(activity()), "a", 0, PARAMETERS)
    paid = lake.bonus.read().replace("A PAYER", "PAYE", ["statut_paiement"]).select("id_salarie", "annee_civile", "moyen_de_deplacement", "statut_paiement")
    lake.bonus.merge(paid, ["statut_paiement"], unique_source=True)
    contribute(lake, activities(activity(jour="2026-11-01", salaire=50.0)), "b", 0, PARAMETERS)
    withdraw(lake, "b", PARAMETERS)
    assert [r[3:6] for r in facts_of(lake)[0]] == [(30000.0, 1500.0, "PAYE")]


@pytest.mark.parametrize("failing", ["bonus", "eligibility", "contributions"])
def test_an_interrupted_step_is_completed_by_repeating_it(lake, activities, monkeypatch, failing):
    contribute(lake, activities(activity(1), activity(2)), "stream-x", 0, PARAMETERS)
    before = facts_of(lake)
    merge, delete = SnapshotTable.merge, SnapshotTable.delete

    def broken(method):
        def run(self, *args, **kwargs):
            if self is getattr(lake, failing):
                raise RuntimeError("lost")
            return method(self, *args, **kwargs)

        return run

    batch = activities(activity(1), activity(3))
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "merge", broken(merge))
        with pytest.raises(RuntimeError):
            contribute(lake, batch, "live", 0, PARAMETERS)
    for _ in range(2):
        contribute(lake, batch, "live", 0, PARAMETERS)
        assert rows(lake.eligibility.read(), "id_salarie", "nombre_activites_total") == [(1, 2), (2, 1), (3, 1)]
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "merge", broken(merge))
        patch.setattr(SnapshotTable, "delete", broken(delete))
        with pytest.raises(RuntimeError):
            withdraw(lake, "live", PARAMETERS)
    withdraw(lake, "live", PARAMETERS)
    assert facts_of(lake) == before


def test_reset_of_a_lake_with_stream_and_history(lake, activities, spark, tmp_path):
    contribute_history(lake, activities(*[activity(1, jour="2025-01-01")] * 2, activity(2, WALK, "2025-01-01")), PARAMETERS)
    history = facts_of(lake)
    assert [(r[0], r[4], r[6]) for r in history[0]] == [(1, 5.0, "INITIAL_LOAD_BIS"), (2, 2.5, "INITIAL_LOAD_BIS")]
    drop_batch(activities(activity(1), activity(7)), f"{tmp_path}/in", "a")
    stream = stream_files(spark, f"{tmp_path}/in/*.parquet", activities(activity()).schema)
    stream_contributions(stream, f"{tmp_path}/checkpoint", lake, PARAMETERS, bounded=True).awaitTermination()
    streamed = facts_of(lake)
    drop_batch(activities(activity(1), activity(2, jour="2025-06-01"), activity(8)), lake.drops, "live")
    loads.load_live(lake, PARAMETERS)
    loaded = facts_of(lake)
    assert len(loaded[0]) == 6
    loads.reset_live(lake, PARAMETERS)
    assert facts_of(lake) == streamed
    loads.load_live(lake, PARAMETERS)
    assert facts_of(lake) == loaded
    # A new history replaces the old one and leaves what the others added.
    contribute_history(lake, activities(activity(5, jour="2025-01-01")), PARAMETERS)
    people = {r[0] for r in facts_of(lake)[1]}
    assert people == {1, 2, 5, 7, 8}


def test_reset_is_refused_where_other_origins_would_be_lost(lake, activities):
    drop_batch(activities(activity()), lake.drops, "a")
    loads.load_live(lake)
    lake.eligibility.merge(op.eligibility(activities(activity(7))), unique_source=True, stream="stream-x", batch=0)
    with pytest.raises(ValueError, match="stream-x"):
        loads.reset_live(lake)
    assert lake.eligibility.read().count() == 2


def test_rows_that_belong_to_no_year_add_nothing(lake, activities):
    contribute(lake, activities(activity(jour="abc"), activity(None)), "a", 0, PARAMETERS)
    assert facts_of(lake) == ([], [])
    assert contributions.op.contributions(activities(), "a").collect() == []
