import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from commutewell.contract import ACTIVITY
from commutewell.session import build_session

BIKE = "Vélo/Trottinette/Autres"
WALK = "Marche/running"
BUS = "Transports en commun"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("work")
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.driver.memory": "4g",
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",  # many short plans: start-up beats peak speed
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def activity(id_salarie=1, moyen=BIKE, jour="2026-03-02 08:00:00", sport="Tennis", salaire=30000.0, **more):
    """One activity record; unnamed fields are NULL."""
    row = dict.fromkeys(ACTIVITY.names)
    row |= {
        "id_salarie": id_salarie,
        "nom": "Durand",
        "prenom": "Lou",
        "salaire_brut": salaire,
        "moyen_de_deplacement": moyen,
        "date_activite": jour,
        "type_sport": sport,
    }
    return row | more


def nullable(schema):
    """``schema`` without its NOT NULL marks, to build bad rows with."""
    import copy

    schema = copy.deepcopy(schema)
    for field in schema.fields:
        field.nullable = True
    return schema


@pytest.fixture
def activities(spark):
    def build(*rows):
        return spark.createDataFrame([tuple(r[n] for n in ACTIVITY.names) for r in rows], nullable(ACTIVITY))

    return build


def rows(df, *columns):
    """Rows of ``df`` as a sorted list of tuples."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=repr)
