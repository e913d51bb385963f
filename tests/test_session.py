import pytest

from commutewell import session


def test_work_folders_lie_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.work_dir(spark, "x").startswith(f"{base}/x-")
    assert session.work_dir(spark, "x") != session.work_dir(spark, "x")


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(session, "_one_machine", lambda _: False)
    assert session.work_dir(spark, "x").startswith(base)

    class Unset:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            class getConf:
                def get(self, _):
                    return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Unset, "x")


@pytest.mark.parametrize(("master", "one"), [("local", True), ("local[8]", True), ("local[*]", True), ("local-cluster[3,2,1024]", False), ("yarn", False)])
def test_one_machine(master, one):
    class Fake:
        class sparkContext:
            pass

    Fake.sparkContext.master = master
    assert session._one_machine(Fake) is one


def test_a_configured_number_of_partitions_is_kept(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.build_session("again", conf={"spark.sql.shuffle.partitions": "200"}).conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
