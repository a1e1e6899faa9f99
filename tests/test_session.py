from types import SimpleNamespace

from vitals import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value


def fake(master, cores, **conf):
    context = SimpleNamespace(master=master, defaultParallelism=cores)
    return SimpleNamespace(conf=Conf(conf), sparkContext=context)


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE = {"spark.sql.shuffle.partitions": "200"}


def test_shuffles_follow_the_input_on_every_master():
    for master in ("yarn", "local[8]"):
        spark = fake(master, 8, **SHUFFLE)
        assert session.size_shuffles(spark, 100 << 40) == 819_200
        assert spark.conf[INITIAL] == "819200"
        # The next job of the session is sized by its own input.
        assert session.size_shuffles(spark, 1 << 20) == 200


def test_a_number_set_by_the_user_stays():
    spark = fake("yarn", 8, **SHUFFLE, **{INITIAL: "50000"})
    assert session.size_shuffles(spark, 100 << 40) == 50_000
    assert spark.conf[INITIAL] == "50000"


def test_results_of_queries_go_to_the_shared_folder():
    named = fake("yarn", 8, **{"spark.checkpoint.dir": "hdfs:///checkpoints/"})
    assert session.scratch_root(named) == "hdfs:///checkpoints"
    assert session.scratch_root(fake("local[2]", 2, **{"spark.sql.warehouse.dir": "/w"})) == "/w"
