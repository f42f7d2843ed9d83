"""Session sizing: local sessions keep their settings; clusters start shuffles wide."""

from types import SimpleNamespace

from hearth.session import MIN_INITIAL_SHUFFLE_PARTITIONS, size_shuffles


class _Conf:
    def __init__(self, submitted=None):
        self.values = dict(submitted or {})

    def contains(self, key):
        return key in self.values

    def set(self, key, value):
        self.values[key] = value


def _cluster(submitted=None, cores=2000):
    submitted_conf = _Conf(submitted)
    runtime = _Conf()
    sc = SimpleNamespace(master="yarn", defaultParallelism=cores, getConf=lambda: submitted_conf)
    return SimpleNamespace(sparkContext=sc, conf=runtime), runtime


def test_local_session_unchanged(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    size_shuffles(spark)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == before
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_cluster_starts_wide_and_coalesces_by_size():
    s, runtime = _cluster(cores=4000)
    size_shuffles(s)
    assert runtime.values["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "16000"
    assert runtime.values["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    s, runtime = _cluster(cores=8)
    size_shuffles(s)
    assert runtime.values["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == \
        str(MIN_INITIAL_SHUFFLE_PARTITIONS)


def test_cluster_keeps_submitted_settings():
    s, runtime = _cluster({"spark.sql.shuffle.partitions": "50000",
                           "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"})
    size_shuffles(s)
    assert runtime.values == {}
