import pytest

from doclattice.session import drop_materialized, materialize, shared_dir


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, name, default=None):
        return self.value if name == "spark.checkpoint.dir" and self.value else default


class Session:
    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = Conf(folder), type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_a_cluster_needs_a_shared_folder():
    assert shared_dir(Session("spark://h:7077", "hdfs://shared/x/")) == "hdfs://shared/x"
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(master))
    assert shared_dir(Session("local[2]")).startswith("file://") and shared_dir(Session("local[2]")) == shared_dir(Session("local[2]"))


def test_written_tables(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    for small in (False, True):
        written = materialize(spark.range(100).groupBy("id").count(), "test", small)
        assert written.count() == 100 and spark.conf.get(name) == before
        drop_materialized(written)
    assert materialize(spark.range(0), "test").count() == 0
