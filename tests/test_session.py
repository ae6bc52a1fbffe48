import os

import pytest

from tidemark import session


class Conf(dict):
    pass


class Session:
    def __init__(self, master, folder=None):
        self.conf = Conf({"spark.checkpoint.dir": folder} if folder else {})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


@pytest.fixture
def no_own_root():
    before = session._own_root
    session.use_root(None)
    yield
    session.use_root(before)


def test_the_cluster_names_the_folder():
    path = session.shared_dir(Session("spark://x", "hdfs://shared/ck/"), "table")
    assert path.startswith("hdfs://shared/ck/tidemark/app-1/table-")


@pytest.mark.parametrize("master", ["spark://x", "local[2]"])
def test_a_folder_must_be_named(no_own_root, master):
    with pytest.raises(RuntimeError):
        session.shared_dir(Session(master), "table")
    session.use_root("/own")
    assert session.shared_dir(Session(master), "table").startswith("/own/tidemark/app-1/table-")
    assert session.shared_dir(Session(master, "/named"), "table").startswith("/named/")


def test_tables_can_be_removed(spark, tmp_path):
    child = spark.newSession()
    folder = str(tmp_path / "ck")
    child.conf.get = lambda key, default=None: folder if key == "spark.checkpoint.dir" else default
    path = session.shared_dir(child, "table")
    child.range(3).write.parquet(path)
    assert os.path.isdir(path)
    session.remove_tables(child)
    assert not os.path.exists(path)


def test_counting_stops_early(spark):
    assert session.fits(spark.range(5), 5) and not session.fits(spark.range(6), 5)
