import pytest

from tallywork import session


class Conf:
    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": staticmethod(lambda: None)})
        self.conf = type("Settings", (), {"get": staticmethod(lambda key, default=None: folder or default)})


def test_named_folder_is_used():
    assert session.shared_folder(Conf("spark://x", "s3a://bucket/dir/")) == "s3a://bucket/dir"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(Conf("yarn"))


def test_a_local_folder_is_refused_on_a_cluster():
    with pytest.raises(RuntimeError, match="local folder"):
        session.shared_folder(Conf("spark://x", "file:///tmp/x"))
    assert session.shared_folder(Conf("local-cluster[2,1,1024]", "file:///tmp/x")) == "file:///tmp/x"


class Cluster(Conf):
    """A running session that says its master is not local, with one setting."""

    def __init__(self, spark, key, folder):
        super().__init__("spark://x")
        own, self.range, self.read = spark.sparkContext, spark.range, spark.read
        self.conf = type("Settings", (), {"get": staticmethod(lambda k, default=None: folder if k == key else default)})
        for name in ("applicationId", "defaultParallelism", "_jsc"):
            setattr(self.sparkContext, name, getattr(own, name))


@pytest.fixture
def unproven(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    monkeypatch.setattr(session, "_proven", set())
    yield spark
    session.drop_scratch(spark)


@pytest.mark.parametrize("key", ["spark.checkpoint.dir", "spark.sql.warehouse.dir"])
def test_a_mounted_folder_that_executors_share_is_used(unproven, tmp_path, monkeypatch, key):
    for folder in (tmp_path.as_uri(), str(tmp_path)):
        assert session.shared_folder(Cluster(unproven, key, folder + "/")) == folder
    monkeypatch.setattr(session, "_rows_back", None)  # not asked again
    assert session.shared_folder(Cluster(unproven, key, str(tmp_path))) == str(tmp_path)


def test_a_local_folder_that_loses_rows_is_refused(unproven, tmp_path, monkeypatch):
    (tmp_path / "file").touch()  # cannot be written to
    with pytest.raises(RuntimeError, match="local folder"):
        session.shared_folder(Cluster(unproven, "spark.checkpoint.dir", str(tmp_path / "file")))
    monkeypatch.setattr(session, "_rows_back", lambda spark, path, rows: rows - 1)
    with pytest.raises(RuntimeError, match="local folder"):
        session.shared_folder(Cluster(unproven, "spark.checkpoint.dir", str(tmp_path)))


def test_executors_on_the_drivers_host_get_the_warehouse_and_no_temporary_folder():
    conf = Conf("local-cluster[2,1,1024]")
    conf.conf = type("Settings", (), {"get": staticmethod(lambda k, default=None: {"spark.sql.warehouse.dir": "file:/w/"}.get(k, default))})
    assert session.shared_folder(conf) == "file:/w"
    with pytest.raises(RuntimeError, match="executors share"):
        session.shared_folder(Conf("local-cluster[2,1,1024]"))


def test_the_folder_of_a_local_session_does_not_go_by_the_default_file_system():
    assert session.shared_folder(Conf("local[2]")).startswith("file:///")


def test_scratch_blocks_delete_their_own_tables(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    before = session.materialise(spark.range(3), "t")
    with session.scratch(spark):
        inside = session.materialise(spark.range(5), "t")
        assert inside.count() == 5
    assert before.count() == 3 and len(session._made) == 1
    with pytest.raises(Exception):
        inside.count()
    session.drop_scratch(spark)


def test_local_sessions_get_a_folder(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_materialised_tables_keep_their_schema(spark):
    empty = session.materialise(spark.range(0).selectExpr("id", "CAST(id AS STRING) AS s"), "t")
    assert empty.dtypes == [("id", "bigint"), ("s", "string")] and empty.count() == 0


def test_scratch_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    table = session.materialise(spark.range(5), "t")
    session.scratch_path(spark, "never-written")
    assert table.count() == 5
    assert session.drop_scratch(spark) == 1
    assert session._made == []


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {line for line in files.split("\n") if "/shuffle_" in line}


def test_shuffle_files_of_written_tables_go(spark):
    from tallywork.session import materialise

    before = shuffle_files(spark)
    counted = spark.range(1000).repartition(3).selectExpr("id % 7 AS k").groupBy("k").count()
    assert materialise(counted, "counted").count() == 7
    assert materialise(counted, "again").groupBy().sum("count").first()[0] == 1000
    written = {line.rsplit("/", 1)[1].split("_")[1] for line in shuffle_files(spark) - before}
    # Only the two readings above leave any.
    assert len(written) <= 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
