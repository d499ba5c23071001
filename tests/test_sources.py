import pytest

from lotflow import session
from lotflow.sources import tables
from lotflow.sources.schemas import WORK


def test_a_rerun_of_a_day_replaces_it_and_earlier_days_are_the_log(spark, rows, tmp_path):
    path = str(tmp_path / "snap")
    day = lambda v: spark.createDataFrame([(v,)], "v string")
    for run_date, value in (("20200101", "a"), ("20200102", "b"), ("20200102", "c"), ("20200103", "d")):
        tables.write_snapshot(day(value), path, run_date)
    assert rows(tables.current_snapshot(spark, path, "20200103")) == [("d",)]
    assert rows(tables.snapshot_log(spark, path, "20200103")) == [("a", "20200101"), ("c", "20200102")]


def test_append_new_takes_null_as_a_key_and_leaves_stored_ones(spark, rows):
    stored = spark.createDataFrame([("a", "1"), ("a", "1"), (None, "2")], "k string, l string")
    new = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), (None, "2", 3), (None, "3", 4)], "k string, l string, v int")
    assert rows(tables.append_new(stored, new, ["k", "l"]), "k", "l", "v") == [("a", "2", 2), (None, "3", 4)]


def test_a_missing_work_table_is_empty(spark, tmp_path):
    empty = tables.read_work(spark, str(tmp_path), "mch1x")
    assert empty.isEmpty() and empty.schema == spark.createDataFrame([], WORK["mch1x"]).schema


def test_erp_tables_come_with_their_client_only(spark, table, rows, tmp_path):
    table("lfa1", dict(lifnr="1"), dict(lifnr="2", mandt="999")).write.parquet(f"{tmp_path}/lfa1")
    assert rows(tables.read_erp(spark, str(tmp_path), "lfa1"), "lifnr") == [("1",)]


class _Session:
    """A session on a cluster, as far as the scratch folder goes."""

    def __init__(self, folder):
        self.conf = self
        self.sparkContext = self
        self.master, self.applicationId, self._folder = "spark://host:7077", "app-1", folder

    def get(self, key, default=None):
        return self._folder if key == "spark.checkpoint.dir" and self._folder else default


def test_scratch_is_the_shared_folder_of_the_session():
    shared = _Session("hdfs://nn/shared/")
    assert session.scratch_dir(shared) == "hdfs://nn/shared"
    paths = {session.scratch_path(shared, "t") for _ in range(2)}
    assert len(paths) == 2 and all(p.startswith("hdfs://nn/shared/lotflow/app-1/t-") for p in paths)


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.scratch_dir(_Session(None))


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(3).selectExpr("id", "cast(id as decimal(13,3)) q", "cast(null as string) s")
    kept = session.materialize(df, "numbers")
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert sorted(r["id"] for r in kept.collect()) == [0, 1, 2]


def test_a_local_folder_is_refused_on_a_cluster():
    for path in ("/tmp/x", "file:///tmp/x", "file:/tmp"):
        with pytest.raises(RuntimeError):
            session.scratch_dir(_Session(path))


def test_tables_published_together_stay_a_pair_if_a_write_fails(spark, tmp_path):
    path = str(tmp_path)
    order = lambda n: spark.createDataFrame([(n, "X")], "aufnr string, xstat string")
    row = lambda n: spark.createDataFrame([(n,)], "aufnr string")
    order("0").write.parquet(f"{path}/aufkx")
    current = lambda: [[r.aufnr for r in tables.read_work(spark, path, t).collect()] for t in ("aufmx", "aufkx")]
    assert current() == [[], ["0"]]
    tables.publish(spark, path, {"aufmx": row("1"), "aufkx": order("1")})
    assert current() == [["1"], ["1"]]

    class Failing:
        @property
        def write(self):
            raise OSError("lost")

    with pytest.raises(OSError):
        tables.publish(spark, path, {"aufmx": row("2"), "aufkx": Failing()})
    assert current() == [["1"], ["1"]]
    tables.publish(spark, path, {"aufmx": row("3"), "aufkx": tables.read_work(spark, path, "aufkx")})
    assert current() == [["3"], ["1"]]
