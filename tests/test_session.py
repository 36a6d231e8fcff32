"""Shared scratch folder and session helpers."""

from tidewater.session import SCALE_CONF, pin_utc, shared_root, unique_name, workspace


def test_workspace_lives_under_the_checkpoint_dir_and_is_unique(spark):
    root = shared_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = workspace(spark, "x"), workspace(spark, "x")
    assert a != b and a.startswith(root + "/tidewater/x-") and b.startswith(root + "/tidewater/x-")
    assert unique_name("t") != unique_name("t")


def test_pin_utc_and_scale_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert SCALE_CONF["spark.sql.adaptive.enabled"] == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


class _Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    """A session whose shared folder is unset."""

    def __init__(self, master):
        self.conf = _Conf(**{"spark.master": master})

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(_Session(master))
    assert "tidewater-ckpt-" in shared_root(_Session("local[2]"))


def test_hive_builder_settings(monkeypatch):
    """What the Hive-enabled session asks for, without a metastore."""
    from pyspark.sql import SparkSession
    from tidewater.session import build_session

    seen = {}
    monkeypatch.setattr(SparkSession.Builder, "getOrCreate", lambda self: seen.update(self._options))
    monkeypatch.setattr(SparkSession.Builder, "_options", {}, raising=False)
    build_session(app="a", hive=True, metastore_uri="thrift://m:9083", largest_shuffle_bytes=10 * 2**40)
    assert seen["spark.sql.catalogImplementation"] == "hive"
    assert seen["spark.hadoop.hive.metastore.uris"] == "thrift://m:9083"
    assert seen["spark.sql.shuffle.partitions"] == str(10 * 2**40 // (128 * 2**20))


def test_package_zip_holds_the_package():
    import zipfile

    from tidewater.session import package_zip

    names = zipfile.ZipFile(package_zip()).namelist()
    assert "tidewater/__init__.py" in names and "tidewater/functions/codec.py" in names
