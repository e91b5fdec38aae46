import pytest

from tillwise.session import cluster_settings
from tillwise.sources import staging


def test_partitions_grow_with_the_input():
    def partitions(size):
        return int(cluster_settings(size)["spark.sql.shuffle.partitions"])

    assert partitions(0) == 200
    assert partitions(1 << 40) == 4096
    assert partitions(100 << 40) == 409_600


class Session:
    """Just enough of a session to choose a folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})
        values = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/warehouse"}
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: values.get(name) or default)})


def test_the_configured_folder_is_used():
    assert staging.shared_folder(Session("yarn", "s3://shared/checkpoints")) == "s3://shared/checkpoints"


def test_a_local_session_may_use_its_warehouse():
    assert staging.shared_folder(Session("local[4]")) == "file:/warehouse/_staged"


def test_a_cluster_needs_a_configured_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session("yarn"))


def test_a_staged_table_keeps_its_rows(spark):
    assert staging.stage(spark.range(10), "numbers").count() == 10


def test_staged_tables_go_with_the_application(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    script = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
from tillwise.sources.staging import stage
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
staged = stage(spark.range(5), "numbers")
assert staged.count() == 5 and staged.inputFiles()[0].startswith("file://{tmp_path}")
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=120)
    assert list(Path(tmp_path, "tillwise").iterdir()) == []
