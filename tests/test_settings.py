import pytest

from docspark.settings import shared_dir


class Session:
    """Just the settings of a session."""

    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_the_sessions_folder_is_used():
    one, two = (shared_dir(Session(spark_checkpoint_dir="s3://b/x/")) for _ in range(2))
    assert one.startswith("s3://b/x/docspark-") and one != two


def test_a_local_session_may_use_a_temporary_folder():
    one, two = (shared_dir(Session(spark_master="local[4]")) for _ in range(2))
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(spark_master="yarn"))
