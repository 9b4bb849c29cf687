"""Where intermediate tables may lie."""

import pytest

from kerbside import session


class Session:
    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_a_cluster_must_name_its_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(Session(master))
        assert session.shared_folder(Session(master, **{"spark.checkpoint.dir": "s3://x"})) == "s3://x"


def test_a_local_session_gets_a_folder_of_its_own():
    for master in ("local", "local[*]", "local[8]", "local[4,2]"):
        own = Session(master)
        assert session.shared_folder(own) == session.shared_folder(own) == own.settings["spark.checkpoint.dir"]
