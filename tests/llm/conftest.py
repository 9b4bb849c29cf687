import pytest


@pytest.fixture(autouse=True, scope="session")
def shared_folder_of_tests(spark, tmp_path_factory):
    """Tests run on one machine, so its temporary folder is shared by all tasks."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
