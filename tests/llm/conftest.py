import pytest


@pytest.fixture(autouse=True)
def scratch_folder(spark, tmp_path):
    """Tables between steps go to the test's own folder where the session names none."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path / "shared"))
        yield
        spark.conf.unset("spark.checkpoint.dir")
    else:
        yield
