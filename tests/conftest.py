import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from contraluz.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, app="contraluz-tests", memory="4g", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """values(column_of_x, 'a', 'b') evaluates an expression over texts."""
    def run(expression, *inputs, kind="string"):
        rows = spark.createDataFrame(
            [(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        found = rows.select("i", expression.alias("v")).orderBy("i").collect()
        return [r["v"] for r in found]
    return run
