import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shoprec.session import builder, use_checkpoints  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    use_checkpoints(session)
    return session


@pytest.fixture
def ratings(spark):
    def make(*rows):
        full = [(*r, 0)[:4] if len(r) == 3 else r for r in rows]
        return spark.createDataFrame(full, "userId int, productId int, score double, timestamp bigint")

    return make
