import pytest

from ledgerwake.llm.ship import ship
from ledgerwake.sources.scratch import SETTING
from tests.llm import cases


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Written, so that a scan of it is stable."""
    path = str(tmp_path_factory.mktemp("corpus") / "docs")
    cases.corpus(spark).repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return cases.none(spark)


@pytest.fixture(scope="session", autouse=True)
def scratch(spark, tmp_path_factory):
    if spark.conf.get(SETTING, None) is None:
        spark.conf.set(SETTING, str(tmp_path_factory.mktemp("scratch")))
