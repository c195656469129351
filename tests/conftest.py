import datetime as dt

import pytest

from opinara.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", spark_sql_shuffle_partitions="4",
                            spark_ui_enabled="false", spark_driver_memory="4g",
                            spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
