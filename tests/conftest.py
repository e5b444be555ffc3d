from __future__ import annotations

import gzip
import pathlib
import shutil
import sys

import pytest

ROOT = pathlib.Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))

from litscope.functions.text import Analysis  # noqa: E402
from litscope.plans.search import Library  # noqa: E402
from litscope.session import get_spark  # noqa: E402
from litscope.sources.records import read_dump  # noqa: E402
from litscope.sources.store import build_index  # noqa: E402

DUMP = str(ROOT / "tests" / "fixtures" / "records.xml")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def dump():
    return DUMP


@pytest.fixture(scope="session")
def zipped(tmp_path_factory):
    path = tmp_path_factory.mktemp("zip") / "records.xml.gz"
    with open(DUMP, "rb") as plain, gzip.open(path, "wb") as packed:
        shutil.copyfileobj(plain, packed)
    return str(path)


@pytest.fixture(scope="session")
def records(spark, dump):
    corpus, quarantine = read_dump(spark, dump)
    return corpus.cache(), quarantine.cache()


@pytest.fixture(scope="session")
def library(spark, records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "index")
    return Library(build_index(records[0], path, buckets=4, analysis=Analysis()))
