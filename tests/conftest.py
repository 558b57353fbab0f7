from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from torque.session import get_session
    s = get_session("local[4]", app="torque-tests", shuffle_partitions=4,
                    checkpoint_dir=tempfile.mkdtemp(prefix="torque-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def dirty(spark):
    from tests.fixtures import dirty_sources
    return dirty_sources(spark)


@pytest.fixture(scope="session")
def clean(spark):
    from tests.fixtures import clean_sources
    return clean_sources(spark)


@pytest.fixture(scope="session")
def cfg():
    from tests.fixtures import fixture_config
    return fixture_config()


@pytest.fixture(scope="session")
def gold(spark, clean, cfg):
    from torque.plans.warehouse import build_silver, load_gold
    return load_gold(spark, build_silver(clean), cfg)


@pytest.fixture()
def store(spark):
    from torque.sources.sinks import SnapshotStore
    return SnapshotStore(spark, tempfile.mkdtemp(prefix="torque-test-wh-"))


D = dt.date
