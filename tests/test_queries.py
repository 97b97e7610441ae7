"""Every registered query against its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as driver
from brookmart.registry.batch import BATCH
from brookmart.registry.oracles import ORACLES, STREAM_ORACLES
from brookmart.registry.streams import STREAMS
from tests.check import compare, connect

SF = "/root/testdata/sf0.001"
OWN = {**BATCH, **STREAMS}


@pytest.fixture(scope="module")
def con():
    c = connect(SF)
    yield c
    c.close()


def test_every_query_has_sql():
    assert set(OWN) <= set(driver.queries())
    assert set(OWN) == {*ORACLES, *STREAM_ORACLES} <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(OWN))
def test_query(spark, con, name):
    assert compare(spark, con, SF, driver.queries()[name], driver.oracle_sql()[name]) == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["stt", "edt", "home_uv_ct", "good_detail_uv_ct"]
    assert df.count() > 0
