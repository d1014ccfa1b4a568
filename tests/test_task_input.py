"""What one task of the warehouse models gets stays bounded, whatever the session was given."""
import pytest

from tidemart.plans.registry import queries, warehouse
from tidemart.session import TASK_INPUT

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def sizes(spark):
    before = {k: spark.conf.get(k) for k in TASK_INPUT}
    yield lambda size: [spark.conf.set(k, size) for k in TASK_INPUT]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("query", [lambda s: warehouse(s, SF), lambda s: queries()["mart_sales"](s, SF),
                                   lambda s: queries()["zoned_events"](s, SF)])
def test_large_sizes_are_lowered(spark, sizes, query):
    for given in ("128MB", "1g", "134217728b"):
        sizes(given)
        query(spark)
        assert {k: spark.conf.get(k) for k in TASK_INPUT} == {k: str(v) for k, v in TASK_INPUT.items()}


def test_smaller_sizes_are_kept(spark, sizes):
    for given in ("1m", "16k", "4096"):
        sizes(given)
        queries()["mart_sales"](spark, SF)
        assert {spark.conf.get(k) for k in TASK_INPUT} == {given}
