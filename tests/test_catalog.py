import compare
import pytest

from sonde.plans import catalog, pages  # noqa: F401, pages adds its queries to the catalogue

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    compare.same(spark, catalog.queries()[name], catalog.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_stream_equals_batch(spark):
    """Windows still open at the end count too."""
    stream, batch = (catalog.queries()[q](spark, SF).select("minute", "event_type", "requests", "tokens") for q in ("q48_usage_stream", "q40_usage_rollup"))
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
