"""The tables that queries make of the driver's."""

import pytest

from workload import fixtures


@pytest.mark.parametrize("pages", [fixtures.nested_pages, fixtures.customer_pages])
def test_pages_of_one_small_file_are_spread_over_tasks(spark, tmp_path, monkeypatch, pages):
    monkeypatch.setattr(fixtures, "PAGES_PER_TASK", 4)
    rows = [(i if i % 10 else None, f"Customer {i}", i % 3, 1.0, "S") for i in range(30)]
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    customers = spark.createDataFrame(rows, schema).coalesce(1)
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    made = pages(spark, str(tmp_path)).rdd.glom().map(len).collect()
    assert len(made) == 8 and sum(made) == 30 and max(made) <= 5


def test_no_customers_no_pages(spark, tmp_path):
    customers = spark.createDataFrame([], "c_custkey long, c_name string, c_nationkey int")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    assert fixtures.nested_pages(spark, str(tmp_path)).count() == 0
