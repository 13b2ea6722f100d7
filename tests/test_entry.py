import __spark_entry__ as E
from lettermon.plans.catalog import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["property", "pilot", "extraction_date", "text_delivery_result",
                          "text_delivery_result_more", "cpd_ranges",
                          "days_exa_assignment_group", "days_after_gen", "amt_payment",
                          "due_amount", "cnt_client", "cnt_case"]
    assert df.count() == 1210


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
