"""Every registered query against its SQL, and the registry against the inventory."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from checks import ORACLES, QUERIES

INVENTORY = """
src_csv_strings src_csv_inferred src_parquet_scan stream_land_orders json_decode_events json_encode_orders
stream_land_json sink_star_roundtrip load_full_refresh
proj_tolerant proj_standardize star_customer star_product star_location star_order star_shipping star_department
star_metadata proj_safe_cast proj_arith
dedup_by_key stg_customer stg_department stg_location stg_order stg_product stg_shipping stg_metadata
dedup_report dedup_flag stream_dedup
join_month_lookup join_two_key join_dim_department join_dim_product join_cross_scalar
agg_count agg_sum_monthly agg_avg_customer agg_count_distinct agg_conditional agg_sum_product agg_ratio agg_global
agg_age_bucket agg_composite_key
win_running_total win_lag
limit_cap_ordered profile_top_values limit_head profile_missing topk_customers
calendar_months union_by_name
fn_parse_timestamp fn_extract fn_date_trunc fn_timestamp_diff fn_round fn_safe_divide fn_case_bucket fn_batch_tag
stream_replay stream_batch_metrics stream_clean_stamp
profile_shape profile_types profile_numeric profile_distinct profile_missing_total profile_quality_summary
profile_dictionary profile_duplicates
mart_customer_retention_rate mart_financial_commitments mart_fraud_detection mart_inventory_levels
mart_overall_performance mart_payment_delays
dq_not_null dq_unique dq_castable dq_recency dq_row_counts dq_schema_contract
doc_delay_histogram doc_performance_by_region doc_monthly_trend doc_lead_time doc_bottleneck doc_open_commitments
doc_nested_extract doc_incremental_filter src_json_table
dedup_flag_copies profile_quantiles_extreme profile_numeric_without_numbers profile_distinct_without_text
agg_sum_small agg_sum_product_fractional limit_cap_staged limit_cap_text_key
batch_customer_retention_rate batch_financial_commitments batch_fraud_detection batch_inventory_levels
batch_overall_performance batch_payment_delays batch_incremental
batch_months batch_months_retention batch_months_commitments batch_months_inventory batch_months_delays
agg_count_distinct_sketch batch_snapshot src_skipping_scan dq_quarantine dq_rule_report limit_cap_hot_key
stream_observed_metrics
""".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_inventory_query_is_registered_with_sql():
    assert set(QUERIES) == set(ORACLES) == set(INVENTORY)
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, queries()[name], oracle_sql()[name]) is None


def test_entry_returns_the_retention_mart(spark):
    assert entry(spark).columns == [
        "year", "month_name", "distinct_customers", "cumulative_customers", "customer_retention_rate",
    ]
