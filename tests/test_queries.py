"""Run registered queries beside their SQL twins.

By default a selection from every group runs; ``TABLOOM_QUERIES=all`` runs all.
"""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import DATA

from tabloom.catalog import oracle_sql, queries
from tabloom.catalog.base import TABLES

QUERIES, SQL = queries(), oracle_sql()
SELECTED = [
    "s01_load_csv", "s05_train_test_files", "s08_sample_with_replacement", "p04_drop_null_columns", "p08_drop_null_rows", "p16_recode",
    "j01_lookup_salted", "j04_complement", "j06_nearest_manhattan", "a03_distinct_counts", "a04_describe_bracketed", "a08_correlation_wide",
    "a10_count_outliers", "a11_histogram_auto", "a18_redundant_mutual", "a22_segment_means", "w02_difference_by_series", "w05_running_count",
    "f03_us_timestamp", "f08_long_slot", "g01_variable_types", "g06_sparsity_pairs", "c01_clean_flights_style", "e02_place_codes",
    "e07_cyclic_two_step", "i02_fill_frequent", "i04_impute_by_neighbors", "o03_truncate", "n03_scale_per_split", "b01_under_balance",
    "b03_synthetic_rows", "k02_stratified_split", "q04_confusion_matrix", "q06_roc_points", "t01_rebuild_timestamps", "t08_regular_grid",
    "t09_decompose_even", "m04_naive_bayes_study", "l02_flagship_preparation", "st3_stream_by_hour",
]
NAMES = sorted(SQL) if os.environ.get("TABLOOM_QUERIES") == "all" else SELECTED


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def cell(x):
    if x is None or x is pd.NaT or (isinstance(x, (float, np.floating)) and np.isnan(x)):
        return "null"
    if isinstance(x, (float, np.floating)):
        return repr(float(x) + 0.0)
    if hasattr(x, "isoformat"):
        return str(pd.Timestamp(x))
    return str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(cell(x) for x in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), db.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) > 170
