"""Every named query against DuckDB, and the ordered ones again with every key sliced."""

import pytest

from conftest import SF
from oracle import compare, connect
from tickloom.core import HOUR, Series
from tickloom.plans import ORACLE, QUERIES

SLICED = [
    "agg_tick_buckets", "agg_flexible_buckets", "agg_state_series", "running_cumulative", "running_num_distinct",
    "sliding_arrival_and_exit", "sliding_exit", "sliding_min_max", "sliding_recovers", "running_moments", "sliding_moments", "sliding_ticks",
    "sliding_num_distinct", "sliding_num_distinct_ticks", "join_with_query_window", "join_with_query_window_extremes", "lag_lead", "fill_forward", "transpose_rows", "row_slice", "tw_average", "tw_average_ticks",
    "tw_average_ticks_groups", "exp_tw_average_flexible",
    "return_ep", "join_same_size", "join_by_time_default", "join_by_time_latest_ticks", "join_by_time_each_for_leader",
    "aggregated_window_time", "aggregated_window_ticks", "point_in_time_ticks", "coalesce_feeds", "diff_series",
    "lee_and_ready", "corp_actions", "ob_snapshot_clear", "ob_snapshot_uncrossed", "ob_snapshot_ticks", "ob_snapshot_entries", "pnl_realized", "recipe_participation_price", "update_timestamp",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", SLICED)
def test_every_key_sliced(spark, con, name, monkeypatch):
    def slice_all(self, rows_per_task=0):
        return self.using(self.df, slice_us=31 * HOUR, hot=None)

    monkeypatch.setattr(Series, "balanced", slice_all)
    assert compare(spark, con, SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", ["running_cumulative", "lag_lead", "join_by_time_default", "coalesce_feeds"])
def test_only_large_keys_sliced(spark, con, name, monkeypatch):
    balanced = Series.balanced
    monkeypatch.setattr(Series, "balanced", lambda self: balanced(self, 15))
    assert compare(spark, con, SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", ["skip_bad_tick", "option_price", "option_price_tree", "math_random"])
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0
