"""Every registered query against its SQL twin on the smallest tables that give it rows."""

import pytest

import __spark_entry__ as entry
from nightshare.registry import QUERIES, SQL  # the training-data queries have tests of their own
from parity import compare

FOLDER, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Queries whose thresholds leave no row of the smallest tables.
NEED_MORE = {
    "an08_compare_zones",
    "an09_peer_gap_by_zone",
    "an10_host_segments",
    "an12_price_index",
    "an21_hotel_event_uplift",
    "an23_diff_in_diff",
    "an24_did_noise",
    "an25_event_price_range",
    "an36_zone_revpar",
    "ms07_reliability_label",
    "ms08_occupancy_margin",
    "ms09_reliable_adr",
    "ms10_reliable_revpar",
    "ms11_sort_key",
    "ms12_visible_listings",
    "ms13_visible_occupancy",
    "ms14_winter_drop",
    "ms15_listing_change",
    "report_scatter",
    "report_winter_drop_filtered",
    "report_winter_drop_listing_change",
    "report_zone_ranking",
    "srt03_reliability_sort_key",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    status, _, _, note = compare(spark, LARGER if name in NEED_MORE else FOLDER, name, QUERIES[name], SQL.get(name))
    assert status in ("ok", "rows-only"), (status, note)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
