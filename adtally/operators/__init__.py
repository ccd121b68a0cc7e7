"""Relational operators of the ad report, as DataFrame plans."""

from adtally.operators.distribution import finish_distribution, region_distribution, region_top
from adtally.operators.enrich import dictionary_from_regions, enrich_ips
from adtally.operators.kpi import DIMENSIONS, finish_kpi, kpi_counts, kpi_report
from adtally.operators.map_feed import map_feed
from adtally.operators.nested_ranges import disjoint_ranges
from adtally.operators.range_join import DictionaryStats, dictionary_stats, range_lookup
from adtally.operators.topn import top_n_by_measure, top_n_by_total, top_n_per_measure

__all__ = [
    "DIMENSIONS",
    "DictionaryStats",
    "dictionary_from_regions",
    "dictionary_stats",
    "disjoint_ranges",
    "enrich_ips",
    "finish_distribution",
    "finish_kpi",
    "kpi_counts",
    "kpi_report",
    "map_feed",
    "range_lookup",
    "region_distribution",
    "region_top",
    "top_n_by_measure",
    "top_n_by_total",
    "top_n_per_measure",
]
