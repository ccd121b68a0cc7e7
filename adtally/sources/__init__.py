"""Scans: the raw JSON log and one day of the enriched table."""

from adtally.sources.day import read_day, require_rows
from adtally.sources.json_log import BROKEN, broken_lines, is_broken, read_ad_log, read_split_log, sound_rows

__all__ = ["BROKEN", "broken_lines", "is_broken", "read_ad_log", "read_day", "read_split_log", "require_rows", "sound_rows"]
