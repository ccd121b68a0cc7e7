"""Typed errors raised instead of ending the process."""


class EmptyDayError(RuntimeError):
    """The requested report day has no rows."""


class OverlappingRangesError(ValueError):
    """A range dictionary has overlapping or malformed ranges."""


class DuplicateKeyError(ValueError):
    """A batch for a keyed upsert holds two rows of one key."""
