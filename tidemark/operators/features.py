"""Table features: row tracking and change feed, as properties of the table's log."""

from __future__ import annotations

from tidemark.sources.store import ArchiveTable

ROW_TRACKING = "tidemark.enableRowTracking"
CHANGE_FEED = "tidemark.enableChangeDataFeed"
FEATURES = (ROW_TRACKING, CHANGE_FEED)


def _true(value: str | None) -> bool:
    return (value or "").strip().lower() == "true"


def row_tracking_enabled(properties: dict[str, str]) -> bool:
    return _true(properties.get(ROW_TRACKING))


def missing_features(properties: dict[str, str]) -> dict[str, str]:
    """The features that aren't on, as the properties that turn them on, in order of name."""
    return {name: "true" for name in sorted(FEATURES) if not _true(properties.get(name))}


def ensure_features(table: ArchiveTable, name: str) -> dict:
    """Turns on what isn't on, in one commit of the log; no commit if nothing is missing. Data files stay untouched."""
    missing = missing_features(table.snapshot().properties)
    if missing:
        table.set_properties(missing)
    return {"table": name, "status": "enabled" if missing else "present", "set": sorted(missing)}
