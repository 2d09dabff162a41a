"""Run parameters and which tables they cover."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Source tables are named system.<schema>.<table>.
PREFIX = "system."
ALL = "all"


def full_name(name: str) -> str:
    return name if name.startswith(PREFIX) else PREFIX + name


def parse_excludes(text: str | None) -> frozenset[str]:
    """A comma-separated list; blanks are dropped, names get the prefix if they lack it."""
    return frozenset(full_name(n.strip()) for n in (text or "").split(",") if n.strip())


@dataclass(frozen=True)
class EngineConfig:
    """root: where archive tables stand. tables_to_process: "all", or full names with prefix, comma-separated. request_key: the
    column that tells the requests of serving.endpoint_usage apart; without it that table fails."""

    root: str
    tables_to_process: str = ALL
    exclude_tables: str = ""
    watermark_buffer_hours: int = 4
    stale_threshold_hours: int = 48
    request_key: str | None = None
    excludes: frozenset[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "excludes", parse_excludes(self.exclude_tables))

    def should_process(self, name: str) -> bool:
        """An exclusion wins over the list of tables."""
        if full_name(name) in self.excludes:
            return False
        wanted = self.tables_to_process.strip()
        return wanted == ALL or name in {n.strip() for n in wanted.split(",")}
