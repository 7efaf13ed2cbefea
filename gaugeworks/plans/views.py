"""Reports and point-in-time operators as SQL views that follow their tables.

A temporary view keeps the files its frame had listed. `Views` therefore defines the views of a table anew whenever its store writes
that table; `refresh` does so for all of them, after writes of other sessions. Defining a view lists files and runs no job on rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from gaugeworks.plans import live, reports
from gaugeworks.plans.jobs import Store

#: View name, its raw tables in the operator's order, the operator.
LIVE: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {
    "active_requests": (["requests", "sessions", "sql_text", "databases"], live.active_requests),
    "blocking": (["waiting_tasks", "sessions"], live.live_blocking),
    "waits": (["waiting_tasks"], live.live_waits),
    "concurrency": (["sessions", "requests", "memory_grants", "transactions"], live.concurrency_now),
    "memory_grants": (["memory_grants"], live.memory_grants),
    "tempdb_by_session": (["space_usage", "sessions"], live.tempdb_by_session),
    "long_transactions": (["transactions", "session_transactions", "sessions"], live.long_transactions),
    "cpu_schedulers": (["schedulers"], live.cpu_schedulers),
}


class Views:
    """The 16 report views over a store's facts and, where `raw` gives the landed tables by name, the 8 live ones.

    `as_of` gives "now" whenever views are defined. `since` and `until` (inclusive days) keep report views from reading days outside;
    the first row of a series within them has no delta.
    """

    def __init__(
        self,
        store: Store,
        as_of: Callable[[], dt.datetime],
        raw: Callable[[str], DataFrame] | None = None,
        since: dt.date | None = None,
        until: dt.date | None = None,
    ):
        self.store, self.as_of, self.raw = store, as_of, raw
        self.since, self.until = since, until
        self.rules = store.rules()
        store.on_write.append(self._written)

    def refresh(self) -> list[str]:
        """Define every view anew and return their names."""
        made = self._reports(None)
        for name, (tables, build) in LIVE.items() if self.raw is not None else ():
            build(*map(self.raw, tables)).createOrReplaceTempView(f"live_{name}")
            made.append(f"live_{name}")
        return made

    def sql(self, statement: str) -> DataFrame:
        """A statement over all views as they are now, whoever wrote their tables."""
        self.refresh()
        return self.store.spark.sql(statement)

    def close(self) -> None:
        """Stop following the store; the views stay as they are."""
        self.store.on_write.remove(self._written)

    def _written(self, table: str) -> None:
        self._reports(table)

    def _reports(self, changed: str | None) -> list[str]:
        facts = self.store.facts(self.since, self.until)
        return reports.register_views(self.store.spark, facts, self.as_of(), self.rules, changed=changed)
