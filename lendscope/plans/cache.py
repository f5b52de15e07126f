"""The stored snapshot row and the stored history of polls."""

from __future__ import annotations

from lendscope.operators.upsert import insert_ignore
from lendscope.plans.kpi import kpi_snapshot
from lendscope.sources.star import Star
from lendscope.sources.store import TableStore
from lendscope.sources.workspace import stored

CACHE, HISTORY = "kpi_cache", "kpi_history"


def refresh_kpi_cache(store: TableStore, star: Star, as_of) -> None:
    """Recompute the snapshot row and switch its view to it; readers see old or new. The
    poll history gets the row too, unless it has that day already."""
    with store.writing():
        row, folder = store.stage(kpi_snapshot(star, as_of).coalesce(1), CACHE)
        known = store.read_or_empty(HISTORY, row.schema)
        new = stored(insert_ignore(known, row, ["snapshot_ts"], order=None), "poll")
        if new.head(1):
            store.append(HISTORY, new.coalesce(1))
        store.show(CACHE, folder, row.schema)
