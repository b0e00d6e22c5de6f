"""Page files -> one checked extract, in one pass over the pages (A1, A2, A5)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation

from wattframe.feeds import Feed
from wattframe.sources.files import remove, switch
from wattframe.sources.landing import conform
from wattframe.sources.pages import page_counts, page_rows, stamp, whole_extract


def write_checked_extract(
    pages: DataFrame,
    feed: Feed,
    ingestion_time: datetime | str,
    path: str,
    building: str | None = None,
) -> bool:
    """Write the pages' rows as the extract at ``path``; False, and nothing, if they declare none.

    Pages are parsed once: their totals are counted by the tasks that write the rows. The rows
    go to a folder of their own first (below ``building``, else hidden beside ``path``), which
    becomes the extract when the totals match. With other totals it is removed, an earlier extract stays, and :class:`TotalMismatch` is raised.
    """
    spark = pages.sparkSession
    totals = Observation()
    rows = page_rows(pages.observe(totals, *page_counts()))
    folder, _, name = path.rpartition("/")
    # readers skip names that begin with an underscore
    hidden = f"{building or folder}/_{name}.{uuid.uuid4().hex}"
    try:
        conform(stamp(rows, ingestion_time), feed).write.parquet(hidden)
        found = totals.get
        if not whole_extract(found):
            return False
        switch(spark, hidden, path, f"{hidden}.old")
        return True
    finally:
        remove(spark, hidden)
