"""Tables that are expected to be small, and what is done if they are not."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.session import cut

# Up to this many rows a table is fetched to the driver in one job.
ROWS_FETCHED = 5_000
# A larger one is broadcast only if it is measured to take fewer bytes than this.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Small:
    """A computed table; ``rows`` holds it if it was fetched."""

    frame: DataFrame
    rows: pa.Table | None
    fits: bool

    def for_join(self) -> DataFrame:
        """Broadcast if its size was found to allow it."""
        return F.broadcast(self.frame) if self.fits else self.frame


def measured(df: DataFrame) -> Small:
    """Compute an aggregated table once and find out whether it may be broadcast.

    Every partition hands over at most a bounded number of rows.  A table with
    more than that stays in Spark.
    """
    few = df.limit(ROWS_FETCHED + 1).toArrow()
    if few.num_rows <= ROWS_FETCHED:
        return Small(df.sparkSession.createDataFrame(few, df.schema), few, True)
    stored = cut(df)
    text = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    size = stored.agg(F.sum(sum(text, F.lit(16 * (1 + len(text)))))).first()[0]
    return Small(stored, None, size <= BROADCAST_BYTES)
