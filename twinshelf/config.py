"""Column roles and sizes shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

QUERY = "q"
DATABASE = "db"


@dataclass(frozen=True)
class MatchConfig:
    """Names and limits of one matching job.

    Column names are given without the side prefix: ``id_col="item_id"`` means
    ``q_item_id`` on the query side and ``db_item_id`` on the database side.
    """

    match_by: str = "text"
    category: str = "category"
    id_col: str = "item_id"
    name_col: str = "item_name"
    top_k: int = 10
    min_group_size: int = 2
    # Rows per side in one scoring task.  A category with more rows than this is
    # cut into a grid of tasks, so no task sees more than block_rows² pairs.
    block_rows: int = 16_384
    encoder: str | None = None
    exclude_self: bool = False
    # "exact"; "bounded", as exact, but cells that can hold no hit are not read; or approximate
    # by the nearest k-means "cells", by a "tree" of cells in two levels or by hyperplane "planes"
    method: str = "exact"
    # Where the cells are kept; an index that is already there is used as it is.
    index_path: str | None = None
    # What is None is chosen from the data: cells from the number of rows, the rest so that
    # sampled queries find this share of their exact hits.
    target_recall: float = 0.95
    n_cells: int | None = None
    nprobe: int | None = None
    # Top cells whose leaves a query looks at, in a tree.
    beam: int | None = None
    plane_tables: int | None = None
    plane_bits: int | None = None
    plane_probes: int | None = None
    # Vector length, needed for hyperplanes.
    vector_width: int | None = None

    def __post_init__(self) -> None:
        if self.method not in ("exact", "bounded", "cells", "tree", "planes"):
            raise ValueError(f"method must be exact, bounded, cells, tree or planes, not {self.method!r}")
        if not 0 < self.target_recall <= 1:
            raise ValueError("target_recall must be above 0 and at most 1")
        if self.method == "planes" and self.vector_width is None:
            raise ValueError("matching by planes needs vector_width")
        if self.match_by not in ("text", "image"):
            raise ValueError(f"match_by must be 'text' or 'image', not {self.match_by!r}")
        if self.top_k < 1 or self.block_rows < 1:
            raise ValueError("top_k and block_rows must be at least 1")

    def side(self, mode: str, name: str) -> str:
        return f"{mode}_{name}"

    @property
    def input_col(self) -> str:
        """What the encoder reads: cleaned text, or the path of an image file."""
        return f"{self.name_col}_clean" if self.match_by == "text" else "file_path"

    @property
    def vector_col(self) -> str:
        return f"{self.match_by}_embed"

    @property
    def score_col(self) -> str:
        return f"score_{self.vector_col}"

    @property
    def encoder_name(self) -> str:
        return self.encoder or {"text": "word_hash", "image": "histogram"}[self.match_by]


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    """Fail before any job starts if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
