"""Which queries a matching job has finished, kept beside its results.

Every run writes its hits to a folder of its own, ``run=<id>``, and then the ids of the queries it
has matched, with or without hits, to the ledger. A ledger entry is written aside and renamed into
place, so it is there whole or not at all, and hits of a run without an entry are not read: a run
that broke off leaves nothing behind that counts.

Entries are kept by a key of everything that decides what the hits are: with another k, encoder or
method no query counts as finished, and readers get the hits of the key that was committed last.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.config import MatchConfig
from twinshelf.operators.rows import matching
from twinshelf.sources.tables import FOLDER

# Settings that change where or how work is done, but not its result.
NO_EFFECT = ("block_rows", "index_path")


def config_key(config: MatchConfig, *more: str) -> str:
    """A key of a configuration; ``more`` may name the database table, its version and the like."""
    fields = {k: v for k, v in asdict(config).items() if k not in NO_EFFECT}
    fields["encoder"] = config.encoder_name
    text = json.dumps([fields, *more], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Ledger:
    """The finished queries of the job whose results are at ``out``."""

    spark: SparkSession
    out: str

    def _store(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _folders(self, path: str, prefix: str) -> list[tuple[int, str]]:
        """(time, value) of the folders ``<prefix>=<value>`` at ``path``."""
        store, at = self._store(path)
        if not store.exists(at):
            return []
        found = [(s.getModificationTime(), s.getPath().getName()) for s in store.listStatus(at)]
        return [(t, name.split("=", 1)[1]) for t, name in found if name.startswith(f"{prefix}=")]

    def keys(self) -> list[str]:
        """Keys with a committed run, the one committed last at the end."""
        root = f"{self.out}/_ledger"
        last = {key: max(self._folders(f"{root}/config={key}", "run"), default=None)
                for _, key in self._folders(root, "config")}
        return sorted((key for key, run in last.items() if run), key=lambda key: last[key])

    def runs(self, key: str) -> list[str]:
        """Committed runs, oldest first."""
        return [run for _, run in sorted(self._folders(f"{self.out}/_ledger/config={key}", "run"))]

    def pending(self, q: DataFrame, key: str, row_id: str, category: str) -> DataFrame:
        """Rows of ``q`` that no committed run with this key has matched."""
        runs = self.runs(key)
        if not runs:
            return q
        paths = [f"{self.out}/_ledger/config={key}/run={run}" for run in runs]
        done = self.spark.read.parquet(*paths).select("category", row_id).distinct()
        return matching(q, done, {category: "category", row_id: row_id}, "left_anti")

    def commit(self, run: str, key: str, finished: DataFrame) -> None:
        """Enter the (category, id) of a run's queries; from now on its hits are read."""
        aside, place = f"{self.out}/_ledger_aside/{run}", f"{self.out}/_ledger/config={key}"
        finished.write.parquet(aside)
        store, parent = self._store(place)
        store.mkdirs(parent)
        if not store.rename(self._store(aside)[1], self._store(f"{place}/run={run}")[1]):
            raise OSError(f"the ledger entry {aside} could not be moved to {place}")

    def run(
        self, q: DataFrame, key: str, row_id: str, category: str, match: Callable[[DataFrame], DataFrame],
        write: Callable[[DataFrame, str], None],
    ) -> bool:
        """Match what is pending, write the hits and commit; False if there was nothing to do.

        Rows without an id or a category have no hits and are never finished, so they are left out.
        """
        left = self.pending(q.where(F.col(row_id).isNotNull() & F.col(category).isNotNull()), key, row_id, category)
        if left.isEmpty():
            return False
        run = uuid.uuid4().hex
        write(match(left), f"{self.out}/run={run}")
        self.commit(run, key, left.select(F.col(category).alias("category"), row_id))
        return True


def read_matched(spark: SparkSession, out: str, key: str | None = None) -> DataFrame | None:
    """Hits of the committed runs of one key, the last one if none is given; None if there are none."""
    ledger = Ledger(spark, out)
    keys = ledger.keys()
    key = key or (keys[-1] if keys else None)
    paths = [f"{out}/run={run}" for run in ledger.runs(key)] if key else []
    if not paths:
        return None
    return spark.read.option("basePath", out).parquet(*paths).drop(FOLDER, "run")
