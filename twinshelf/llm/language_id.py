"""Language identification by prediction by partial matching.

Training counts, for each language, every byte after its ``ORDER`` preceding bytes, over all
training texts; counts after fewer bytes are sums of these. They form a context tree of variable
depth per language: a byte is kept after a context if the pair makes up at least a fixed share
of the language's bytes, so frequent contexts go deep and rare ones end early. As a pair is
never more frequent than its shorter form, a kept context has all its suffixes kept.

Where a context has not kept a byte, it escapes to the context one byte shorter. The escape
has one count per distinct kept byte (method C) and the counts of bytes that were not kept; bytes that
the longer context could have coded are excluded in the shorter one, so that the probabilities
after any context add up to one. Below the empty context all 256 bytes are equally likely.

The statistics are frozen: a kept pair has its own cost, a context has the cost of leaving it, and
the exact code length of a text under a language is the sum of one pair and the escapes on the
way to it, for each byte.

Sizes: the share is one in ``ENTRIES`` divided by the number of languages, so a level of all trees
together has at most ``ENTRIES`` pairs and the frozen trees at most about 60 MB, however much text or however many
languages there are. A task sums its counts and sends them on when it holds ``HELD`` different ones.

Cases: a null text, or one without any letter, is ``und`` with score 0; if nothing can be
learned every text is ``und``; equal code lengths go to the language first by name; repeated
rows give repeated rows; an empty table gives an empty result; very long texts are coded
in pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import held_out, stored, table

#: Bytes of the longest context; a context and a byte after it are one number of 8 bytes a piece.
ORDER = 4
#: Pairs of a context and a byte that one level of all trees has at most.
ENTRIES = 1 << 19
PIECE = 1 << 20
HELD = 1 << 21
UNKNOWN = "und"


class Level(NamedTuple):
    """Contexts of one length: pairs of context and byte with their costs, contexts with their escape's."""

    pairs: np.ndarray
    cost: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


class Model(NamedTuple):
    """By language, the levels of its tree from the empty context on; costs are in nats."""

    languages: list[str]
    trees: list[list[Level]]


def pieces(text: str) -> Iterator[np.ndarray]:
    """Each byte with the ``ORDER`` before it as one number; a text starts after line feeds."""
    data = np.frombuffer(b"\n" * ORDER + text.encode(), np.uint8)
    for at in range(0, len(data) - ORDER, PIECE):
        part = data[at : at + PIECE + ORDER].astype(np.uint64)
        codes = np.zeros(len(part) - ORDER, np.uint64)
        for k in range(ORDER + 1):
            codes = (codes << np.uint64(8)) | part[k : k + len(codes)]
        yield codes


def suffix(codes: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes of each number."""
    return codes & np.uint64((1 << 8 * size) - 1)


class Totals:
    """Counts by language and code; what has arrived since the last merge is bounded."""

    def __init__(self) -> None:
        self.languages: dict[str, int] = {}
        self.code, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, codes: np.ndarray) -> None:
        number = self.languages.setdefault(lang, len(self.languages))
        self.waiting.append(codes | np.uint64(number << 8 * (ORDER + 1)))
        self.size += len(codes)
        if self.size >= PIECE:
            self.merge()

    def merge(self) -> None:
        if self.waiting:
            code, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.waiting, self.size = [], 0
            self.code, where = np.unique(np.concatenate([self.code, code]), return_inverse=True)
            self.n = np.bincount(where, np.concatenate([self.n, n])).astype(np.int64)

    def take(self) -> pa.RecordBatch:
        """All counts so far, which are forgotten."""
        self.merge()
        numbers = (self.code >> np.uint64(8 * (ORDER + 1))).astype(np.int32)
        names = pa.DictionaryArray.from_arrays(pa.array(numbers), pa.array(list(self.languages), pa.string()))
        batch = pa.RecordBatch.from_arrays(
            [names.cast(pa.string()), pa.array(suffix(self.code, ORDER + 1).astype(np.int64)), pa.array(self.n)],
            names=["lang", "code", "n"],
        )
        self.code, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)
        return batch


def count_codes(texts: DataFrame) -> DataFrame:
    """Rows (lang, code, n) over all rows of ``texts`` (lang, text), summed in each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for codes in pieces(text):
                    totals.add(lang, codes)
                    if len(totals.code) >= HELD:
                        yield totals.take()
        yield totals.take()

    counted = texts.mapInArrow(count, "lang string, code long, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def contexts(counted: DataFrame) -> DataFrame:
    """Rows (lang, size, context, total, bytes), one for each context of 0 to ``ORDER`` bytes.

    ``bytes`` are the at most 256 bytes seen after it, with their counts.
    """
    sizes = F.explode(F.sequence(F.lit(0), F.lit(ORDER)))
    pairs = counted.withColumn("size", sizes).select(
        "lang", "size", "n",
        F.expr("code & (shiftleft(1L, 8 * (size + 1)) - 1)").alias("pair"),
    )
    summed = pairs.groupBy("lang", "size", "pair").agg(F.sum("n").alias("n"))
    return (
        summed.groupBy("lang", "size", F.shiftright("pair", 8).alias("context"))
        .agg(
            F.sum("n").alias("total"),
            F.collect_list(F.struct((F.col("pair") % 256).cast("int").alias("byte"), "n")).alias("bytes"),
        )
    )


def cost_of(tree: list[Level], codes: np.ndarray, size: int) -> np.ndarray:
    """Nats of each code's last byte after the ``size`` bytes before it."""
    out = np.zeros(len(codes))
    open_ = np.arange(len(codes))
    for k in range(size, -1, -1):
        if k >= len(tree) or not len(tree[k].contexts):
            continue
        level, pair = tree[k], suffix(codes[open_], k + 1)
        at = np.minimum(np.searchsorted(level.pairs, pair), len(level.pairs) - 1)
        found = level.pairs[at] == pair
        out[open_[found]] += level.cost[at[found]]
        open_, context = open_[~found], pair[~found] >> np.uint64(8)
        at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
        out[open_] += np.where(level.contexts[at] == context, level.escape[at], 0.0)
    out[open_] += np.log(256.0)
    return out


def grow(tree: list[Level], pairs: np.ndarray, n: np.ndarray, totals: dict[int, int]) -> None:
    """Add the level of the next longer contexts; ``totals`` counts all bytes after a context."""
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    own, first, distinct = np.unique(pairs >> np.uint64(8), return_index=True, return_counts=True)
    which = np.repeat(np.arange(len(own)), distinct)
    kept = np.bincount(which, n, len(own))
    total = np.array([totals[int(c)] for c in own], np.float64)
    # if all bytes were kept there is nothing to escape to
    escape = np.where(distinct == 256, 0.0, distinct + (total - kept))
    lower = np.exp(-cost_of(tree, pairs, len(tree) - 1)) if tree else np.full(len(pairs), 1 / 256)
    left = np.maximum(1 - np.bincount(which, lower, len(own)), 1e-12)
    leave = np.full(len(own), np.inf)
    some = escape > 0
    leave[some] = np.log((kept + escape)[some] / escape[some]) + np.log(left[some])
    tree.append(Level(pairs, np.log((kept + escape)[which] / n), own, leave))


def learn(texts: DataFrame) -> Model:
    """The frozen model of ``texts`` (lang, text); both without nulls."""
    found = stored(contexts(count_codes(texts)), "ppm-contexts")
    bytes_of = {r["lang"]: r["total"] for r in found.where("size = 0").select("lang", "total").collect()}
    languages = sorted(bytes_of)
    share = max(1, ENTRIES // max(len(languages), 1))
    all_bytes = found.where("size = 0").select("lang", F.col("total").alias("of"))
    kept = (
        found.join(all_bytes, "lang")
        .withColumn("pair", F.explode(F.filter("bytes", lambda x: x["n"] * share >= F.col("of"))))
        .select("lang", "size", "context", "total", "pair.byte", "pair.n")
        .toArrow()
    )
    levels = ([kept.filter((pc.field("lang") == lang) & (pc.field("size") == k)) for k in range(ORDER + 1)]
              for lang in languages)
    return Model(languages, [frozen_tree(x) for x in levels])


def frozen_tree(levels: Iterable[pa.Table]) -> list[Level]:
    tree: list[Level] = []
    for level in levels:
        context = level["context"].to_numpy().astype(np.uint64)
        pairs = (context << np.uint64(8)) | level["byte"].to_numpy().astype(np.uint64)
        totals = dict(zip(level["context"].to_pylist(), level["total"].to_pylist()))
        grow(tree, pairs, level["n"].to_numpy().astype(np.float64), totals)
    # costs of four bytes do for scores; the levels above each other needed eight
    return [Level(x.pairs, x.cost.astype(np.float32), x.contexts, x.escape.astype(np.float32)) for x in tree]


def code_lengths(model: Model, texts: Iterable[str]) -> np.ndarray:
    """Nats that each language needs for each text: (texts, languages)."""
    texts = list(texts)
    total = np.zeros((len(texts), len(model.languages)))

    def settle(rows: list[int], parts: list[np.ndarray]) -> None:
        sizes = [len(p) for p in parts]
        codes, where = np.unique(np.concatenate(parts), return_inverse=True)
        part = np.repeat(np.arange(len(parts)), sizes)
        for i, tree in enumerate(model.trees):
            sums = np.bincount(part, cost_of(tree, codes, ORDER)[where], len(parts))
            np.add.at(total[:, i], rows, sums)

    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        for codes in pieces(text):  # pieces begin at fixed places, so sums don't depend on the batch
            rows.append(row)
            parts.append(codes)
            held += len(codes)
            if held >= PIECE:
                settle(rows, parts)
                rows, parts, held = [], [], 0
    if parts:
        settle(rows, parts)
    return total


def classify(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and posterior probability of each text."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if not model.languages:
        return out
    rows = [i for i, text in enumerate(texts) if text is not None and any(map(str.isalpha, text))]
    for i, lengths in zip(rows, code_lengths(model, (texts[i] for i in rows))):
        best = int(lengths.argmin())
        out[i] = model.languages[best], float(1 / np.exp(lengths[best] - lengths).sum())
    return out


def identify(
    docs: DataFrame, learnable: Column, *, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Id, predicted language and its posterior probability, for every row.

    ``learnable`` says of which rows the language may be learned.
    """
    model = learn(
        docs.filter(learnable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    )
    frozen = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = frozen.value
        for batch in batches:
            found = classify(own, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(predict, f"id {kind}, lang_pred string, score double").withColumnRenamed(
        "id", id_col
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    predicted = identify(docs, F.coalesce(~out, F.lit(True)))
    return predicted.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES: list[Callable] = [op9_language_id]
