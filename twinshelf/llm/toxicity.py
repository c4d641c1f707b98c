"""Toxic passages by maximum-scoring segments of token log-odds.

A token is a word or a word's prefix of 3 to 7 letters. Its weight is the log-odds ratio of
toxic against clean labelled texts under a Dirichlet prior that has the token's counts in all
documents; weights below ``MIN_Z`` standard errors or twice the drift are dropped. Words score the weight of
their heaviest token, less a drift, wherever they are; all other words score minus the drift, so that passages end. One
pass over a text finds all its maximal segments (Ruzzo and Tompa), in time linear in its
length. Inside each segment, repeats of a word score minus the drift, and its best part is its score. Under the null a segment of score S in n words has E-value K n exp(-lambda S):
lambda solves the moment equation of the word scores in clean texts, K is the likelihood
estimate from their best segments. A text's evidence is its best and its summed normalised
scores; a logistic curve fitted on the labelled texts turns that into a score from 0 to 1.

Labels are learned from a sample of at most ``MAX_LABELS`` rows, those with the least
hashed ids. Prior counts are taken over all documents. At most ``MAX_TOKENS`` tokens,
those most frequent in toxic texts, are weighed; both bound what is broadcast.

Cases: null and empty texts have no segments and get the score of such texts; without labels of
both kinds every score is 0; labels that contradict each other count as toxic; null labels and
labels without a document are ignored; repeated rows give repeated rows; an empty table gives an empty
result; other columns are ignored or, in ``drop_toxic``, kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import held_out, table

MAX_LABELS = 40_000
MAX_TOKENS = 100_000
MIN_COUNT = 4
MIN_Z = 3.0
PREFIXES = range(3, 8)
PRIOR_WORDS = 10_000.0  # weight of the prior, in words
DRIFT = 0.5
CACHE_SIZE = 300_000
WORD = re.compile(r"\w+")


class Model(NamedTuple):
    """weight: token to (weight, standard errors); curve: of the logistic fit."""

    weight: dict[str, tuple[float, float]]
    lam: float = 1.0
    k: float = 1.0
    curve: tuple[float, ...] = ()


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def tokens_of(word: str) -> list[str]:
    """The word, and its prefixes marked with a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


class WordScores(dict):
    """Score of a word, from the weights; a cache of bounded size."""

    def __init__(self, weight: dict[str, tuple[float, float]]) -> None:
        super().__init__()
        self.weight = weight

    def __missing__(self, word: str) -> float:
        known = [x for x in map(self.weight.get, tokens_of(word)) if x]
        score = max((x[0] for x in known), default=0.0) - DRIFT
        if len(self) >= CACHE_SIZE:
            self.clear()
        self[word] = score
        return score


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in time linear in the length.

    A stack holds candidates with the sums before and after them. A new positive score is
    joined to the nearest candidate that began lower, if it also ends higher.
    """
    stack: list[list] = []  # start, end, sum before, sum after, nearest candidate that began lower
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                new[4] = j
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3], -1]
            del stack[j:]
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def joined(points: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """Segments (start, end, score) of places with positive scores; runs between them are one step."""
    steps, starts, last = [], [], -1
    for i, s in points:
        if steps:
            steps.append(-DRIFT * (i - last - 1))
            starts.append(last + 1)
        steps.append(s)
        starts.append(i)
        last = i
    return [(starts[a], starts[b - 1] + 1, s) for a, b, s in maximal_segments(steps)]


def segments_of(words: list[str], scores: WordScores) -> list[tuple[int, int, float]]:
    """Segments in words, by all places; the score of each is the best with its repeats damped.

    Weights come from texts that have a word, so only its first place in a segment has the whole
    weight; what comes before the segment does not matter.
    """
    points = [(i, s) for i, s in enumerate(map(scores.__getitem__, words)) if s > 0]
    out, k = [], 0
    for a, b, _ in joined(points):
        first: dict[str, tuple[int, float]] = {}
        while k < len(points) and points[k][0] < b:
            if points[k][0] >= a:
                first.setdefault(words[points[k][0]], points[k])
            k += 1
        out.append((a, b, max(s for _, _, s in joined(list(first.values())))))
    return out


def evidence(model: Model, n: int, found: list[tuple[int, int, float]]) -> list[float]:
    """Best and summed normalised score of the segments, and the length, on log scales."""
    base = math.log(max(model.k * n, 1e-9))
    above = [max(model.lam * s - base, 0.0) for _, _, s in found]
    best = max((model.lam * s for _, _, s in found), default=0.0)
    return [1.0, math.log1p(best), math.log1p(sum(above)), math.log1p(n)]


def score_of(model: Model, n: int, found: list[tuple[int, int, float]]) -> float:
    if not model.curve:
        return 0.0
    x = sum(a * b for a, b in zip(model.curve, evidence(model, n, found)))
    return 1 / (1 + math.exp(-max(min(x, 500.0), -500.0)))


def _batches(columns: dict, schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in schema], names=[n for n, _ in schema])


def label_sample(labels: DataFrame, learnable: Column, id_col: str, label_col: str) -> dict:
    """Id to label, of at most ``MAX_LABELS`` rows that may be learned."""
    usable = labels.filter(learnable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    one = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    return {r.id: r.y for r in one.orderBy(F.xxhash64("id"), "id").limit(MAX_LABELS).collect()}


def token_counts(texts: DataFrame, label) -> DataFrame:
    """(token, toxic, clean): in how many labelled texts each word is, summed for prefixes;
    a text that repeats itself weighs no more than another."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (y := label.value.get(i)) is not None:
                    seen[bool(y)].update(set(words_of(text)))
            if len(seen[0]) + len(seen[1]) > CACHE_SIZE:
                yield counted(seen)
                seen = (Counter(), Counter())
        yield counted(seen)

    def counted(seen) -> pa.RecordBatch:
        words = list(seen[0] | seen[1])
        return _batches(
            {"word": words, "toxic": [seen[1][w] for w in words], "clean": [seen[0][w] for w in words]},
            [("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())],
        )

    words = texts.mapInArrow(count, "word string, toxic long, clean long")
    words = words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    tokens = F.array(
        F.col("word"),
        *(F.when(F.length("word") >= n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in PREFIXES),
    )
    expanded = words.select(F.explode(tokens).alias("token"), "toxic", "clean").filter("token is not null")
    return expanded.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def prior_counts(texts: DataFrame, wanted) -> tuple[dict[str, int], int]:
    """The same counts for the wanted tokens in all texts, and their sum over all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total, seen = Counter(), 0, Counter()

        def fold() -> None:
            for word, n in seen.items():
                for token in tokens_of(word):
                    if token in wanted.value:
                        tokens[token] += n
            seen.clear()

        for batch in batches:
            for text in batch.column(1).to_pylist():
                words = set(words_of(text))
                seen.update(words)
                total += len(words)
            if len(seen) > CACHE_SIZE:
                fold()
        fold()
        yield _batches(
            {"token": ["", *tokens], "n": [total, *tokens.values()]}, [("token", pa.string()), ("n", pa.int64())]
        )

    rows = texts.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = {r.token: r.n for r in rows.collect()}
    return found, found.pop("", 0)


def weigh(counts: list, prior: dict[str, int], words: int, n_toxic: int, n_clean: int) -> dict:
    """Log-odds ratio with the informative prior, and its standard errors."""
    weight = {}
    for token, toxic, clean in counts:
        a = PRIOR_WORDS * (prior.get(token, 0) + 0.5) / (words + 1)
        odds = lambda n, of: (n + a) / max(of + PRIOR_WORDS - n - a, 1e-9)  # noqa: B023, E731
        delta = math.log(odds(toxic, n_toxic)) - math.log(odds(clean, n_clean))
        weight[token] = (delta, delta / math.sqrt(1 / (toxic + a) + 1 / (clean + a)))
    return {k: v for k, v in weight.items() if v[1] >= MIN_Z and v[0] > 2 * DRIFT}


def labelled_segments(texts: DataFrame, label, frozen) -> list:
    """(label, words, segment scores, positive word scores) of each labelled text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(frozen.value)
        for batch in batches:
            out: dict[str, list] = {"y": [], "n": [], "found": [], "points": []}
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (y := label.value.get(i)) is not None:
                    words = words_of(text)
                    out["y"].append(y)
                    out["n"].append(len(words))
                    out["found"].append([s for _, _, s in segments_of(words, scores)])
                    first = dict.fromkeys(words) if not y else ()
                    out["points"].append([s for s in map(scores.__getitem__, first) if s > 0])
            yield _batches(out, [("y", pa.int32()), ("n", pa.int64()), ("found", pa.list_(pa.float64())),
                                 ("points", pa.list_(pa.float64()))])

    return texts.mapInArrow(find, "y int, n long, found array<double>, points array<double>").collect()


def calibrate(weight: dict, rows: list) -> Model:
    """Extreme-value parameters from the clean texts, then the logistic curve."""
    clean = [r for r in rows if not r.y]
    words = sum(r.n for r in clean)
    points = np.array([s for r in clean for s in r.points])
    miss = max(words - len(points), 1)

    def moment(lam: float) -> float:
        return (miss * math.exp(-DRIFT * lam) + np.exp(np.minimum(lam * points, 500)).sum()) / max(words, 1) - 1

    low, high = 1e-3, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 0 else (low, middle)
    lam = low
    chance = [r.n * math.exp(-lam * max(r.found, default=0.0)) for r in clean if r.n]
    model = Model(weight, lam, 1 / max(float(np.mean(chance)), 1e-9) if chance else 1.0)
    x = np.array([evidence(model, r.n, [(0, 0, s) for s in r.found]) for r in rows])
    y = np.array([r.y > 0 for r in rows], float)
    curve = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ curve)
        curve += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return model._replace(curve=tuple(curve))


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """The model from the labels that ``learnable``, a condition on ``labels``, admits."""
    sc = docs.sparkSession.sparkContext
    sample = label_sample(labels, learnable, id_col, label_col)
    if len({bool(y) for y in sample.values()}) < 2:
        return Model({})
    label = sc.broadcast(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = token_counts(texts, label).cache()
    sums = counted.filter("not endswith(token, '*')").agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = (x or 0 for x in sums)
    frequent = (
        counted.filter(F.col("toxic") >= MIN_COUNT).orderBy(F.desc("toxic"), "token").limit(MAX_TOKENS).collect()
    )
    counted.unpersist()
    prior, words = prior_counts(texts, sc.broadcast(frozenset(r.token for r in frequent)))
    weight = weigh(frequent, prior, words, n_toxic, n_clean)
    rows = labelled_segments(texts, label, sc.broadcast(weight))
    if len({bool(r.y) for r in rows}) < 2:
        return Model({})
    return calibrate(weight, rows)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__toxicity`` and ``__segments`` (first and last word, score, E-value)."""
    frozen = docs.sparkSession.sparkContext.broadcast(tuple(model))
    segment = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e", pa.float64())]))
    at = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*frozen.value)
        scores = WordScores(own.weight)
        for batch in batches:
            out, spans = [], []
            for text in batch.column(at).to_pylist():
                words = words_of(text)
                found = segments_of(words, scores)
                out.append(score_of(own, len(words), found))
                e = [(s, min(own.k * len(words) * math.exp(-own.lam * s[2]), 1e9)) for s in found]
                spans.append([{"start": a, "end": b, "score": s, "e": x} for (a, b, s), x in e])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.float64()), pa.array(spans, segment)], names=names
            )

    names = [*(f"c{i}" for i in range(len(docs.columns))), "__toxicity", "__segments"]
    plain = docs.toDF(*names[:-2])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    done = plain.mapInArrow(
        score, f"{kinds}, __toxicity double, __segments array<struct<start:int,end:int,score:double,e:double>>"
    )
    return done.toDF(*docs.columns, "__toxicity", "__segments")


def drop_toxic(docs: DataFrame, model: Model, *, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold."""
    return with_scores(docs, model, text_col).filter(F.col("__toxicity") < threshold).select(*docs.columns)


def learnable_ids(id_col: str = "doc_id") -> Column:
    """Ids whose crc32 leaves no rest by 5 are held out of training."""
    return F.coalesce(~held_out(id_col, 5, 0), F.lit(True))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"), learnable_ids())
    return with_scores(docs, model).select(
        "doc_id",
        F.coalesce(held_out("doc_id", 5, 0), F.lit(False)).alias("held_out"),
        F.col("__toxicity").alias("score"),
        (F.col("__toxicity") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES: list[Callable] = [op3_toxicity]
