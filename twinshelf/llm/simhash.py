"""Near duplicates by SimHash fingerprints and BK-trees.

A fingerprint has a bit for each bit of a 64-bit hash, set if it is set in over half of
the hashes of the text's word shingles. Documents of one fingerprint are one node from
the start; nodes within ``radius`` bits are linked. Where a similarity of whole texts is asked for,
documents of one set of shingles are one node; what only has equal fingerprints is compared.

Linking is split into shards such that two nodes within reach meet in one of them. Each
shard is a BK-tree: the children of a node are keyed by their Hamming distance to it, and
a search for everything within ``radius`` follows, from a node at distance d, only the
edges d - radius to d + radius. A tree with all fingerprints would grow with the data and
could not be broadcast, so each shard's tree goes to the task that has the shard's queries,
and its size is bounded:

* ``link_within`` (few bits, no link is lost): a pair within 2 bits agrees in one of 3
  blocks of the fingerprint, so blocks are shard keys. A shard with more than
  ``MAX_SHARD`` nodes is replaced by keys of 10 out of 12 blocks, 53 or more bits, so
  that none can have more than 2,048 nodes.
* ``link_similar`` (a similarity of whole texts): similar texts share most of 6 minima of
  hashed shingles, so these are shard keys. The nodes of a key with
  more than ``MAX_SHARD`` are dealt over blocks. A first round searches each block, blocks
  differing from key to key; in a second every two blocks of a key meet once, where pairs of one class of the
  first are left out. That is quadratic in the number of classes that share a key, in tasks of
  two blocks. In a shard every node is held against every other by
  512 bits, which tell what may be similar enough: such bits differ too much for a tree to save
  anything. Whole shingle sets then confirm each link, inside the groups of a shard that may be
  similar; a pair is left out only if confirmed links already make it one class.

Links are of local components, never all pairs of a group of copies.

Cases: a null text counts as empty; texts without words have fingerprint zero and are
linked like any other; fewer words than a shingle make one shingle; repeated rows give
repeated rows; null ids are kept, and are never the id of a class with other ids; an empty
table gives an empty result; other columns are ignored or, in ``drop_near_duplicates``, kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinshelf.llm.common import partitions, stored, table
from twinshelf.llm.components import components

SEED = 42
MAX_SHARD = 512
WORDS = 8  # of 64 bits, to tell what may be similar
MINIMA = 6
#: Odd multipliers for derived hashes, by a rule: multiples of the 64-bit golden ratio.
MIX = (np.arange(1, 32, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """Hashes of all word shingles, repeats included; A-Z count as a-z."""
    words = text.encode().lower().split()  # bytes: only A-Z, only the six ASCII spaces
    if not words:
        return np.empty(0, np.uint64)
    n = max(len(words) - shingle + 1, 1)
    if shingle > 1 and n > 1:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    else:
        grams = words if shingle == 1 else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255 * 1024):
        part = hashes[at : at + 255 * 1024]
        padded = np.zeros(-(-len(part) // 255) * 255, np.uint64)
        padded[: len(part)] = part
        bits = np.unpackbits(padded.astype(">u8").view(np.uint8).reshape(-1, 255, 8), axis=2)
        total += bits.sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def set_hash(unique: np.ndarray) -> int:
    """One hash of a whole set of hashes, given in order."""
    return xxhash.xxh64_intdigest(unique.tobytes(), SEED)


def remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Another hash of each shingle, derived from the first."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * MIX[k]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX[k + 1]
    return mixed ^ (mixed >> np.uint64(31))


def fingerprints(
    docs: DataFrame, *, shingle: int, id_col: str = "doc_id", text_col: str = "text",
    sketch: bool = False,
) -> DataFrame:
    """``id`` and ``fp`` of each row. With ``sketch``, ``fp`` is a hash of the whole set of
    shingles (equal sets only have the same), and there are ``WORDS`` words with the size of the set, and the minima."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"fp": [], "more": [], "minima": []}
            for text in batch.column(1).to_pylist():
                hashes = shingle_hashes(text, shingle)
                if not sketch:
                    out["fp"].append(majority(hashes))
                else:
                    hashes = np.unique(hashes)  # as similarity is of sets, a repeat must not weigh
                    out["fp"].append(set_hash(hashes))
                    derived = [remixed(hashes, k) for k in range(1, WORDS)]
                    words = [majority(x) for x in [hashes, *derived]]
                    out["more"].append(np.array([*words, len(hashes)], np.uint64).tobytes())
                    lows = [int((x * MIX[20]).min()) if len(x) else 0 for x in [hashes, *derived][:MINIMA]]
                    out["minima"].append(np.array(lows, np.uint64).view(np.int64))
            arrays = [batch.column(0), pa.array(np.array(out["fp"], np.uint64).view(np.int64))]
            if sketch:
                arrays += [pa.array(out["more"], pa.binary()), pa.array(out["minima"], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["id", "fp", *(["more", "minima"] if sketch else [])]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    more = ", more binary, minima array<long>" if sketch else ""
    return texts.mapInArrow(compute, f"id {kind}, fp long{more}")


class BKTree:
    """Fingerprints by Hamming distance to their parents."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def search(self, value: int, radius: int) -> list[int]:
        """Positions of all entries within ``radius`` bits."""
        found, open_ = [], [0] if self.values else []
        while open_:
            at = open_.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    open_.append(child)
        return found

    def add(self, value: int) -> int:
        new, at = len(self.values), 0
        self.values.append(value)
        self.children.append({})
        while new:
            d = (self.values[at] ^ value).bit_count()
            child = self.children[at].setdefault(d, new)
            if child == new:
                break
            at = child
        return new


def root_of(parent: list[int], at: int) -> int:
    while parent[at] != at:
        parent[at] = parent[parent[at]]
        at = parent[at]
    return at


class ExactShard:
    """Links every node to the local components within reach of it."""

    def __init__(self, radius: int) -> None:
        self.radius, self.tree, self.parent = radius, BKTree(), []

    def root(self, at: int) -> int:
        return root_of(self.parent, at)

    def links(self, value: int) -> list[int]:
        near = {self.root(x) for x in self.tree.search(value, self.radius)}
        new = self.tree.add(value)
        self.parent.append(new)
        for x in near:
            self.parent[x] = new
        return [self.tree.values[x] for x in near]


def link_shards(keyed: DataFrame, new_shard: Callable[[], object]) -> DataFrame:
    """Links (a, b) found in each shard of ``keyed`` (key, fp)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, None
        for batch in batches:
            a, b = [], []
            for k, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    key, shard = k, new_shard()
                for other in shard.links(fp & 0xFFFFFFFFFFFFFFFF):
                    a.append(fp)
                    b.append(other - (1 << 64) if other >> 63 else other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    n = partitions(keyed.sparkSession)
    dealt = keyed.repartition(n, "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(link, "a long, b long")


def without_large(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has at most ``MAX_SHARD`` nodes, and the larger keys."""
    large = stored(keyed.groupBy("key").count().filter(F.col("count") > MAX_SHARD).select("key"), "large-keys")
    return keyed.join(large, "key", "left_anti"), large


def block_keys(nodes: DataFrame, blocks: int, agree: int, salt: int) -> DataFrame:
    """A row for each choice of ``agree`` out of ``blocks`` blocks of the fingerprint."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), agree):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = [F.xxhash64(F.col("fp").bitwiseAND(F.lit(m)), F.lit(salt + i)) for i, m in enumerate(masks)]
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def link_within(nodes: DataFrame, radius: int) -> DataFrame:
    """All links of distinct fingerprints ``nodes`` (fp) within ``radius`` bits, as links of
    their components."""
    wide = block_keys(nodes, radius + 1, 1, 0)
    small, large = without_large(wide)
    hot = wide.join(large, "key", "left_semi").select("fp").distinct()
    narrow = block_keys(hot, 6 * radius, 5 * radius, 1_000)
    return link_shards(small.union(narrow), lambda: ExactShard(radius))


def similarity_bits(similarity: float, bits: int) -> float:
    """Expected differing bits of two sets with this Jaccard similarity."""
    return bits * math.acos(2 * similarity / (1 + similarity)) / math.pi


def bits_in_reach(similarity: float) -> int:
    """The most differing bits of two sets with this similarity: four deviations above what is
    expected. Small sets differ by up to a quarter more than the limit: 4 of 5 shingles by 0.1875
    a bit, where large sets of 0.8 differ by 0.151."""
    share = min(1.25 * similarity_bits(similarity, 1), 0.5)
    return math.ceil(64 * WORDS * share + 4 * math.sqrt(64 * WORDS * share * (1 - share)))


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one key after the other; rows come in the order of the first column, the key."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and rows[0][0] != row[0]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


class WideTree:
    """A BK-tree of fingerprints of ``WORDS`` words, in arrays: built and searched level by level.

    It is the tree that adding the rows one after the other gives; all rows, and all queries, go down
    one level at a time.
    """

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.words, self.edge = words, np.zeros(n, np.int64)
        parent, at, open_ = np.full(n, -1), np.zeros(n, np.int64), np.arange(1, n)
        while len(open_):
            d = bits_apart(words[open_], words[at[open_]])
            slots, first, slot = np.unique(at[open_] * (64 * WORDS + 1) + d, return_index=True, return_inverse=True)
            child = open_[first]
            parent[child], self.edge[child] = at[child], d[first]
            at[open_] = child[slot]
            open_ = np.delete(open_, first)
        self.children = np.argsort(parent, kind="stable")[1:]
        self.start = np.searchsorted(parent[self.children], np.arange(n))
        self.count = np.bincount(parent[self.children], minlength=n)

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, positions of entries within ``radius`` bits of them, and these bits."""
        query, at = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found = [(query[:0], at[:0], at[:0])]
        while len(query):
            d = bits_apart(self.words[at], queries[query])
            hit = d <= radius
            found.append((query[hit], at[hit], d[hit]))
            count = self.count[at]
            row = np.repeat(np.arange(len(query)), count)
            child = self.children[np.arange(len(row)) + np.repeat(self.start[at] - np.cumsum(count) + count, count)]
            near = np.abs(self.edge[child] - d[row]) <= radius
            query, at = query[row[near]], child[near]
        return tuple(np.concatenate(x) for x in zip(*found))


def bits_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64)


#: Queries that go down a tree together.
SEARCHED = 128


def near_pairs(
    shard: int | None, known: list[int], more: list[bytes], keys: list[list[int]], most_bits: int, similarity: float,
) -> Iterator[tuple[int, list[int]]]:
    """Each place, and the places before it that a shard's BK-tree has within ``most_bits``, nearest first.

    Without those of one class ``known``, and those whose sizes alone make them less similar. In the shard of a
    large key, ``shard``, two nodes count only if that is the first key that they share: in shards of
    other keys they meet as well.
    """
    if len(more) < 2:
        return
    sketch = np.frombuffer(b"".join(more), np.uint64).reshape(-1, WORDS + 1)
    words, size = np.ascontiguousarray(sketch[:, :WORDS]), sketch[:, WORDS].astype(np.int64)
    klass, minima = np.array(known), np.array(keys)
    tree = WideTree(words)
    for start in range(0, len(words), SEARCHED):
        i, j, bits = tree.search(words[start : start + SEARCHED], most_bits)
        i += start
        fit = (j < i) & (klass[i] != klass[j])
        fit &= np.minimum(size[i], size[j]) / np.maximum(np.maximum(size[i], size[j]), 1) >= similarity
        i, j, bits = i[fit], j[fit], bits[fit]
        if shard is not None and len(i):
            same = minima[i] == minima[j]
            fit = minima[i, same.argmax(1)] == shard
            i, j, bits = i[fit], j[fit], bits[fit]
        order = np.lexsort((j, bits, i))
        i, j = i[order], j[order].tolist()
        ends = np.searchsorted(i, np.unique(i), side="right").tolist()
        for lo, hi in zip([0, *ends], ends):
            yield int(i[lo]), j[lo:hi]


def known_classes(known: list[int]) -> list[int]:
    """For each place the first place of its class."""
    first: dict[int, int] = {}
    return [first.setdefault(c, at) for at, c in enumerate(known)]


#: What candidates are told by: number, class, sketch with the size of the set, keys of all minima.
NODE = ["fp", "known", "more", "keys"]


def candidates(shards: DataFrame, most_bits: int, similarity: float) -> DataFrame:
    """(shard, fps): the nodes of each shard that may be similar by their bits and sizes, one row for each local component.

    ``shards`` has rows (key, *NODE), or whole shards (shard, nodes) of large keys; ``shard`` is null for the former.
    """
    whole = "nodes" in shards.columns

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if whole:
            met = ((k, [n.values() for n in nodes]) for b in batches for k, nodes in zip(*(c.to_pylist() for c in b.columns)))
        else:
            met = ((None, [row[1:] for row in rows]) for rows in groups(batches))
        for shard, rows in met:
            if len(rows) == 1:
                continue
            fps, known, more, keys = zip(*sorted(map(tuple, rows)))
            parent = list(range(len(fps)))
            for i, near in near_pairs(shard, known, more, keys, most_bits, similarity):
                for j in near:
                    parent[root_of(parent, i)] = root_of(parent, j)
            found: dict[int, list[int]] = {}
            for at, fp in enumerate(fps):
                found.setdefault(root_of(parent, at), []).append(fp)
            out = [x for x in found.values() if len(x) > 1]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(out), pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["shard", "fps"]
                )

    n = partitions(shards.sparkSession)
    if whole:
        dealt = shards.select("shard", F.transform("nodes", lambda x: F.struct(*(x[c].alias(c) for c in NODE))).alias("nodes"))
        dealt = dealt.repartition(n)
    else:
        dealt = shards.select("key", *NODE).repartition(n, "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(find, "shard long, fps array<long>").dropDuplicates(["shard", "fps"])


def confirmed(found: DataFrame, texts: DataFrame, shingle: int, similarity: float, most_bits: int) -> DataFrame:
    """Links (a, b) of ``found`` (shard, fps) by the whole shingle sets of ``texts`` (*NODE, body).

    A pair is only left out if it is known, or links confirmed before it tell, that both are of one
    class, or if it is held in the shard of another key. So there are fewer links than nodes in a group, and none is lost.
    """

    def linked(shard, fps, known, more, keys, sets: list[np.ndarray]) -> pa.RecordBatch:
        parent = known_classes(known)
        a, b = [], []
        for i, near in near_pairs(shard, known, more, keys, most_bits, similarity):
            for j in near:
                if root_of(parent, i) != root_of(parent, j) and jaccard(sets[i], sets[j], similarity) >= similarity:
                    parent[root_of(parent, i)] = root_of(parent, j)
                    a.append(fps[i])
                    b.append(fps[j])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard, held = None, None, ([], [], [], [], [])
        for batch in batches:
            for *row, body in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.column(6)):
                if row[0] != key:
                    yield linked(shard, *held)
                    key, shard, held = row[0], row[1], ([], [], [], [], [])
                # a text is let go as soon as its set of shingles is known
                own = np.unique(shingle_hashes(body.as_py(), shingle))
                # rows of one id may have different texts; each node has one set
                if set_hash(own) == row[2] & 0xFFFFFFFFFFFFFFFF and row[2] not in held[0][-1:]:
                    for column, value in zip(held, (*row[2:], own)):
                        column.append(value)
        yield linked(shard, *held)

    members = found.select(F.xxhash64("shard", "fps").alias("key"), "shard", F.explode("fps").alias("fp"))
    dealt = members.join(texts, "fp").select("key", "shard", *NODE, "body")
    dealt = dealt.repartition(partitions(found.sparkSession), "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(check, "a long, b long")


def jaccard(x: np.ndarray, y: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two sets; 0 if their sizes alone make it less than ``least``. Empty sets are equal."""
    few, many = sorted((len(x), len(y)))
    if not many:
        return 1.0
    if few / many < least:
        return 0.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def texts_of(docs: DataFrame, nodes: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(*NODE, body) of the nodes in ``found`` (fps)."""
    ends = found.select(F.explode("fps").alias("fp")).distinct()
    wanted = nodes.join(ends, "fp", "left_semi").select(F.col("id").alias("__id"), *NODE)
    bodies = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("body"))
    met = bodies.join(wanted, F.col("id").eqNullSafe(F.col("__id")))
    return met.select(*NODE, "body").distinct()


def blocks_in(count: Column) -> Column:
    return F.ceil(count / MAX_SHARD)


def block_of(count: Column, salt: Column | str) -> Column:
    """A block of ``MAX_SHARD`` nodes or so, of a key with ``count`` nodes."""
    return F.pmod(F.xxhash64("fp", salt), F.greatest(blocks_in(count), F.lit(1)))


def block_shards(hot: DataFrame) -> DataFrame:
    """Shards (shard, pair, nodes) for keys of ``hot`` (key, fp, known, …) with too many nodes: every two blocks of a
    key meet once. Nodes of the largest class that is known are not held against each other.

    A block is one row from the start, so two blocks that meet are one row and not one for each node.
    """
    sizes = hot.groupBy("key", "known").count()
    plan = stored(
        sizes.groupBy("key").agg(F.max(F.struct("count", "known")).alias("most"), F.sum("count").alias("n"))
        .select("key", F.col("most.known").alias("main"), F.col("most.count").alias("n_main"),
                (F.col("n") - F.col("most.count")).alias("n_rest"))
        .filter("n_rest > 0"),
        "large-key-blocks",
    )
    rest, mains = blocks_in(F.col("n_rest")), blocks_in(F.col("n_main"))
    node = F.struct(*(c for c in hot.columns if c != "key")).alias("node")
    block = F.when(F.col("known") == F.col("main"), rest + block_of(F.col("n_main"), "key")).otherwise(
        block_of(F.col("n_rest"), "key")
    )
    placed = hot.join(plan, "key").select("key", block.alias("block"), rest.alias("rest"), (rest + mains).alias("all"), node)
    packed = stored(placed.groupBy("key", "block", "rest", "all").agg(F.collect_list("node").alias("nodes")), "large-blocks")
    ours = packed.filter("block < rest").withColumn("other", F.explode(F.sequence("block", F.col("all") - 1)))
    theirs = packed.select("key", F.col("block").alias("other"), F.col("nodes").alias("met"))
    both = F.when(F.col("block") == F.col("other"), F.col("nodes")).otherwise(F.concat("nodes", "met"))
    return ours.join(theirs, ["key", "other"]).select(
        F.col("key").alias("shard"), F.xxhash64("key", "block", "other").alias("pair"), both.alias("nodes")
    )


def block_pairs(hot: DataFrame) -> DataFrame:
    """The shards of ``block_shards``, a row (key, fp) for each node."""
    return block_shards(hot).select(F.col("pair").alias("key"), F.explode("nodes.fp").alias("fp"))


def link_similar(
    docs: DataFrame, nodes: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str,
) -> DataFrame:
    """Links (a, b) of ``nodes`` (fp, id, more, minima) whose shingle sets are similar enough."""
    most_bits = bits_in_reach(similarity)

    def links(shards: DataFrame, nodes: DataFrame) -> DataFrame:
        found = stored(candidates(shards, most_bits, similarity), "similar-groups")
        texts = texts_of(docs, nodes, found, id_col, text_col)
        return stored(confirmed(found, texts, shingle, similarity, most_bits), "similar-links")

    single = [F.xxhash64(F.lit(k), F.col("minima")[k]) for k in range(MINIMA)]
    # narrow, and written once; a minimum that no other node has is no shard
    keys = stored(nodes.select(F.explode(F.array(*single)).alias("key"), "fp").distinct(), "minima")
    sizes = stored(keys.groupBy("key").count().filter("count > 1"), "shard-sizes")
    nodes = nodes.withColumn("keys", F.array(*single)).drop("minima").withColumn("known", F.col("fp"))

    def sketched(placed: DataFrame, nodes: DataFrame) -> DataFrame:
        return placed.join(nodes.select(*NODE), "fp").select("key", *NODE)

    # blocks of a large key differ from key to key, so the first round leaves few classes of a family of copies
    large = F.col("count") > MAX_SHARD
    block = F.xxhash64("key", block_of(F.col("count"), "key"))
    met = keys.join(sizes, "key")
    first = links(sketched(met.select(F.when(large, block).otherwise(F.col("key")).alias("key"), "fp"), nodes), nodes)
    hot = stored(met.filter(large).select("key", "fp"), "large-keys")
    if hot.isEmpty():
        return first
    roots = stored(components(first).withColumnRenamed("node", "fp"), "first-classes")
    nodes = nodes.join(roots, "fp", "left").withColumn("known", F.coalesce("root", "fp")).drop("root")
    nodes = stored(nodes, "nodes-known")
    return first.union(links(block_shards(stored(sketched(hot, nodes), "large-keys-known")), nodes))


def classes(prints: DataFrame, links: DataFrame) -> DataFrame:
    """``prints`` (id, fp) with ``component_id``, the least id in reach."""
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links)
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    found = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(found, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp")


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Id, fingerprint and class of each row; classes are joined by chains of links."""
    prints = stored(fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col), "fingerprints")
    links = link_within(stored(prints.select("fp").distinct(), "nodes"), radius)
    return classes(prints, links).select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the least id of each class of similar texts; all columns as they are."""
    prints = stored(
        fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col, sketch=True), "sketches"
    )
    # rows of one set of shingles are one node; one of them stands for it
    nodes = stored(prints.groupBy("fp").agg(F.min(F.struct("id", "more", "minima")).alias("s"))
                   .select("fp", "s.*"), "nodes")
    links = link_similar(docs, nodes, shingle, similarity, id_col, text_col)
    found = classes(prints.select("id", "fp"), links)
    stays = found.filter(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("__id")).distinct()
    return docs.join(stays, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document: 3-word shingles, links at 2 bits or fewer."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: list[Callable] = [op1_simhash]
