"""Deduplication operators against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from twinshelf.llm import exact_dedup, simhash, substring_dedup, suffix_dedup
from twinshelf.llm.components import components

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def distinct(rows):
    """One row of each id: repeated rows are the same document."""
    return {r[0]: r[1] for r in rows}


def test_exact_groups(odd_docs, odd_rows):
    got = {(r.id, r.keep_id, r.size, r.digest.hex()) for r in exact_dedup.exact_groups(odd_docs).collect()}
    groups = {}
    for r in odd_rows:
        groups.setdefault(SPACE.sub("", r[1] or ""), []).append(r)
    want = set()
    for body, rows in groups.items():
        keep = min(rows, key=lambda r: (-len(r[1] or ""), r[0]))[0]
        want |= {(r[0], keep, len(rows), hashlib.sha256(body.encode()).hexdigest()) for r in rows}
    assert got == want


def test_exact_dedup_keeps_whole_rows(odd_docs, odd_rows):
    kept = exact_dedup.drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    bodies = Counter(SPACE.sub("", r.text or "") for r in kept.collect())
    assert bodies == Counter({SPACE.sub("", r[1] or "") for r in odd_rows})


def test_exact_dedup_of_no_rows(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_duplicates(no_docs).count() == 0


def test_many_repeated_rows_that_stay(spark):
    """Rows of one id and text, and rows without an id, all stay as one: the check must not pair them."""
    docs = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "a row that is repeated").otherwise("and one without an id").alias("text"),
    )
    began = time.monotonic()
    got = exact_dedup.exact_groups(docs).groupBy("keep_id", "size").count().collect()
    assert {tuple(r) for r in got} == {(7, 20_000, 20_000), (None, 20_000, 20_000)}
    assert time.monotonic() - began < 60


def test_null_ids_are_least(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (2, "ab")], "doc_id long, text string")
    rows = exact_dedup.exact_groups(docs).collect()
    assert {(r.id, r.keep_id, r.size) for r in rows} == {(None, None, 3), (1, None, 3), (2, None, 3)}


def fingerprint(text, shingle):
    tokens = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    if not tokens:
        return 0
    grams = [" ".join(tokens[i : i + shingle]) for i in range(max(1, len(tokens) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def check_classes(got, texts):
    prints = {i: fingerprint(t, 3) for i, t in texts.items()}
    close = [(a, b) for a in texts for b in texts if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    want = roots(close, texts)
    assert got == {(i, "%016x" % prints[i], want[i]) for i in texts}


def test_simhash_classes(odd_docs, odd_rows):
    rows = simhash.near_duplicates(odd_docs, shingle=3, radius=2).collect()
    assert len(rows) == len(odd_rows)
    check_classes({(r.doc_id, "%016x" % (r.fp & (1 << 64) - 1), r.component_id) for r in rows}, distinct(odd_rows))


def test_simhash_of_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_large_shards_lose_no_link(spark, monkeypatch):
    """Many fingerprints of one block, above the bound, take the longer keys."""
    monkeypatch.setattr(simhash, "MAX_SHARD", 20)
    pick = random.Random(11)
    fps = {pick.getrandbits(64) for _ in range(50)}
    base = pick.getrandbits(64)
    fps |= {base ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 6))) for _ in range(400)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.link_within(spark.createDataFrame(signed, "fp long"), 2)
    got = {r.node: r.root for r in components(links).collect()}
    values = [x for x, in signed]
    close = [(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    want = roots(close, values)
    assert {v: got.get(v, v) for v in values} == want


def test_tree_finds_everything_in_reach():
    pick = random.Random(2)
    values = [pick.getrandbits(16) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.search(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (700, 701), (701, 700)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 700: 700, 701: 700}


def shingles(text, n=5):
    w = words((text or "").lower())
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize("limit", [512, 4])
def test_similar_texts_leave_one(spark, monkeypatch, limit):
    """Families of copies with changed words, with shards above the bound, too."""
    monkeypatch.setattr(simhash, "MAX_SHARD", limit)
    pick = random.Random(4)
    vocabulary = ["w%d" % k for k in range(5000)]
    texts = {}
    for family in range(8):
        base = [pick.choice(vocabulary) for _ in range(200)]
        for _ in range(6):
            own = list(base)
            for at in pick.sample(range(200), pick.choice([0, 1, 2, 3])):
                own[at] = pick.choice(vocabulary)
            texts[len(texts)] = " ".join(own)
    for _ in range(30):
        texts[len(texts)] = " ".join(pick.choice(vocabulary) for _ in range(80))
    sets = {i: shingles(t) for i, t in texts.items()}
    near = [(a, b) for a in texts for b in texts if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == set(roots(near, texts).values())


def kept_of(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}


def true_roots(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    near = [(a, b) for a in texts for b in texts if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return set(roots(near, texts).values())


def test_a_repeated_line_makes_no_near_copies(spark):
    """Bodies unlike each other under one line, repeated often: fingerprints are equal, sets are not."""
    pick = random.Random(5)
    line = " ".join("line%d" % k for k in range(9))
    texts = {i: " ".join([line] * 500 + ["w%d" % pick.randrange(9000) for _ in range(60)]) for i in range(6)}
    assert len({fingerprint(t, 5) for t in texts.values()}) == 1
    assert kept_of(spark, texts) == set(texts)


def test_a_large_family_falls_into_its_true_classes(spark):
    """Many candidates a node: none may take the place of one that is similar enough."""
    pick = random.Random(8)
    base = ["w%d" % pick.randrange(9000) for _ in range(400)]
    texts = {}
    for i in range(400):
        own = list(base)
        for at in pick.sample(range(400), pick.randint(1, 14)):
            own[at] = "w%d" % pick.randrange(9000)
        texts[i] = " ".join(own)
    kept = kept_of(spark, texts)
    assert kept == true_roots(texts)


def test_a_text_close_to_another_keeps_its_own_links(spark):
    """Chains L-m-C: m is nearly L, C is similar to m and not to L, so m has the only link."""
    pick = random.Random(12)
    texts = {}
    for _ in range(40):
        first = ["w%d" % pick.randrange(90_000) for _ in range(400)]
        middle, last = list(first), list(first)
        middle[7] = last[7] = "middle%d" % len(texts)
        for at in range(20, 20 + 8 * 6, 6):  # 356 of 436 shingles are middle's, 351 of 441 first's
            last[at] = "w%d" % pick.randrange(90_000)
        texts |= {len(texts) + k: " ".join(x) for k, x in enumerate((first, middle, last))}
    kept = kept_of(spark, texts)
    assert kept == true_roots(texts) and len(kept) == len(texts) // 3


def test_a_line_repeated_in_one_copy_only(spark):
    """Repeats do not change the set of shingles: 1 against 5 and 20 times the same line."""
    pick = random.Random(13)
    texts = {}
    for _ in range(10):
        body = " ".join("w%d" % pick.randrange(9000) for _ in range(300))
        line = " ".join("w%d" % pick.randrange(9000) for _ in range(9))
        for n in (1, 5, 20):
            texts[len(texts)] = " ".join([body, *[line] * n])
    kept = kept_of(spark, texts)
    assert kept == true_roots(texts) == set(range(0, 30, 3))


def test_bits_reach_similar_texts():
    """Pairs at 0.8 or little more, of small sets, too, are within the bits but for one in thousands."""
    pick = np.random.default_rng(14)
    most, lost = simhash.bits_in_reach(0.8), 0
    for n in range(1500):
        both = int(pick.choice([4, 8, 12, 40, 240]))
        one = int(pick.integers(0, both // 4 + 1))
        hashes = pick.integers(0, 1 << 63, both + both // 4, dtype=np.uint64) * np.uint64(2) + np.uint64(n % 2)
        a, b = hashes[: both + one], np.concatenate([hashes[:both], hashes[both + one :]])
        words = [[simhash.majority(h) for h in (x, *(simhash.remixed(x, k) for k in range(1, 8)))] for x in (a, b)]
        lost += sum((x ^ y).bit_count() for x, y in zip(*words)) > most
    assert lost <= 1


def test_a_hot_passage_hides_no_near_copies(spark, monkeypatch):
    """Pairs of similar texts that share little more than hot minima, one or two of them at most."""
    monkeypatch.setattr(simhash, "MAX_SHARD", 8)
    pick = random.Random(15)
    passage = ["hot%d" % k for k in range(60)]
    texts = {}
    for _ in range(60):
        body = ["w%d" % pick.randrange(9000) for _ in range(140)]
        texts[len(texts)] = " ".join(passage + body)
        for at in (10, 40, 70, 100):
            body[at] = "w%d" % pick.randrange(9000)
        texts[len(texts)] = " ".join(passage + body)
    kept = kept_of(spark, texts)
    assert kept == true_roots(texts) == set(range(0, 120, 2))


def test_every_two_blocks_meet_once(spark, monkeypatch):
    """Every two nodes of a large key meet, but those of its largest class; shards are bounded."""
    monkeypatch.setattr(simhash, "MAX_SHARD", 8)
    rows = [(1, k, 7 if k < 30 else k, b"") for k in range(90)] + [(2, k, 7, b"") for k in range(30)]
    shards = {}
    for r in simhash.block_pairs(spark.createDataFrame(rows, "key long, fp long, known long, more binary")).collect():
        shards.setdefault(r.key, []).append(r.fp)
    met = {(a, b) for fps in shards.values() for a in fps for b in fps if a < b}
    assert met >= {(a, b) for b in range(30, 90) for a in range(b)}
    assert all(len(fps) == len(set(fps)) <= 32 for fps in shards.values())


def test_blocks_that_meet_are_one_row(spark, monkeypatch):
    """Each node was a row of its own for every block that it met."""
    monkeypatch.setattr(simhash, "MAX_SHARD", 8)
    hot = spark.createDataFrame([(1, k, k) for k in range(90)], "key long, fp long, known long")
    got = simhash.block_shards(hot).collect()
    assert len(got) <= 12 * 13 / 2 + 12 and {r.shard for r in got} == {1}
    assert all(len({n.fp for n in r.nodes}) == len(r.nodes) <= 32 for r in got)


def test_wide_tree_is_the_tree_of_one_row_after_the_other():
    """The pipeline's shards had no tree."""
    pick = random.Random(16)
    base = [pick.getrandbits(512) for _ in range(5)]
    values = [pick.choice(base) ^ sum(1 << b for b in pick.sample(range(512), pick.randint(0, 90))) for _ in range(150)]
    values += [pick.getrandbits(512) for _ in range(50)] + values[:3]
    words = np.frombuffer(b"".join(v.to_bytes(64, "little") for v in values), np.uint64).reshape(-1, 8)
    tree, plain = simhash.WideTree(words), simhash.BKTree()
    for v in values:
        plain.add(v)
    children = {(at, int(tree.edge[c]), int(c)) for at in range(len(values))
                for c in tree.children[tree.start[at] : tree.start[at] + tree.count[at]]}
    assert children == {(at, d, c) for at, some in enumerate(plain.children) for d, c in some.items()}
    query, at, bits = tree.search(words, 131)
    got = sorted(zip(query.tolist(), at.tolist(), bits.tolist()))
    assert got == [(i, j, (a ^ b).bit_count()) for i, a in enumerate(values) for j, b in enumerate(values) if (a ^ b).bit_count() <= 131]


def test_a_pair_counts_in_its_first_large_key():
    more = [np.array([1] * 8 + [n], np.uint64).tobytes() for n in (10, 8, 7)]
    keys = [[1, 2, 3], [9, 2, 3], [9, 2, 3]]

    def pairs(shard):
        return list(simhash.near_pairs(shard, [0, 1, 2], more, keys, 131, 0.8))

    assert pairs(None) == [(1, [0]), (2, [1])]      # 7 of 10 cannot be similar enough
    assert (pairs(9), pairs(2), pairs(3)) == ([(2, [1])], [(1, [0])], [])


def test_near_dedup_keeps_columns(odd_docs):
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert 0 < kept.count() < odd_docs.count()


def check_windows(got, texts, size):
    first = {}
    for i in sorted(texts):
        w = words(texts[i])
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    for i, text in texts.items():
        w = words(text)
        gone = {k + d for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for d in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        row = got[i]
        assert (row.n_words, sum(x.end - x.start for x in row.intervals), row.kept) == (len(w), len(gone), kept), i


def test_word_windows(odd_docs, odd_rows):
    rows = substring_dedup.remove_repeats(odd_docs, size=13).collect()
    assert len(rows) == len(odd_rows)
    check_windows({r.doc_id: r for r in rows}, distinct(odd_rows), 13)


def test_word_windows_of_given_documents(given_docs):
    rows = substring_dedup.remove_repeats(given_docs, size=13).collect()
    check_windows({r.doc_id: r for r in rows}, {r.doc_id: r.text for r in given_docs.collect()}, 13)


def test_word_windows_of_no_rows(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def check_bytes(got, docs, size):
    """docs: (id, text) of all rows; equal ids have equal texts."""
    count = Counter()
    for _, t in docs:
        data = (t or "").encode()
        count.update(data[k : k + size] for k in range(len(data) - size + 1))
    for i, t in dict(docs).items():
        data = (t or "").encode()
        mark = np.zeros(len(data) + 1, int)
        for k in range(len(data) - size + 1):
            if count[data[k : k + size]] > 1:
                mark[k] += 1
                mark[k + size] -= 1
        gone = np.cumsum(mark)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        row = got[i]
        assert bytes(row.kept) == bytes(np.frombuffer(data, np.uint8)[~gone]), i
        assert (row.n_bytes, len(row.spans), sum(x.end - x.start for x in row.spans)) == (len(data), spans, gone.sum())


@pytest.mark.parametrize("distinct_limit", [256, 2])
def test_byte_strings(odd_docs, odd_rows, distinct_limit):
    """The lower bound sends most anchors to the count of whole windows."""
    rows = suffix_dedup.remove_repeats(odd_docs, max_distinct=distinct_limit).collect()
    assert len(rows) == len(odd_rows)
    check_bytes({r.doc_id: r for r in rows}, [(r[0], r[1]) for r in odd_rows], 200)


@pytest.mark.parametrize("distinct_limit", [256, 1])
def test_byte_strings_of_given_documents(given_docs, distinct_limit):
    rows = suffix_dedup.remove_repeats(given_docs, max_distinct=distinct_limit).collect()
    check_bytes({r.doc_id: r for r in rows}, [(r.doc_id, r.text) for r in given_docs.collect()], 200)


@pytest.mark.parametrize("distinct_limit", [256, 1])
def test_byte_strings_of_rows_without_an_id(spark, distinct_limit):
    """Each text without an id is judged by itself; the same one twice repeats itself."""
    pick = random.Random(8)
    shared, other, twice, least = ("".join(pick.choices("abcdefgh ", k=n)) for n in (400, 900, 300, 250))
    rows = [(None, shared + "x" + other[:300]), (None, other[300:]), (5, "start " + shared), (None, twice),
            (None, twice), (None, None), (None, ""), (-(1 << 61), least)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, max_distinct=distinct_limit).collect()
    kept = Counter((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in got)
    assert kept == Counter([
        (None, 701, "x" + other[:300]), (None, 600, other[300:]), (5, 406, "start "), (None, 300, ""), (None, 300, ""),
        (None, 0, ""), (None, 0, ""), (-(1 << 61), 250, least),
    ])


def test_byte_strings_of_no_rows(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_columns_against_counting():
    pick = random.Random(3)
    for _ in range(150):
        letters, size = pick.choice([b"ab", b"abc", b"abcdefgh"]), pick.choice([2, 3, 5, 8])
        bodies = [bytes(pick.choice(letters) for _ in range(pick.randint(size, 30))) for _ in range(pick.randint(1, 12))]
        count = Counter(b[k : k + size] for b in bodies for k in range(len(b) - size + 1))
        for body, found in zip(bodies, suffix_dedup.sort_columns(bodies, size)):
            assert [bool(x) for x in found[: len(body) - size + 1]] == [
                count[body[k : k + size]] > 1 for k in range(len(body) - size + 1)
            ]


@pytest.mark.parametrize("wide", [1, 2, 4, 8])
def test_columns_of_wide_symbols_against_counting(monkeypatch, wide):
    """Windows start at every place of a symbol, and end at every place of a body."""
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    pick = random.Random(4)
    for _ in range(40):
        letters, size = pick.choice([b"a", b"ab", b"abcdefgh"]), pick.choice([8, 12, 16, 24, 31])
        shared = bytes(pick.choice(letters) for _ in range(size + 5))
        bodies = []
        for _ in range(pick.randint(1, 12)):
            ends = (bytes(pick.choice(letters) for _ in range(pick.randint(0, 20))) for _ in range(2))
            bodies.append(next(ends) + shared[pick.randint(0, 5) :] + next(ends))
        count = Counter(b[k : k + size] for b in bodies for k in range(len(b) - size + 1))
        for body, found in zip(bodies, suffix_dedup.sort_columns(bodies, size)):
            assert [bool(x) for x in found[: len(body) - size + 1]] == [
                count[body[k : k + size]] > 1 for k in range(len(body) - size + 1)
            ]


def test_columns_go_over_few_rows(monkeypatch):
    """Byte by byte, the passes over 16 bodies of 336 bytes go over 910,000 rows."""
    pick = random.Random(5)
    bodies = [bytes(pick.choices(b"abcdefgh ", k=336)) for _ in range(16)]
    passed, argsort = [], np.argsort

    def counted(values, *args, **kw):
        passed.append(len(values))
        return argsort(values, *args, **kw)

    monkeypatch.setattr(np, "argsort", counted)
    assert not suffix_dedup.sort_columns(bodies, 200).any()
    assert len(passed) <= 336 // 8 + 1
    assert sum(passed) < 910_000 / 7


def test_least_between():
    pick = random.Random(6)
    values = np.array(pick.choices(range(200), k=70), np.uint8)
    pairs = [(a, b) for a in range(70) for b in range(a, 70)]
    first, last = (np.array(x) for x in zip(*pairs))
    got = suffix_dedup.least_between(values, first, last)
    assert got.tolist() == [values[a : b + 1].min() for a, b in pairs]


def test_long_texts_are_cut_without_a_seam(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = list(suffix_dedup.runs(data, 200, 64))
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    parts = list(suffix_dedup.runs(data, 200, 64))
    assert len(parts) > len(whole)
    windows = lambda found: sorted((int(a), k) for f in found for a, s, n in zip(*f[:3]) for k in range(s, s + n))
    assert windows(whole) == windows(parts)
