"""Importance resampling, hard negatives and WARC files against plain versions."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from twinshelf.llm import hard_negatives as hard
from twinshelf.llm import importance, warc
from twinshelf.session import scratch_path


# importance resampling

def plain_features(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, percent=5, min_words=20):
    """(id, n_features, weight, score, rank) with ties by id, number of features; null first."""
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10_000 for f in plain_features(text)[1]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))

    rows = []
    for row_id, text in docs:
        found = buckets(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{row_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((row_id, len(found), weight, score, len(plain_features(text)[0]) >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = able[: len(able) * percent // 100]
    out = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    rest = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return out + [(*r, None) for r in rest.elements()]


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("percent", [0, 5, 37, 100])
def test_resample_as_plain(spark, odd_docs, odd_rows, percent):
    target = [(k, t) for k, t in enumerate(["alpha beta gamma", "delta epsilon", None, ""])]
    got = importance.resample(odd_docs, spark.createDataFrame(target, "item_id long, text string"), percent=percent)
    want = plain_resample([(r[0], r[1]) for r in odd_rows], [t for _, t in target], percent)
    assert as_rows(got, "id", "n_features", "weight", "score", "rank") == sorted(want, key=repr)


def test_resample_ties_and_missing_ids(spark):
    rows = [(None, "a b " * 20), (None, "a b " * 20), (3, "x y " * 30), (3, "x y " * 30), (4, None), (None, "c " * 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    for percent in (20, 40, 60, 80):
        got = importance.resample(docs, target, percent=percent)
        want = plain_resample(rows, ["x y"], percent)
        assert as_rows(got, "id", "n_features", "weight", "score", "rank") == sorted(want, key=repr)


def test_resample_without_rows(spark, no_docs, odd_docs):
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(odd_docs, target).count() == odd_docs.count()


def test_long_texts_are_taken_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choice(["Ab", "c-d", "é", "x9"]) for _ in range(500))
    whole = sorted(zlib.crc32(f.encode()) for f in plain_features(text)[1])
    for piece in (1, 2, 7, 100, 1 << 20):
        monkeypatch.setattr(importance, "PIECE", piece)
        parts = list(importance.feature_hashes(text))
        assert sum(n for n, _ in parts) == len(plain_features(text)[0])
        assert sorted(x for _, hashes in parts for x in hashes.tolist()) == whole


def test_select_key(spark):
    pick = random.Random(3)
    keys = [(pick.choice([None, 1, 2, 2, 3]), k) for k in range(300)]
    rows = spark.createDataFrame(keys, "a long, b long")
    order = sorted(keys, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for k in (1, 2, 77, 299, 300):
        assert tuple(importance.select_key(rows, ["a", "b"], k, pivots=3)) == order[k - 1]
    assert importance.select_key(rows.limit(0), ["a", "b"], 1) is None


# hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, vec string, id string, n_shard int"


def plain_negatives(rows, is_anchor, positives=5, negatives=3):
    best = {}
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (label, [math.floor(256 * x) for x in vec])
        best[i] = min(best.get(i, row), row)

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, (label, vec) in best.items():
        if not is_anchor(a):
            continue
        others = sorted((-score(vec, v), i, l) for i, (l, v) in best.items() if i != a)
        for p, i, _ in [o for o in others if o[2] == label][:positives]:
            fit = [(s, j) for s, j, l in others if l != label and -50 * p <= -100 * s <= -95 * p][:negatives]
            out += [(a, i, k + 1, j, -p, -s) for k, (s, j) in enumerate(fit)]
    return sorted(out)


def given_rows():
    pick = random.Random(5)
    rows = [(k, [pick.choice([-0.5, 0.0, 0.25, pick.uniform(-1, 1)]) for _ in range(6)], pick.randrange(3)) for k in range(240)]
    rows += [(1_000 + k, rows[k][1], 1) for k in range(0, 60, 5)]  # equal vectors, so ties
    rows += [(2_000 + k, [0.5] * 6, 7) for k in range(30)] + [(50, [0.9] * 6, 0), rows[7], rows[7]]
    rows += [(3_000, None, 1), (3_001, [1.0, None], 1), (3_002, [math.nan] * 6, 1), (3_003, [math.inf] * 6, 1)]
    rows += [(3_004, [1.0] * 6, None), (None, [1.0] * 6, 1), (3_005, [], 1), (3_006, [0.5, 0.5], 2), (3_010, [0.0] * 6, 2)]
    return rows


@pytest.mark.parametrize("sizes", [dict(), dict(shard_rows=20, block_rows=5)])
def test_negatives_as_plain(spark, sizes):
    rows = given_rows()
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], VECTORS).repartition(3)
    got = hard.hard_negatives(frame, F.col("id") % 10 == 0, **sizes)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_text_labels_and_no_rows(spark):
    rows = [(f"v{k}", [math.sin(k * d) for d in range(1, 9)], "ab"[k % 2]) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")
    got = hard.hard_negatives(frame, F.col("id") < "v2", shard_rows=9)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i < "v2")
    assert hard.hard_negatives(frame.limit(0), F.col("id") < "v2").count() == 0
    assert hard.hard_negatives(frame, F.lit(False)).count() == 0


def test_search_stops_early_and_exactly(monkeypatch):
    """Few lists fall fast, so most rows are never scored; large scores are exact."""
    import numpy as np

    monkeypatch.setattr(hard, "STRETCH", 8)
    pick = np.random.default_rng(1)
    vectors = pick.integers(-1_000, 1_000, (4_000, 2))
    shard = hard.Shard(np.arange(4_000), np.zeros(4_000, int), vectors.astype(float))
    seen = []
    merged = hard.Shard.merged
    monkeypatch.setattr(hard.Shard, "merged", staticmethod(lambda *a: seen.append(len(a[2])) or merged(*a)))
    at, scores = shard.search(np.array([3.0, -2.0]), np.ones(4_000, bool), [(hard.LEAST, -hard.LEAST)], 5)[0]
    want = sorted((-(3 * a - 2 * b), k) for k, (a, b) in enumerate(vectors.tolist()))[:5]
    assert [(-s, a) for a, s in zip(at.tolist(), scores.tolist())] == want
    assert sum(seen) < 1_000
    big = [np.array([[2**30, 1]]), np.array([[2**30, 1], [2**30, 2]])]
    a, b = hard.exact(*big)
    found = hard.Shard(np.arange(2), np.zeros(2, int), b).search(a[0], np.ones(2, bool), [(hard.LEAST, -hard.LEAST)], 1)
    assert found[0][1].tolist() == [2**60 + 2]


# WARC

def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, type string, at long").repartition(3)


def odd_pages():
    pick = random.Random(9)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    body = ["<p>" + "".join(pick.choice("abc é\r\n") for _ in range(pick.randrange(3_000))) for _ in range(20)]
    texts = [None, "", "short", *body, body[3], body[3], body[4] + "x" * 1_000, body[4] + "x" * 1_000, fake, fake * 40, "short",
             "WARC/1.", "WARC/1.WARC/1.1\r\n", fake + "y" * 900, "z" * 999, "z" * 999, "z" * 1_000, "z" * 1_000, fake * 3_000]
    urls = [None, "http://a.example/ b\r\nX: 1", "http://b.example/WARC/1.1\r\n%41", "http://c.example/é"]
    rows = [(k, urls[k % 4], t, "t", None) for k, t in enumerate(texts)]
    return rows + [rows[6], rows[-2], (None, None, "n" * 1_200, None, 1), (90, None, "n" * 1_200, None, 1), (None, None, None, None, None)]


def plain_warc(rows, least=1_000):
    groups = {}
    for page, _, html, *_ in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        stays = max(groups[html or ""], key=lambda p: -1 if p is None else p)
        again = len(data) >= least and page != stays
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", stays if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", ["128m", "3k", "17k"])
def test_warc_round_trip(spark, split):
    rows, path = odd_pages(), scratch_path(spark, "warc-test")
    warc.write_warc(pages_of(spark, rows), path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        records = warc.read_records(spark, path).cache()
        got = warc.resolved(records).select(F.col("id").cast("long"), "n_bytes", "sha1", "type", F.col("refers_to").cast("long"))
        assert sorted(map(tuple, got.collect()), key=repr) == plain_warc(rows)
        payloads = {(r.id, r.type): bytes(r.payload) for r in warc.read_payloads(spark, path).collect()}
        for page, _, html, *_ in rows:
            if page is not None and (str(page), "response") in payloads:
                assert payloads[str(page), "response"] == (html or "").encode()
        # what lies between the records is nothing: together they are the files
        ends = records.groupBy("path").agg(F.sum(F.col("end") - F.col("at")).alias("n"), F.max("end").alias("end")).collect()
        assert ends and all(r.n == r.end for r in ends)
        records.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_warc_of_no_pages(spark):
    path = scratch_path(spark, "warc-empty")
    warc.write_warc(pages_of(spark, []), path)
    assert warc.resolved(warc.read_records(spark, path)).count() == 0


def record(kind, payload, *more, version="1.0"):
    head = [f"WARC/{version}", f"WARC-Type: {kind}", f"Content-Length: {len(payload)}", *more]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def test_warc_of_others(spark, tmp_path):
    """Other types and versions, binary payloads, magics at odd places, compressed files, files that are torn."""
    payloads = [b"", b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc", b"\xff\xfe\x00WARC/1.\x80" * 9, b"WARC/1.", b"\r\n\r\nWARC/1.1\r\n"]
    data = b"".join(record("resource", p, "WARC-Target-URI: http://x.example/WARC/1.0", f"WARC-Page-ID: {k}") for k, p in enumerate(payloads))
    data += record("warcinfo", b"software: x\r\n", version="1.1")
    (tmp_path / "a.warc").write_bytes(data)
    with gzip.open(tmp_path / "b.warc.gz", "wb") as sink:
        sink.write(data)
    found = warc.read_payloads(spark, f"file://{tmp_path}").collect()
    assert sorted((r.type, r.id, bytes(r.payload)) for r in found if r.id) == sorted(
        ("resource", str(k), p) for k, p in enumerate(payloads) for _ in range(2)
    )
    assert sum(r.type == "warcinfo" for r in found) == 2
    digests = {r.id: r.sha1 for r in warc.read_records(spark, f"file://{tmp_path}").collect()}
    assert all(digests[str(k)] == hashlib.sha1(p).hexdigest() for k, p in enumerate(payloads))
    for name, bad in (("c", data[:-3]), ("d", b"x" + data), ("e", data + b"x")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc").write_bytes(bad)
        with pytest.raises(ValueError, match="x.warc"):
            warc.read_records(spark, f"file://{tmp_path}/{name}")
