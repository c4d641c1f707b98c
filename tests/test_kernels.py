import re
import tracemalloc
from unittest import mock

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp

from twinshelf import kernels
from twinshelf.kernels import (
    CHANNEL_MEAN, CHANNEL_STD, Scorer, best_columns, by_group, hashed_counts, in_blocks,
    prepared_pixels, rounded, to_matrix, unit_bucket, vectors_to_arrow, word_units,
)


SCORES = st.one_of(
    st.sampled_from([0.0, 0.1, 0.2, 1.0, 1.04, 1.05, 1.06, 2.0, float("-inf")]),
    # neighbours that round to the same or to the next value
    st.builds(lambda base, step: base + step * 1e-6,
              st.sampled_from([0.3, 0.999995, 1.0, 1.05, -0.5]), st.integers(-30, 30)),
)


@settings(deadline=None, max_examples=300)
@given(
    hnp.arrays(np.float64, st.tuples(st.integers(1, 5), st.integers(1, 14)), elements=SCORES),
    st.integers(1, 16),
)
def test_best_columns_is_a_sort_by_rounded_score_then_column(scores, k):
    row, col, value = best_columns(scores, k)
    whole = rounded(scores)
    for r in range(len(scores)):
        usable = [c for c in range(scores.shape[1]) if scores[r, c] > -np.inf]
        want = sorted(usable, key=lambda c: (-whole[r, c], c))[:k]
        assert list(col[row == r]) == want
        assert list(value[row == r]) == [whole[r, c] for c in want]


def test_a_score_that_is_no_number_is_no_hit():
    schema = pa.schema([("q_id", pa.int64()), ("db_id", pa.int64()), ("score", pa.float64()),
                        ("rank", pa.int32())])
    vec = pa.list_(pa.float32())
    q = pa.table({"_id": [1, 2], "_vec": pa.array([[1.0, 0.0], [float("nan"), 1.0]], vec)})
    db = pa.table({"_id": [9, 8], "_vec": pa.array([[1.0, 0.0], [float("inf"), 0.0]], vec)})
    hits = Scorer([], 5, False, schema).score(q, db).to_pylist()
    # inf times 0 is no number, inf times 1 is a score
    assert [(h["q_id"], h["db_id"], h["score"]) for h in hits] == [
        (1, 8, float("inf")), (1, 9, 1.0)]


def test_rounding_rule():
    scores = np.array([0.123456, 0.259995, 0.999996, 1.0, 1.04, 1.05, 12.345])
    assert list(rounded(scores)) == [0.12346, 0.25999, 1.0, 1.0, 1.0, 1.0, 12.3]


def test_vectors_of_different_lengths_are_an_error():
    with pytest.raises(ValueError, match="different lengths"):
        to_matrix(pa.array([[1.0, 2.0], [1.0]], pa.list_(pa.float32())))
    # the total length divides evenly, the single lengths do not
    with pytest.raises(ValueError, match="different lengths"):
        to_matrix(pa.array([[1.0], [1.0, 2.0, 3.0]], pa.list_(pa.float32())))


def test_matrix_of_a_slice():
    vectors = pa.array([[1, 2], [3, 4], [5, 6]], pa.list_(pa.float32())).slice(1)
    assert to_matrix(vectors).tolist() == [[3, 4], [5, 6]]


def test_unit_vectors_and_nulls():
    out = vectors_to_arrow(np.array([[3.0, 4.0], [0, 0], [1, 0]]), np.array([True, True, False]))
    assert out.to_pylist() == [pytest.approx([0.6, 0.8]), None, None]


def _image(pixels):
    h, w, c = pixels.shape
    return {"height": h, "width": w, "nChannels": c, "data": pixels.astype(np.uint8).tobytes()}


def _images(*pixels):
    kind = pa.struct({"height": pa.int32(), "width": pa.int32(), "nChannels": pa.int32(),
                      "data": pa.binary()})
    return pa.array([_image(p) for p in pixels], kind)


def test_pixels_are_turned_to_rgb_and_standardised():
    blue = np.zeros((2, 2, 3))
    blue[..., 0] = 255
    out = prepared_pixels(_images(blue), 2)
    want = [(v - m) / s for v, m, s in zip((0, 0, 1), CHANNEL_MEAN, CHANNEL_STD)]
    assert out[0, :, 0, 0] == pytest.approx(want, abs=1e-6)


def test_centre_crop_and_padding():
    grey = np.arange(16).reshape(4, 4, 1)
    restore = np.array(CHANNEL_STD)[:, None, None], np.array(CHANNEL_MEAN)[:, None, None]
    crop = prepared_pixels(_images(grey), 2)[0] * restore[0] + restore[1]
    assert np.rint(crop[0] * 255).tolist() == [[5, 6], [9, 10]]
    padded = prepared_pixels(_images(grey), 6)[0] * restore[0] + restore[1]
    assert np.rint(padded[1] * 255)[0].tolist() == [0] * 6
    assert np.rint(padded[1] * 255)[1:5, 1:5].tolist() == grey[..., 0].tolist()


def test_alpha_is_dropped():
    pixels = np.full((1, 1, 4), 7)
    pixels[..., 3] = 255
    out = prepared_pixels(_images(pixels), 1)[0, :, 0, 0]
    want = [(7 / 255 - m) / s for m, s in zip(CHANNEL_MEAN, CHANNEL_STD)]
    assert out == pytest.approx(want, abs=1e-6)


def test_units_of_a_word():
    assert word_units("cde", 0) == ["cde"]
    assert word_units("cde", 3) == ["<cd", "cde", "de>"]
    assert word_units("", 3) == []


@settings(deadline=None)
@given(st.lists(st.text("ab c\t", max_size=30), min_size=1, max_size=8),
       st.sampled_from([0, 3]), st.sampled_from([None, 2]), st.sampled_from([1, 10, 1 << 20]))
def test_counts_of_whole_texts(texts, ngram, max_words, buffer):
    want = np.zeros((len(texts), 16))
    for i, t in enumerate(texts):
        # a leading space makes an empty first word, which counts towards the limit
        words = re.split(r"\s+", t)[:max_words]
        for u in (u for w in words if w for u in word_units(w, ngram)):
            want[i, unit_bucket(u, 16)] += 1
    with mock.patch("twinshelf.kernels.TEXT_BUFFER", buffer):
        assert hashed_counts(pa.array(texts), 16, ngram, max_words).tolist() == want.tolist()


def test_long_texts_are_counted_to_the_end():
    text = " ".join(f"w{i}" for i in range(30_000))
    counts = hashed_counts(pa.array([text, text + " tail"]), 64, 0, None)
    assert counts.sum(axis=1).tolist() == [30_000, 30_001]


def test_groups_and_blocks():
    table = pa.table({"a": ["x", "y", "x", None], "b": [1, 1, 1, 1], "v": [1, 2, 3, 4]})
    parts = {k: t["v"].to_pylist() for k, t in by_group(table, ["a", "b"]).items()}
    assert parts == {("x", 1): [1, 3], ("y", 1): [2], (None, 1): [4]}
    assert by_group(table, [])[()] is table
    blocks = [t["v"].to_pylist() for t in in_blocks(iter(table.to_batches(1)), 3)]
    assert blocks == [[1, 2, 3], [4]]


def test_a_scan_keeps_k_rows_per_query_over_many_blocks(monkeypatch):
    from types import SimpleNamespace

    from twinshelf import kernels

    monkeypatch.setattr(kernels, "SCAN_ROWS", 5)
    rng = np.random.default_rng(3)
    schema = pa.schema([("category", pa.string()), ("q_id", pa.int64()), ("db_id", pa.int64()),
                        ("score", pa.float64()), ("rank", pa.int32())])

    def side(n, first):
        return pa.table({
            "category": pa.array(rng.choice(["a", "b"], n)), "_id": pa.array(np.arange(first, first + n)),
            "_vec": pa.array(list(rng.normal(size=(n, 3)).astype(np.float32)), pa.list_(pa.float32())),
        })

    q, db = side(9, 0), side(40, 100)
    scorer = kernels.Scorer(["category"], 4, False, schema)
    got = pa.Table.from_batches(list(scorer.against(SimpleNamespace(value=q), False)(iter(db.to_batches(max_chunksize=3)))))
    want = []
    for name in ("a", "b"):
        pair = (t.filter(pc.equal(t["category"], name)) for t in (q, db))
        want += scorer.score(*pair).to_pylist()
    order = lambda r: (r["category"], r["q_id"], r["rank"])
    assert sorted(got.to_pylist(), key=order) == sorted(want, key=order)


def test_texts_are_counted_in_small_parts():
    """Places of the words of 32 MB of text took several times as much at a time."""
    texts = pa.array(["one two three four five six " * 1_000] * 800)
    tracemalloc.start()
    got = hashed_counts(texts, 8, 0, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.sum() == 800 * 6_000
    assert peak < 80 << 20


@pytest.mark.parametrize("kind", ["spread", "copies", "long", "ties"])
def test_few_entries_are_scored_in_double_precision(monkeypatch, kind):
    """All pairs were one product in double precision, of which every row was partitioned."""
    pick = np.random.default_rng(8)
    q, db = pick.normal(size=(30, 24)), pick.normal(size=(4_000, 24))
    if kind == "spread":
        db /= np.linalg.norm(db, axis=1)[:, None]
    elif kind == "copies":
        db[:20] = q[0]
    elif kind == "long":
        q, db = q * 1e6, db * 1e3
    else:
        q, db = np.round(q), np.round(db)
    q, db = q.astype(np.float32), db.astype(np.float32)
    schema = pa.schema([("q", pa.int64()), ("db", pa.int64()), ("score", pa.float64()), ("rank", pa.int32())])
    sides = [pa.table({"_id": pa.array(range(len(m))), "_vec": pa.array(list(m), pa.list_(pa.float32()))}) for m in (q, db)]
    row, col, value = kernels.best_columns(q.astype(float) @ db.T.astype(float), 7)
    tried = []
    monkeypatch.setattr(kernels, "best_columns", lambda *args: tried.append(args))
    got = kernels.Scorer([], 7, False, schema).score(*sides)
    assert not tried
    assert got["q"].to_pylist() == row.tolist() and got["db"].to_pylist() == col.tolist()
    assert np.allclose(got["score"].to_numpy(), value, rtol=1e-12)
    monkeypatch.undo()
    # copies in most columns, or vectors that single precision does not hold, are scored as they were
    for other in (np.repeat(db[:1], 4_000, axis=0), db.astype(float) * 1e30, np.where(np.arange(4_000)[:, None] == 5, np.nan, db)):
        side = pa.table({"_id": pa.array(range(4_000)), "_vec": pa.array(list(other), pa.list_(pa.float64()))})
        full = q.astype(float) @ other.T
        row, col, _ = kernels.best_columns(np.where(np.isnan(full), -np.inf, full), 7)
        got = kernels.Scorer([], 7, False, schema).score(sides[0], side)
        assert got["q"].to_pylist() == row.tolist() and got["db"].to_pylist() == col.tolist()


@pytest.mark.parametrize("kind", ["spread", "ties", "copies", "no number"])
def test_blocks_met_one_after_the_other(kind):
    """The running best rows of a block of queries are those of all rows at once."""
    pick = np.random.default_rng(5)
    q, db = pick.normal(size=(40, 16)), pick.normal(size=(6_000, 16))
    if kind == "ties":
        q, db = np.round(q), np.round(db)
    elif kind == "copies":
        db[::3] = q[0]
    elif kind == "no number":
        db[7, 3] = np.nan
    ids = pick.permutation(6_000)
    schema = pa.schema([("q", pa.int32()), ("db", pa.int64()), ("score", pa.float64()), ("rank", pa.int32())])
    kind_ = pa.list_(pa.float64())
    asked = pa.table({"_id": pa.array(range(40), pa.int32()), "_vec": pa.array([*map(list, q[:39]), None], kind_)})
    side = pa.table({"_id": pa.array(ids), "_vec": pa.array(list(db), kind_)})
    scorer = kernels.Scorer([], 7, False, schema)
    want = scorer.score(asked, side)
    order = [("q", "ascending"), ("rank", "ascending")]
    for sizes in ([2_500, 3, 1_000, 2_497], [5, 1, 5_994], [0, 3_000, 3_000]):
        places = np.split(np.arange(6_000), np.cumsum(sizes)[:-1])
        batch = pa.RecordBatch.from_pydict({
            "_db": [kernels.packed(side.take(pa.array(p))) for p in places],
            "_qb": pa.array([3] * len(places), pa.int32()), "_q": [kernels.packed(asked)] * len(places),
        })
        got = pa.Table.from_batches(scorer.streamed()(iter([batch.slice(0, 1), batch.slice(1)])))
        got, wanted = got.sort_by(order), want.sort_by(order)
        for name in ("q", "db", "rank"):
            assert got[name].to_pylist() == wanted[name].to_pylist()
        assert np.allclose(got["score"].to_numpy(), wanted["score"].to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("kind", ["spread", "copies", "ties", "far", "self"])
def test_rows_in_reach_are_found_among_the_nearest(monkeypatch, kind):
    """Buckets of all pairs were looked at in every table; now of those that can be among the best."""
    pick = np.random.default_rng(4)
    planes = np.where(pick.random((3, 6, 16)) < 0.5, -1.0, 1.0)
    q, db = pick.normal(size=(60, 16)), pick.normal(size=(8_000, 16))
    if kind == "copies":
        db[::50] = q[1]
    elif kind == "ties":
        q, db = np.round(q), np.round(db)
    probes = 2 if kind == "far" else 20
    codes = np.stack([(db @ t.T > 0) @ (1 << np.arange(6)) for t in planes], axis=1)
    cost = [(q @ t.T)**2 for t in planes]
    limits = np.stack([kernels.least_sums(c, probes)[:, -1] * (1 + 1e-9) + 1e-12 for c in cost], axis=1)
    own = kind == "self"
    if own:
        q, limits = db[:60], np.stack([kernels.least_sums((db[:60] @ t.T)**2, probes)[:, -1] * (1 + 1e-9) + 1e-12 for t in planes], axis=1)
    schema = pa.schema([("q", pa.int64()), ("db", pa.int64()), ("score", pa.float64()), ("rank", pa.int32())])
    numbers, ints = pa.list_(pa.float64()), pa.list_(pa.int32())
    asked = pa.table({"_id": pa.array(range(60)), "_vec": pa.array(list(q), numbers), "_limits": pa.array(list(limits), numbers)})
    side = pa.table({"_id": pa.array(range(8_000)), "_vec": pa.array(list(db), numbers), "_codes": pa.array(codes.tolist(), ints)})
    scorer = kernels.ReachScorer([], 5, own, schema, planes=planes)
    # all rows, plainly
    scores = q @ db.T
    flipped = [((codes[:, t][None, :, None] ^ codes_q[:, t][:, None, None]) >> np.arange(6) & 1) @ np.eye(6)
               for codes_q in [np.stack([(q @ p.T > 0) @ (1 << np.arange(6)) for p in planes], axis=1)] for t in range(3)]
    costs = [np.einsum("qnb,qb->qn", f, (q @ p.T)**2) for f, p in zip(flipped, planes)]
    reached = np.any([c <= limits[:, t, None] for t, c in enumerate(costs)], axis=0)
    scores[~reached] = -np.inf
    if own:
        scores[np.arange(60), np.arange(60)] = -np.inf
    row, col, value = kernels.best_columns(scores, 5)
    every = kernels.ReachScorer.best_of_all
    dense = []
    monkeypatch.setattr(kernels.ReachScorer, "best_of_all", lambda self, q, *args: dense.append(len(q)) or every(self, q, *args))
    order = [("q", "ascending"), ("rank", "ascending")]
    at_once = scorer.score(asked, side)
    assert sum(dense) < 20 or kind in ("far", "ties")
    running = kernels.Running(scorer, asked)
    for at in range(0, 8_000, 4_000):
        running.meet(side.slice(at, 4_000))
    for got in (at_once.sort_by(order), running.finished().sort_by(order)):
        assert got["q"].to_pylist() == row.tolist() and got["db"].to_pylist() == col.tolist()
        assert np.allclose(got["score"].to_numpy(), value, rtol=1e-12)
