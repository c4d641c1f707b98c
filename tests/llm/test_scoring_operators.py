"""Toxicity, language and decontamination; the pipeline as a whole."""

import collections
import functools
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinshelf.llm import decontamination, language_id, toxicity
from twinshelf.llm.queries import ORACLES, QUERIES




def segments_by_force(scores):
    """Maximal segments by their definition: the best of a stretch, then both sides again."""
    sums = [0, *itertools.accumulate(scores)]
    best = max(
        ((sums[b] - sums[a], -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=(0, 0, 0, 0, 0),
    )
    if best[0] <= 0:
        return []
    a, b = best[3], best[4]
    right = [(x + b, y + b, s) for x, y, s in segments_by_force(scores[b:])]
    return segments_by_force(scores[:a]) + [(a, b, best[0])] + right


def test_maximal_segments():
    pick = random.Random(9)
    for _ in range(400):
        scores = [pick.randint(-50, 40) + pick.random() for _ in range(pick.randint(0, 14))]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in segments_by_force(scores)]


def labelled(spark, n=400):
    pick = random.Random(6)
    good = ["calm%d" % k for k in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [pick.choice(good) for _ in range(pick.randint(10, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                words.insert(len(words) // 2, pick.choice(["vile", "nasty", "scornful"]))
        docs.append((i, " ".join(words), "kept"))
        labels.append((i, int(bad)))
    docs += [(n, None, None), (n + 1, "", "kept"), (None, "calm1 vile nasty vile", "kept")]
    labels += [(n, None), (None, 1), (n + 1, 0), (0, 1), (99_999, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, __toxicity string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_is_found_and_held_out_rows_are_not_learned(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels, toxicity.learnable_ids())
    rows = toxicity.with_scores(docs.drop("__toxicity"), model).collect()
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r["__toxicity"] >= 0.5) == (r.doc_id % 4 == 0) for r in held]
    assert len(held) > 50 and np.mean(right) > 0.97
    assert all(0 <= r["__toxicity"] <= 1 for r in rows)
    assert [r for r in rows if r.doc_id is None][0]["__segments"]
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.learn(docs, turned, toxicity.learnable_ids())
    assert again.weight == model.weight and again.curve == model.curve


def test_toxicity_without_labels_or_rows(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(odd_docs, none, F.lit(True))
    assert toxicity.drop_toxic(odd_docs, model).count() == odd_docs.count()
    assert toxicity.drop_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.with_scores(no_docs, toxicity.learn(no_docs, none, F.lit(True))).count() == 0


def test_toxicity_on_given_labels(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, toxicity.learnable_ids())
    rows = toxicity.with_scores(docs, model).join(labels, "doc_id").select("doc_id", "toxic", "__toxicity").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    order = sorted(held, key=lambda r: r["__toxicity"])
    ranks = [k for k, r in enumerate(order) if r.toxic]
    n, m = len(ranks), len(held) - len(ranks)
    assert (sum(ranks) - n * (n - 1) / 2) / (n * m) > 0.8  # area under the curve


def test_a_later_dense_passage_is_a_segment():
    """Toxic words that came scattered before, or a passage that comes again, take no weight from it."""
    scores = toxicity.WordScores({w: (3.0, 9.0) for w in ("vile", "nasty", "scornful", "base")})
    dense = "vile nasty scornful base".split()
    alone = toxicity.segments_of(dense, scores)
    assert alone == [(0, 4, 10.0)]
    scattered = [w for x in dense for w in [x, *["calm"] * 40]]
    assert toxicity.segments_of(scattered + dense, scores)[-1] == (len(scattered), len(scattered) + 4, 10.0)
    assert toxicity.segments_of([*dense, *["calm"] * 90, *dense], scores) == [(0, 4, 10.0), (94, 98, 10.0)]
    assert toxicity.segments_of(["vile"] * 9, scores)[0][2] == 2.5


def plain_ppm(texts, share, order):
    """Prediction by partial matching as its definition says it, one byte at a time."""
    counts = collections.defaultdict(collections.Counter)
    for text in texts:
        data = b"\n" * order + text.encode()
        for i in range(order, len(data)):
            for size in range(order + 1):
                counts[data[i - size : i]][data[i]] += 1
    whole = sum(counts[b""].values())
    kept = {c: {x: n for x, n in seen.items() if n * share >= whole} for c, seen in counts.items()}

    @functools.cache
    def chances(context):
        lower = chances(context[1:]) if context else [1 / 256] * 256
        own = kept.get(context)
        if not own:
            return lower
        rare = sum(counts[context].values()) - sum(own.values())
        escape = 0 if len(own) == 256 else len(own) + rare
        whole, left = sum(own.values()) + escape, 1 - sum(lower[x] for x in own)
        return [own[x] / whole if x in own else escape / whole * lower[x] / left for x in range(256)]

    def nats(text):
        data = b"\n" * order + text.encode()
        return -sum(math.log(chances(data[i - order : i])[data[i]]) for i in range(order, len(data)))

    return nats


@pytest.mark.parametrize("entries", [1 << 19, 3_000])
def test_code_lengths_equal_a_plain_ppm(spark, given_docs, odd_rows, entries, monkeypatch):
    monkeypatch.setattr(language_id, "ENTRIES", entries)
    rows = given_docs.where("n_chars < 3000").orderBy("doc_id").select("lang", "text").collect()
    every_byte = "".join(map(chr, range(1, 0x900))) + "\U0001f642\U00040000\U00100000"
    rows = [*((r.lang, r.text) for r in rows if r.lang), ("en", every_byte)]
    model = language_id.learn(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    assert model.languages == sorted({lang for lang, _ in rows}) and len(model.languages) > 2
    share = entries // len(model.languages)
    for size in range(language_id.ORDER + 1):
        assert sum(len(tree[size].pairs) for tree in model.trees) <= entries
    asked = [text for _, text in rows[::2]] + [r[1] for r in odd_rows if r[1] and len(r[1]) < 3000]
    assert len(asked) > 90
    got = language_id.code_lengths(model, asked)
    for i, lang in enumerate(model.languages):
        plain = plain_ppm([text for own, text in rows if own == lang], share, language_id.ORDER)
        assert np.allclose(got[:, i], [plain(text) for text in asked], rtol=1e-5, atol=1e-4)


def test_chances_of_all_bytes_add_up_to_one(spark):
    texts = ["abracadabra " * 9, "the cat sat on the mat", "日本語 ünïcode"]
    model = language_id.learn(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    for before in (b"abra", b"n th", b"zzzz", b"\n\n\n\n", "日".encode() + b" "):
        codes = np.array([int.from_bytes(before + bytes([x]), "big") for x in range(256)], np.uint64)
        assert np.isclose(np.exp(-language_id.cost_of(model.trees[0], codes, language_id.ORDER)).sum(), 1, rtol=1e-5)


def test_code_lengths_do_not_depend_on_what_is_coded_together(spark, monkeypatch):
    monkeypatch.setattr(language_id, "PIECE", 50)
    monkeypatch.setattr(language_id, "HELD", 20)
    texts = ["one two three " * 40, "x", "", "four five six " * 7]
    docs = spark.createDataFrame([("a", t) for t in texts] + [("b", "seven eight")], "lang string, text string")
    model = language_id.learn(docs)
    together = language_id.code_lengths(model, texts)
    assert (together == np.concatenate([language_id.code_lengths(model, [t]) for t in texts])).all()
    monkeypatch.setattr(language_id, "PIECE", 1 << 20)
    assert np.allclose(together, language_id.code_lengths(language_id.learn(docs), texts), rtol=1e-6)


def test_language_on_given_documents(given_docs):
    learnable = F.col("doc_id") % 2 == 0
    rows = language_id.identify(given_docs, learnable).join(given_docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.doc_id % 2]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(odd_docs, no_docs, odd_rows):
    rows = language_id.identify(odd_docs, F.lit(True)).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(odd_rows)
    for r in odd_rows:
        has_letter = any(c.isalpha() for c in r[1] or "")
        assert (by_id[r[0]].lang_pred != "und") == has_letter
    assert language_id.identify(no_docs, F.lit(True)).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd_docs, F.lit(False)).collect()} == {"und"}


def test_numerals_are_no_letters(spark):
    texts = ["25 ½", "x² 4", "① Ⅷ", "12.5 %", "è", "字"]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, F.lit(True)).collect()}
    assert [got[k] for k in range(6)] == ["und", "en", "und", "und", "en", "en"]


ITEM = "In the spring of 1999 the clever engineer Alice measured 12 km of road and told Bob that 12 km was far too long"


def test_templates_keep_places(spark):
    rows = spark.createDataFrame([(ITEM,), ("x - y, “Zoe” 3.5kg 7 kg.",)], "t string")
    got = rows.select(decontamination.words(decontamination.template(F.col("t"))).alias("a"),
                      decontamination.words(F.col("t")).alias("b")).collect()
    assert all(len(r.a) == len(r.b) for r in got)
    assert got[0].a[:5] == ["in", "the", "spring", "of", "<num>"]
    assert got[0].a[8:12] == ["<name>", "measured", "<num>", "<unit>"]


def test_contamination_and_slots(spark):
    other = ITEM.replace("1999", "2004").replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "30")
    slots = "it is {} {} from here and {} {} from there but {} {} goes with {} {} of it"
    docs = [
        (1, "Some words before. " + ITEM + " and after"), (2, other), (3, slots.format(1, "km", 2, "mi", 3, "kg", 4, "lb")), (9, slots.format(1, "mi", 1, "mi", 3, "lb", 3, "lb")),
        (4, "nothing of the kind, only words that come in their own order, as ever"), (5, None), (6, ""), (None, ITEM),
        (1, "Some words before. " + ITEM + " and after"), (7, " ".join(ITEM.split()[:9])), (8, " ".join(ITEM.split()[:12])),
    ]
    items = [(10, ITEM), (11, None), (12, ""), (13, "short item of five words"),
             (14, slots.format(5, "km", 5, "km", 7, "kg", 7, "kg"))]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 10), (2, 10), (8, 10), (9, 14)}
    assert {r.windows for r in found if r.doc_id in (1, 2)} == {len(ITEM.split()) - 7}


def test_slots_count_under_the_windows_that_hit(spark):
    """Parts of an item, items with a word put in or left out, and short items inside documents."""
    item = ("the old mill by the river was sold for 70 coins to a man who came from far away and said "
            "that nothing in the whole wide valley had ever cost him more than those 70 coins did")
    w = item.split()
    docs = [
        (1, "Before. " + " ".join(w[:17]) + " then quite other words follow here until there is nothing left of them to tell"),
        (2, " ".join([*w[:20], "really", *w[20:]])), (3, " ".join(w[:20] + w[21:])), (4, "unlike words only, " * 9),
        (5, "long before this a green parrot sang loudly and then there was silence all around"),
        (6, "a green parrot sang badly and then there was nothing but silence all around"),
        (7, " ".join(w).replace("70", "12", 1).replace("70", "31")),
    ]
    items = spark.createDataFrame([(1, item), (2, "A green parrot sang loudly.")], "item_id long, text string")
    found = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (3, 1), (5, 2), (7, 1)}


def test_contamination_of_odd_and_no_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    none = items.limit(0)
    assert decontamination.contaminated(no_docs, items).count() == 0
    assert decontamination.contaminated(odd_docs, none).count() == 0
    assert decontamination.drop_contaminated(odd_docs, none).count() == odd_docs.count()
    assert decontamination.drop_contaminated(odd_docs, items).columns == odd_docs.columns


def test_leaks_in_given_documents(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    docs, items = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    windows = {}
    for r in items.collect():
        w = r.text.split()
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = r.text.split()
        for k in range(len(w) - 7):
            want |= {(r.doc_id, i) for i in windows.get(tuple(w[k : k + 8]), ())}
    assert got >= want and len(got) <= len(want) + 2


def test_every_dealt_operator_has_a_query():
    names = [q.__name__ for q in QUERIES]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(ORACLES) <= set(names)
