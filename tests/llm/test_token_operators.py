"""Token counts, token files and packing against the libraries themselves."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from twinshelf.llm import packing, token_counts, token_files
from twinshelf.llm.encoding import Encoder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def of_library(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_counts_equal_the_library(odd_docs, odd_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = Counter(tuple(r) for r in token_counts.count_tokens(odd_docs, PIECES, table_size=20).collect())
    want = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in odd_rows)
    assert got == want


def test_counts_of_no_rows(no_docs):
    assert token_counts.count_tokens(no_docs, PIECES).count() == 0


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_SIZE", 2)
    library = token_counts.load_model(PIECES)
    cache = token_counts.WorkerCache({"the": len(library.encode("the"))}, library)
    for text in ("the cat sat on the mat  twice", "▁a  b ", " ", "x" * 100):
        assert sum(map(cache.__getitem__, token_counts.pre_tokens(text))) == len(library.encode(text))
    assert len(cache) <= 3


@pytest.mark.parametrize("path", [BYTES, WORD])
def test_cached_ids_equal_the_library(path):
    pick, own, library = random.Random(5), Encoder(path), Tokenizer.from_file(path)
    letters = "aAbÉéçßÿŸ '’\"!?.,;:-_0129²¾½ \t\n\r\x0b\x0c\xa0\x85\x1c\x1fµªºſĲŉ…—“<|>İıΣяこ中​ 'sll"
    for k in range(4000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 14)))
        if k % 50 == 0:
            text += "<|endoftext|>" + text
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_files_hold_every_document_in_order(spark, odd_docs, odd_rows):
    manifest = token_files.write_files(odd_docs, WORD, 1, length=64)
    got = sorted(tuple(r) for r in token_files.read_files(spark, manifest).collect())
    want, start = [], 0
    for r in sorted(odd_rows, key=lambda r: r[0]):
        ids = np.array([*of_library(WORD, r[1] or ""), 1], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want)
    used = 0
    for row in manifest.collect():
        file = pa.ipc.open_file(pa.memory_map(row.file.removeprefix("file:").replace("//", "/")))
        for k in range(file.num_record_batches):
            batch = file.get_batch(k)
            assert batch.schema.field("ids").type.list_size == 64
            used += int(np.sum(batch.column(1).flatten().to_numpy(zero_copy_only=False)))
    assert used == start


def test_files_of_no_rows(spark, no_docs):
    assert token_files.read_files(spark, token_files.write_files(no_docs, WORD, 1)).count() == 0


def check_packed(rows, texts, size):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, pieces in by_doc.items():
        ids = [*of_library(BYTES, texts[doc] or ""), 0]
        for n, copies in Counter((p.piece, p.start, p.length) for p in pieces).items():
            assert copies == Counter((p.piece, p.start, p.length) for p in pieces)[min((p.piece, p.start, p.length) for p in pieces)]
        single = {p.piece: p for p in pieces}
        joined = b"".join(single[k].ids for k in sorted(single))
        assert np.frombuffer(joined, "<u4").tolist() == ids
        assert all(single[k].length == size for k in sorted(single)[1:])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size


def test_packing_is_whole_and_gapless(odd_docs, odd_rows):
    rows = packing.pack(odd_docs, BYTES, end_id=0, size=256).collect()
    texts = {r[0]: r[1] for r in odd_rows}
    assert {r.doc_id for r in rows} == set(texts)
    check_packed(rows, texts, 256)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 256) + 1


def test_packing_of_no_rows(no_docs):
    assert packing.pack(no_docs, BYTES, end_id=0).count() == 0


def fewest(items, size):
    """Optimal number of bins by exhaustive search."""
    best = len(items)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= items[k]:
                rest = list(rooms)
                rest[rest.index(room)] -= items[k]
                place(k + 1, rest)
        place(k + 1, [*rooms, size - items[k]])

    place(0, [])
    return best


def test_completion_is_optimal_on_small_cases():
    pick = random.Random(7)
    for _ in range(150):
        size = pick.choice([10, 17, 30])
        items = sorted((pick.randint(1, size) for _ in range(pick.randint(1, 9))), reverse=True)
        plan = packing.complete(dict(Counter(items)), size)
        assert Counter(x for c, n in plan for x in c * n) == Counter(items)
        assert all(sum(c) <= size for c, _ in plan)
        assert sum(n for _, n in plan) == fewest(items, size)


def test_best_fit_uses_every_item():
    pick = random.Random(8)
    counts = Counter(pick.randint(1, 2047) for _ in range(20_000))
    plan = packing.best_fit(counts, 2048)
    assert Counter({x: n for x, n in counts.items()}) == sum((Counter({x: k * n for x, k in Counter(c).items()}) for c, n in plan), Counter())
