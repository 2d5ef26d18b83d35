import contextlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from brute import TEXTS
from fraclake import shared
from fraclake.llm import bpe, packing, token_counts, training_order, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'", "s", "t", "re", "ll", " ", "  ", "\n", "a", "B", "1", "!", "é", "\t", "<|endoftext|>", "　", "日", "'d", "ve", "\U000105c0", " ", "½"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def mixture(seed, n, longest):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, block):
    monkeypatch.setattr(words, "BLOCK", block)
    texts = TEXTS + mixture(1, 200, 30)
    found = words.words(pa.array(texts), words.NOT_BLANK)
    for row, text in enumerate(texts):
        lo, hi = found.row[row], found.row[row + 1]
        assert [w.decode() for w in found.text(lo, hi - lo)] == brute.WORD.findall(text or "")
    by_word = {}
    for k in range(len(found.hash)):
        by_word.setdefault(found.text(k), set()).add(int(found.hash[k]))
    assert all(len(x) == 1 for x in by_word.values()) and len({x for s in by_word.values() for x in s}) == len(by_word)


def test_encoder_agrees_with_the_library(library):
    texts = mixture(2, 3000, 25) + [t or "" for t in TEXTS]
    found = bpe.Encoder.at(PATH).encode(texts)
    ids = np.split(found.flat(), np.cumsum(found.tokens())[:-1])
    assert all(a.tolist() == library.encode(t, add_special_tokens=False).ids for a, t in zip(ids, texts))


def test_encoder_that_forgets(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(PATH)
    for seed in range(4):
        texts = mixture(seed, 50, 25)
        assert encoder.encode(texts).tokens().tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("chunk,overlap", [(16, 2), (40, 8), (100, 30)])
def test_chunks_resynchronise(library, chunk, overlap):
    encoder = bpe.Encoder.at(PATH)
    for text in mixture(3, 60, 120) + ["x" * 500, "y" * 90 + " " + "z" * 300, "a b " * 100, " " * 300, "\n \n" * 70]:
        assert token_counts.chunked(encoder, text, chunk, overlap) == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_odd_rows(spark, odd, empty, library):
    rows = token_counts.token_counts(odd, PATH, limit=5, chunk=50, overlap=5).collect()
    texts = [r.text or "" for r in odd.collect()]
    expected = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 5) for r in rows)
    assert token_counts.token_counts(empty, PATH).count() == 0


def checked_packing(rows, texts, library, capacity, end):
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        pieces = sorted(by[doc_id], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and sum(p.length for p in pieces) == len(ids)
        assert all(p.length == capacity for p in pieces[1:])
        for p in pieces:
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, documents, library):
    docs = documents.limit(120)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.packed(docs, PATH).collect()
    used = checked_packing(rows, texts, library, 1024, 2)
    assert used <= 1.05 * sum(r.length for r in rows) / 1024 + 3


def test_packing_of_odd_rows_and_small_groups(spark, odd, empty, library):
    rows = packing.packed(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), PATH, capacity=16, end=2, group=3).collect()
    checked_packing(rows, dict(enumerate(TEXTS)), library, 16, 2)
    assert packing.packed(odd, PATH).count() == odd.count() + sum(r.length == 1024 for r in packing.packed(odd, PATH).collect()) - sum(
        r.length == 1024 and r.piece == 0 for r in packing.packed(odd, PATH).collect())
    assert packing.packed(empty, PATH).count() == 0


def test_sum_of_squares_choice():
    lengths = np.random.default_rng(1).integers(1, 65, 400)
    sequence, offset = packing.sum_of_squares(lengths, 64)
    count, bins, needed = [0] * 65, {}, max(-(-lengths.sum() // 64), (2 * lengths > 64).sum())
    for s, q, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        def after(gap):
            trial = count.copy()
            if gap < 64:
                trial[gap] -= 1
            if gap > s:
                trial[gap - s] += 1
            return sum(c * c for c in trial[1:])
        choices = [g for g in range(s, 64) if count[g]] + ([64] if len(bins) < needed or not any(count[s:64]) else [])
        gap = 64 - o
        assert gap in choices and after(gap) == min(map(after, choices))
        if gap < 64:
            count[gap] -= 1
        assert bins.get(q, 64) == gap
        bins[q] = gap - s
        if gap > s:
            count[gap - s] += 1


@pytest.mark.parametrize("total", [1, 2, 3, 17, 64, 1000, 4097])
def test_feistel_is_a_permutation(total):
    slots = training_order.permuted(np.arange(total), total, 5)
    assert sorted(slots.tolist()) == list(range(total))
    if total > 100:
        assert slots.tolist() != training_order.permuted(np.arange(total), total, 6).tolist()


def test_training_order_round_trip(spark, odd, empty, library, tmp_path):
    root = f"file://{tmp_path}/shards"
    total = training_order.materialised(odd, PATH, root, length=8, rows=16, waves=3)
    rows = training_order.read(spark, root, total, length=8, rows=16).collect()
    assert sorted(r.slot for r in rows) == list(range(total))
    whole = {}
    for r in rows:
        whole.setdefault(r.doc_id, {}).setdefault(r.piece, []).append(bytes(r.ids))
    for doc_id, text in enumerate(TEXTS):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [50256], "<u2").tobytes()
        assert b"".join(v[0] for _, v in sorted(whole[doc_id].items())) == ids
    part = training_order.read(spark, root, total, first=5, last=40, length=8, rows=16).collect()
    assert sorted(part) == sorted(r for r in rows if 5 <= r.slot < 40)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "shards").glob("*.bin")}
    assert len(stamps) == -(-total // 16)
    training_order.materialised(odd, PATH, root, length=8, rows=16, waves=2)
    assert stamps == {p: p.stat().st_mtime_ns for p in (tmp_path / "shards").glob("*.bin")}
    with pytest.raises(ValueError, match="other"):  # shards of another order are not taken for these
        training_order.materialised(odd, PATH, root, length=8, rows=16, waves=2, key=5)
    with pytest.raises(ValueError, match="other"):
        training_order.materialised(odd.withColumn("text", F.concat(F.lit("a "), "text")), PATH, root, length=8, rows=16)
    assert training_order.materialised(empty, PATH, f"file://{tmp_path}/none") == 0


def test_waves_hold_their_slots_and_leave_nothing(spark, odd, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(training_order, "shared_folder", lambda spark, label: made.append(f"{tmp_path}/{label}") or made[-1])
    monkeypatch.setattr(training_order, "passing", lambda spark: contextlib.nullcontext(made))
    pool, total = training_order.numbered(odd, PATH, 8, 50256)
    folder = training_order.in_waves(pool, total, 5, 16, 2)
    rows = spark.read.parquet(folder).select("slot", "shard", "wave").collect()
    assert sorted(r.slot for r in rows) == list(range(total))
    assert all(r.shard == r.slot // 16 and r.wave == r.slot // 32 for r in rows)
    assert training_order.content(spark, folder) == pool.agg(F.bit_xor(F.xxhash64("index", "doc_id", "piece", "ids"))).first()[0]


def test_intermediate_folders_go_with_their_waves(spark, odd, tmp_path):
    before = len(shared._folders)
    training_order.materialised(odd, PATH, f"file://{tmp_path}/shards", length=8, rows=16, waves=3)
    left, = shared._folders[before:]  # the first pool is gone, and of the second only an empty folder is left
    assert "/waves-" in left and not [n for n in shared.entries(spark, left) if n.startswith("wave=")]
