"""Sketches against brute force, and FASTA reading."""

import gzip
import hashlib
import random

import pytest
import xxhash

from fraclake.functions.hashing import murmur64_bytes
from fraclake.functions.unsigned import signed
from fraclake.operators.sketching import (generated_sketches, kmer_hashes, max_hash_for, sequence_chunks,
                                          word_hashes, word_sketch_arrays)
from fraclake.sources.fasta import read_fasta

SWAP = str.maketrans("ACGT", "TGCA")


def canonical(seq, k):
    seq = seq.upper()
    for i in range(len(seq) - k + 1):
        word = seq[i:i + k]
        if set(word) <= set("ACGT"):
            yield min(word, word.translate(SWAP)[::-1])


def hashed(words, fn):
    words = sorted(set(words))
    if fn == "murmur64":
        return {int(v) for v in murmur64_bytes([w.encode() for w in words])}
    return {int(hashlib.md5(w.encode()).hexdigest()[:16], 16) for w in words}


@pytest.fixture(scope="module")
def genomes():
    rng = random.Random(5)
    seq = "".join(rng.choice("acgtN") if rng.random() < 0.03 else rng.choice("ACGT") for _ in range(2500))
    return [("a", seq), ("b", seq[300:900]), ("b", "ACGT"), ("c", "N" * 50)]


@pytest.mark.parametrize("fn", ["murmur64", "md5_64"])
@pytest.mark.parametrize("scaled", [1, 7])
@pytest.mark.parametrize("chunk", [64, 1 << 16])
def test_kmers_match_brute_force(spark, genomes, fn, scaled, chunk):
    df = spark.createDataFrame(genomes, "file string, seq string")
    got = kmer_hashes(df, ["file"], "seq", (15, 31, 33), scaled, fn, spread=True, chunk=chunk).distinct().collect()
    expected = {(f, k, signed(h)) for f in "abc" for k in (15, 31, 33)
                for h in hashed([w for g, s in genomes if g == f for w in canonical(s, k)], fn)
                if h <= max_hash_for(scaled)}
    assert {(r.file, r.ksize, r.hash) for r in got} == expected


@pytest.mark.parametrize("scaled", [1, 7])
def test_xxhash_matches_the_library(spark, genomes, scaled):
    df = spark.createDataFrame(genomes, "file string, seq string")
    got = kmer_hashes(df, ["file"], "seq", (15, 33), scaled, "xxhash64").where("file = 'a'").distinct().collect()
    expected = {(k, signed(h)) for k in (15, 33) for w in canonical(genomes[0][1], k)
                if (h := xxhash.xxh64(w.encode(), seed=42).intdigest()) <= max_hash_for(scaled)}
    assert {(r.ksize, r.hash) for r in got} == expected and len(got) == len(expected)
    with pytest.raises(ValueError):
        kmer_hashes(df, ["file"], "seq", (15,), 1, "crc")


def test_reverse_complement_gives_the_same_sketch(spark, genomes):
    seq = genomes[0][1].upper()
    df = spark.createDataFrame([("f", seq), ("r", seq.translate(SWAP)[::-1])], "file string, seq string")
    rows = kmer_hashes(df, ["file"], "seq", (31,), 1).distinct().collect()
    assert {r.hash for r in rows if r.file == "f"} == {r.hash for r in rows if r.file == "r"}


def test_chunks_hold_every_kmer_once(spark):
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(1000))
    df = spark.createDataFrame([("x", seq)], "file string, seq string")
    pieces = [bytes(r.piece).decode() for r in sequence_chunks(df, ["file"], "seq", (15,), 100).collect()]
    found = [p[i:i + 15] for p in pieces for i in range(min(100, len(p) - 14))]
    assert sorted(found) == sorted(seq[i:i + 15] for i in range(986))


def test_words_match_brute_force(spark):
    texts = [(1, "a b  c\nd\te f g"), (2, "one two"), (3, ""), (4, "x " * 50)]
    df = spark.createDataFrame(texts, "id int, text string")
    import re

    expected = []
    for i, text in texts:
        words = re.split(r"[ \n\t\r]+", text)
        for k in (2, 4):
            for at in range(len(words) - k + 1):
                h = int(hashlib.md5(" ".join(words[at:at + k]).encode()).hexdigest()[:16], 16)
                if h <= max_hash_for(2):
                    expected.append((i, k, signed(h)))
    got = [(r.id, r.ksize, r.hash) for r in word_hashes(df, ["id"], "text", (2, 4), 2).collect()]
    assert sorted(got) == sorted(expected)
    arrays = word_sketch_arrays(df, ["id"], "text", (2, 4), 2).collect()
    assert sorted((r.id, k, h) for r in arrays for k in (2, 4) for h in r[f"h{k}"]) == sorted(expected)


def test_generated_sketches(spark):
    rows = generated_sketches(spark.range(7), "id", members=2).collect()
    assert rows == [] or all(0 <= r.hash < max_hash_for(1000) for r in rows)
    sizes = {}
    for r in rows:
        sizes[r.archive, r.member, r.ksize] = sizes.get((r.archive, r.member, r.ksize), 0) + 1
    assert sizes == {(i, m, k): 200 + (i + m + k) % 50 for i in range(7) for m in range(2) for k in (15, 31, 33)}
    assert {r.folder for r in rows if r.archive == 4} == {"AAB"}


def test_fasta(spark, tmp_path):
    text = ">one first > record\nACGT\nacgtn\r\n>two\n\nGG\nTT\n>empty\n>last\nA"
    (tmp_path / "plain.fa").write_text(text)
    with gzip.open(tmp_path / "packed.fa.gz", "wt") as f:
        f.write(text)
    rows = read_fasta(spark, str(tmp_path)).collect()
    expected = {("one", "ACGTACGTN"), ("two", "GGTT"), ("last", "A")}
    for name in ("plain.fa", "packed.fa.gz"):
        assert {(r.record_id, r.seq) for r in rows if r.file == name} == expected
