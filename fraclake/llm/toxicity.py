"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased runs of letters, and a vector holds every term of its text. A term's
weight is (1 + log tf) times its idf times its relevance: 1 for most terms, more for those
that toxic training documents hold significantly more often (near copies counted once). The
idf counts all training documents for every term of the examples; a term that no example holds
counts as held by one document and has relevance 1, so what a task needs to know of terms is
bounded by the examples. A bounded sample of labelled documents is
indexed: postings per term, examples in blocks, and per term and block the largest weight. A
query adds up those bounds per block, reads blocks from the highest bound on, and stops when no
block left can reach the k-th best cosine; so the k nearest are exact. Votes are weighted by
1 / (distance + c), and a monotone curve fitted on other training documents turns the vote
into a probability. Texts that share no term with an example have the training share of such
texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import by_text, small_side, stored
from fraclake.llm.language import held_out
from fraclake.llm.near_duplicates import shingle_sets
from fraclake.llm.words import LETTERS, words

EXAMPLES, CALIBRATION = 4000, 4000
NEIGHBOURS, BLOCK = 15, 64
#: What a unit of log odds adds to a term's relevance, and the standard errors taken off first.
RELEVANCE, ERRORS = 10.0, 3.0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of training documents; conflicting labels count as toxic."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    return docs.where(~held_out()).join(small_side(stored(known, "toxic-labels")), "doc_id").select("doc_id", F.lower("text").alias("text"), "toxic")


def least_shingle(column: pa.Array) -> pa.Array:
    """The smallest shingle hash of each text, which near copies mostly share."""
    shingles, first = shingle_sets(column)
    full = np.diff(first) > 0
    out = np.zeros(len(column), np.uint64)
    out[full] = shingles[first[:-1][full]]
    return pa.array(out.view(np.int64))


def with_first(train: DataFrame) -> DataFrame:
    """Training documents with ``first``, 1 for one of each group of near copies and else 0:
    otherwise every word of a text that was copied often would look significant."""
    keyed = stored(train.select("doc_id", "toxic", by_text(least_shingle, "bigint")("text").alias("key")), "least-shingles")
    chosen = keyed.groupBy("toxic", "key").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic", F.lit(1).alias("first"))
    return train.join(small_side(stored(chosen, "chosen-copies")), ["doc_id", "toxic"], "left").withColumn("first", F.coalesce("first", F.lit(0)))


@dataclass
class Terms:
    """Hashes of the examples' terms, sorted, with idf times relevance; and the idf of all other terms."""

    hashes: np.ndarray
    idf: np.ndarray
    rare: float

    def weights(self, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The unit TF-IDF vector of a text with these terms."""
        idf = np.full(len(terms), self.rare)
        at, known = places(self.hashes, terms)
        idf[known] = self.idf[at]
        out = (1 + np.log(times)) * idf
        return out / max(1e-12, np.sqrt((out**2).sum()))

    def vectors(self, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Vectors of lower-cased texts as (hashes of terms ascending, weights)."""
        return [(terms, self.weights(terms, times)) for terms, times in term_counts(column)]


def term_counts(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct terms of each lower-cased text, and how often it holds them."""
    found = words(column, LETTERS)
    return [np.unique(found.hash[lo:hi], return_counts=True) for lo, hi in zip(found.row, found.row[1:])]


def drawn_entry(column: pa.Array) -> pa.Array:
    found = term_counts(column)
    terms, times = [t.view(np.int64) for t, _ in found], [n.astype(np.int32) for _, n in found]
    return pa.StructArray.from_arrays([pa.array(terms, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))], names=["t", "n"])


def weighed(train: DataFrame, n: int, wanted: np.ndarray) -> Terms:
    """The terms ``wanted`` (ascending), weighed by all ``n`` training documents of both labels."""

    def held(column: pa.Array) -> pa.Array:
        found = words(column, LETTERS)
        sets = [wanted[places(wanted, np.unique(found.hash[lo:hi]))[0]] for lo, hi in zip(found.row, found.row[1:])]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, wanted[:0]]).view(np.int64)))

    marked = with_first(train)
    totals = marked.agg(F.sum(F.col("first") * F.col("toxic")).alias("toxic"), F.sum(F.col("first") * (1 - F.col("toxic"))).alias("clean")).first()
    terms = marked.select("toxic", "first", F.explode(by_text(held, "array<bigint>")("text")).alias("term"))
    counts = terms.groupBy("term").agg(F.count("*").alias("df"), F.sum(F.col("first") * F.col("toxic")).alias("a"), F.sum(F.col("first")).alias("of")).where("df > 1")
    a, c = F.col("a") + 0.5, F.col("of") - F.col("a") + 0.5
    odds = F.log(a / (totals.toxic + 1)) - F.log(c / (totals.clean + 1)) - ERRORS * F.sqrt(1 / a + 1 / c)
    weight = (F.log((n + 1) / (F.col("df") + 1)) + 1) * (1 + RELEVANCE * F.greatest(odds, F.lit(0.0)))
    got = counts.select("term", weight.alias("weight")).toArrow()
    hashes = got["term"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Terms(hashes[order], got["weight"].to_numpy()[order], float(np.log((n + 1) / 2) + 1))


def places(listed: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``listed`` (ascending) those of ``wanted`` stand that are in it, and which these are."""
    if not len(listed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)
    known = np.flatnonzero(listed[at] == wanted)
    return at[known], known


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of some ranges one after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - ends + size, size)


def joined(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The values in some ranges one after another."""
    return np.concatenate([values[lo:hi] for lo, hi in zip(begin.tolist(), end.tolist())])


class BlockMaxIndex:
    """Postings of the examples' vectors, with the largest weight per term and block.

    A cell is a pair of term and block that has postings.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> None:
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK) or 1
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        doc = np.repeat(np.arange(self.size), np.array([len(t) for t, _ in vectors], np.int64))
        order = np.lexsort((doc, term))
        self.doc = doc[order]
        self.weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])[order]
        cell, first = np.unique(term[order] * self.blocks + self.doc // BLOCK, return_index=True)
        # where the postings of a cell begin, and the cells of a term
        self.begin = np.append(first, len(order))
        self.cells = np.searchsorted(cell, np.arange(terms + 1) * self.blocks)
        self.block = cell % self.blocks
        self.bound = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best (cosine, example) with a cosine above 0; ties go to the smaller example.

        Blocks are read in the order of their bounds, each time twice as many as before. Where
        most blocks may hold one of the k, all postings are read in one go.
        """
        if not len(terms):
            return []
        lo, hi = self.cells[terms], self.cells[terms + 1]
        weight, cells = np.repeat(weights, hi - lo), ranges(lo, hi - lo)
        block = self.block[cells]
        bounds = np.bincount(block, weight * self.bound[cells], minlength=self.blocks)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        place = np.full(self.blocks, self.blocks)
        place[order] = np.arange(len(order))
        turn = place[block]
        cosines, examples, at, step = np.zeros(0), np.zeros(0, np.int64), 0, 4
        while at < len(order) and (len(cosines) < k or bounds[order[at]] >= cosines[-1] - 1e-9):
            if at and (len(cosines) < k or 2 * (bounds[order[at:]] >= cosines[-1] - 1e-9).sum() > self.blocks):
                (examples, cosines), at = self._all(terms, weights), len(order)
            else:
                now = np.flatnonzero((turn >= at) & (turn < at + step))
                found, scores = self._cosines(cells[now], weight[now])
                cosines, examples = np.append(cosines, scores), np.append(examples, found)
                at, step = at + step, 2 * step
            if len(cosines) > k:  # most are far from the best, and sorting them all is slow
                least = np.partition(cosines, len(cosines) - k)[len(cosines) - k] - 1e-8
                cosines, examples = cosines[cosines >= least], examples[cosines >= least]
            best = np.lexsort((examples, -np.round(cosines, 9)))[:k]
            cosines, examples = cosines[best], examples[best]
        return list(zip(cosines.tolist(), examples.tolist()))

    def _cosines(self, cells: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The examples with postings in some cells, and their cosines; a weight for each cell."""
        begin, size = self.begin[cells], self.begin[cells + 1] - self.begin[cells]
        posting = ranges(begin, size)
        cosines = np.bincount(self.doc[posting], np.repeat(weights, size) * self.weight[posting], minlength=self.size)
        found = np.flatnonzero(cosines)
        return found, cosines[found]

    def _all(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All examples that share a term, and their cosines."""
        lo, hi = self.begin[self.cells[terms]], self.begin[self.cells[terms + 1]]
        cosines = np.bincount(joined(self.doc, lo, hi), np.repeat(weights, hi - lo) * joined(self.weight, lo, hi), minlength=self.size)
        found = np.flatnonzero(cosines)
        return found, cosines[found]


@dataclass
class Model:
    terms: Terms
    #: hashes of the examples' terms, ascending; the index numbers them in this order
    known: np.ndarray
    index: BlockMaxIndex
    toxic: np.ndarray
    ids: np.ndarray
    #: votes and their probabilities, both ascending
    curve: tuple[np.ndarray, np.ndarray]
    without_terms: float

    def vote(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float | None, list[tuple[float, int]]]:
        at, known = places(self.known, terms)
        near = self.index.nearest(at, weights[known], NEIGHBOURS)
        if not near:
            return None, near
        pull = np.array([1 / (1 - min(1.0, c) + 0.05) for c, _ in near])
        return float(pull @ self.toxic[[i for _, i in near]] / pull.sum()), near

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, list[int]]:
        vote, near = self.vote(terms, weights)
        if vote is None:
            return self.without_terms, []
        return float(np.interp(vote, *self.curve)), [int(self.ids[i]) for _, i in near]


def monotone(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A rising curve through smoothed shares of equal-sized groups of votes (pooled where they fall).

    Two votes of weight 1 are added, a clean one of 0 and a toxic one of 1, so that the curve
    is made alike from any number of votes.
    """
    votes, labels, weights = np.append(votes, [0.0, 1.0]), np.append(labels, [0.0, 1.0]), np.append(weights, [1.0, 1.0])
    order = np.lexsort((labels, votes))
    pools: list[list[float]] = []
    for part in np.array_split(order, max(2, min(20, len(order) // 5))):
        w = weights[part]
        pools.append([w @ votes[part], w @ labels[part], w.sum()])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    share = weights @ labels / weights.sum()
    return np.array([p[0] / p[2] for p in pools]), np.array([(p[1] + share) / (p[2] + 1) for p in pools])


def trained(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, or None where training documents of one of the two labels are missing.

    Examples and calibration documents are drawn by hash of doc_id, toxic ones with a share of
    their own, and are the first EXAMPLES and CALIBRATION by that hash. Calibration documents
    count as many times as there are training documents of their label for one that was drawn.
    """
    train = labelled(docs, labels)
    toxic, n = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)).cast("long"), F.count("*")).first()
    if not toxic or toxic == n:
        return None
    total = EXAMPLES + CALIBRATION
    shares = {1: min(1.0, total / 2 / toxic), 0: min(1.0, total / 2 / (n - toxic))}
    chance = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 30))
    limit = F.when(F.col("toxic") == 1, int(shares[1] * (1 << 30))).otherwise(int(shares[0] * (1 << 30)))
    drawn = train.where(chance < limit).select("doc_id", "toxic", chance.alias("chance"), by_text(drawn_entry, "struct<t:array<bigint>,n:array<int>>")("text").alias("v"))
    got = drawn.limit(2 * total).toArrow().combine_chunks()
    ids, ys, chances, v = got["doc_id"].to_pylist(), got["toxic"].to_pylist(), got["chance"].to_pylist(), pa.chunked_array(got["v"]).combine_chunks()
    t, times = v.field("t"), v.field("n")
    del got
    rows = sorted(range(len(ids)), key=lambda i: (chances[i], ids[i], ys[i]))
    # a hash independent of the chance deals the rows to the index and to calibration
    pick = [hash_of(ids[i]) for i in rows]
    examples = [i for i, p in zip(rows, pick) if p % 3][:EXAMPLES]
    others = [i for i, p in zip(rows, pick) if p % 3 == 0][:CALIBRATION]
    examples = [i for i in examples if len(t[i].values)]

    def held(i: int) -> np.ndarray:
        return t[i].values.to_numpy().view(np.uint64)

    known, texts = np.unique(np.concatenate([np.zeros(0, np.uint64), *(held(i) for i in examples)]), return_counts=True)
    terms = weighed(train, n, known)

    def vector(i: int) -> tuple[np.ndarray, np.ndarray]:
        return held(i), terms.weights(held(i), times[i].values.to_numpy())

    vectors = {i: (np.searchsorted(known, held(i)), vector(i)[1]) for i in examples}
    # examples with like strongest shared terms stand together, so that blocks differ in their bounds
    shared = texts >= BLOCK // 8
    order = sorted(examples, key=lambda i: (vectors[i][0][np.argmax(vectors[i][1] * shared[vectors[i][0]])], ids[i]))
    index = BlockMaxIndex([vectors[i] for i in order], len(known))
    del vectors
    model = Model(terms, known, index, np.array([float(ys[i]) for i in order]), np.array([ids[i] for i in order]), (np.array([0.0, 1.0]), np.array([0.0, 1.0])), toxic / n)
    votes = [(model.vote(*vector(i))[0], ys[i]) for i in others]
    # undo the drawing shares: a sampled clean document stands for more than a toxic one
    weight = {k: 1 / s for k, s in shares.items()}
    empty = {k: sum(weight[k] for v, y in votes if v is None and y == k) for k in (0, 1)}
    model.without_terms = (empty[1] + toxic / n) / (empty[0] + empty[1] + 1)
    votes = [(v, y) for v, y in votes if v is not None]
    model.curve = monotone(np.array([v for v, _ in votes]), np.array([float(y) for _, y in votes]), np.array([weight[y] for _, y in votes]))
    return model


def hash_of(doc_id: int | None) -> int:
    from fraclake.llm.words import mix

    return int(mix(np.array([doc_id or 0], np.int64).view(np.uint64))[0] >> np.uint64(8))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for each row of (doc_id, text).

    ``evidence`` holds the doc_ids of the nearest examples. Learns from labelled rows that are
    not held out; without examples of both labels every score is 0. Null and empty texts have
    no terms. A null doc_id is not held out and is no example. Repeated rows score alike.
    """
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    model = trained(docs, labels)

    def score(column: pa.Array) -> pa.Array:
        found = [(0.0, [])] * len(column) if model is None else [model.score(t, w) for t, w in model.terms.vectors(column)]
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))], names=["score", "evidence"])

    out = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), by_text(score, "struct<score:double,evidence:array<bigint>>")(F.lower("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.score", (F.col("p.score") >= 0.5).cast("int").alias("predicted"), "p.evidence")
