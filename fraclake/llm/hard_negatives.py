"""Hard negatives by anchor clusters that share one sorted list of candidates.

Anchors are clustered by direction. For a cluster, a candidate's inner product with any member
of length 1 is at most |q| cos(max(0, angle to the centre - the cluster's radius)). A task sorts its
candidates by that bound once for a cluster, and every member walks this one list until the
bound shows that no candidate further down can be among its best: the result is certified exact.

The list is walked in two parts. Its head, the candidates with the largest bounds (above a
quantile read off a bounded sample), is walked first in all tasks; the best scores found there
are thresholds for the rest, where most members then stop early and little is sent on. Positives
come first, since their scores set the windows in which negatives count.

Anchors are taken in blocks of bounded size, and each block is held against all candidates:
only a block, its thresholds and the centres are ever on the driver or in each task. Candidates
stay where they are; only best lists are shuffled, at most K rows for a task, anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraclake.llm.frames import stored
from fraclake.llm.whitening import integers, matrix

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Negatives' scores in hundredths of the positive's.
LEAST, MOST = 30, 90
#: Anchors in a block, anchors and candidates in a sample, clusters in all, and the head's share of a list.
BLOCK, SAMPLE, CLUSTERS, HEAD = 8192, 4096, 64, 0.05
#: Candidates that are scored at once at first, and rows that are sorted at once.
STEP, ROWS = 256, 8192
NONE = np.iinfo(np.int64).min
#: Scores and a place among ROWS are packed into one long.
LARGEST = 2.0**49


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of zeros stay."""
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(1, keepdims=True))
    return vectors / np.where(lengths > 0, lengths, 1.0)


def centres(sample: np.ndarray, count: int, turns: int = 8) -> np.ndarray:
    """Directions of clusters of ``sample`` by spherical k-means from evenly dealt rows."""
    rows = unit(sample)
    out = rows[np.linspace(0, len(rows) - 1, count).astype(int)]
    for _ in range(turns):
        of = np.argmax(rows @ out.T, 1)
        sums = np.zeros_like(out)
        np.add.at(sums, of, rows)
        out = np.where((sums**2).sum(1, keepdims=True) > 1e-12, unit(sums), out)
    return out


@dataclass
class Cluster:
    """Anchors of one cluster: centre, radius, members with what bounds their answers.

    ``low`` and ``high`` are one column for each answer (a window of scores), ``floor`` the
    K-th best score known so far of each.
    """

    centre: np.ndarray
    radius: float
    cut: float
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray

    def bounds(self, candidates: np.ndarray) -> np.ndarray:
        """For each candidate what no inner product with a member of length 1 exceeds."""
        lengths = np.sqrt((candidates.astype(float) ** 2).sum(1))
        # summed row by row, so that a candidate's bound is the same in whatever batch it comes
        cosine = np.clip((unit(candidates) * self.centre).sum(1), -1.0, 1.0)
        inside = np.maximum(0.0, np.arccos(cosine) - self.radius - 1e-7)
        return lengths * (np.cos(inside) + 1e-9)


def clusters_of(block: pa.Table, middle: np.ndarray, crowd: np.ndarray, same: bool) -> list[Cluster]:
    """The clusters of a block of anchors; list columns ``low`` and ``high`` hold the windows.

    The head of a cluster's list begins where so few of ``crowd`` have larger bounds.
    """
    ids, labels, of = (block[c].to_numpy() for c in ("vec_id", "label", "cluster"))
    vectors = matrix(block["x"].combine_chunks(), middle.shape[1])
    if same:
        low, high = np.full((len(ids), 1), NONE), np.full((len(ids), 1), np.iinfo(np.int64).max)
    else:
        low, high = (matrix(block[c].combine_chunks(), POSITIVES) for c in ("low", "high"))
    out = []
    for c in np.unique(of):
        at = np.flatnonzero(of == c)
        members = unit(vectors[at])
        angles = np.arccos(np.clip(members[(members**2).sum(1) > 0] @ middle[c], -1.0, 1.0))
        made = Cluster(middle[c], float(angles.max(initial=0)), 0.0, ids[at], labels[at], vectors[at], low[at], high[at], low[at].copy())
        made.cut = float(np.quantile(made.bounds(crowd), 1 - HEAD)) if len(crowd) else 0.0
        out.append(made)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows, exactly."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most >= LARGEST:
        raise OverflowError("vectors too long to be scored exactly")
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64)


def best(keys: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row, falling; missing ones are NONE."""
    if keys.shape[1] < k:
        keys = np.hstack([keys, np.full((len(keys), k - keys.shape[1]), NONE)])
    elif keys.shape[1] > k:
        keys = np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:]
    return -np.sort(-np.maximum(keys, NONE + 1), axis=1)


def walk(cluster: Cluster, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, head: bool, same: bool, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of each member and window among some candidates, in falling order.

    Only candidates of the head, or only those behind it, count. Ids are rising. Scores of
    missing ones are NONE or just above.
    """
    bound = cluster.bounds(x)
    listed = np.argsort(-bound, kind="stable")
    first = int(np.searchsorted(-bound[listed], -cluster.cut, "right"))
    listed = listed[:first] if head else listed[first:]
    lengths = np.sqrt((cluster.vectors.astype(float) ** 2).sum(1))
    windows = cluster.low.shape[1]
    found = np.full((len(cluster.ids), windows, k), NONE + 1)
    floor = cluster.floor.copy()
    active, at, step = np.arange(len(cluster.ids)), 0, STEP
    while at < len(listed):
        # a member whose K-th best of every window is above the bound of all that is left is done
        least = floor[active].min(1)
        active = active[lengths[active] * bound[listed[at]] * (1 + 1e-9) + 1e-6 >= least]
        if not len(active):
            break
        now = listed[at:at + step]
        scores = products(cluster.vectors[active], x[now])
        alike = cluster.labels[active, None] == labels[None, now]
        counts = (alike & (cluster.ids[active, None] != ids[None, now])) if same else ~alike
        keys = scores * ROWS + (ROWS - 1 - now[None, :])
        for w in range(windows):
            fits = counts & (scores >= floor[active, w, None]) & (scores <= cluster.high[active, w, None])
            some = np.flatnonzero(fits.any(1))
            if len(some):
                found[active[some], w] = best(np.hstack([found[active[some], w], np.where(fits[some], keys[some], NONE)]), k)
        last = found[active, :, k - 1]
        floor[active] = np.maximum(floor[active], np.where(last > NONE + 1, last // ROWS, NONE))
        at, step = at + step, 2 * step
    real = found > NONE + 1
    return np.where(real, found // ROWS, NONE), np.where(real, ids[np.where(real, ROWS - 1 - found % ROWS, 0)], 0)


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = np.concatenate([a[0], b[0]], 2), np.concatenate([a[1], b[1]], 2)
    order = np.lexsort((ids, -np.maximum(scores, NONE + 1)), axis=2)[:, :, :k]
    return np.take_along_axis(scores, order, 2), np.take_along_axis(ids, order, 2)


def walked(candidates: DataFrame, clusters: list[Cluster], width: int, head: bool, same: bool, k: int) -> DataFrame:
    """(anchor_id, place, id, score): the best of each task for each anchor and window (``place``)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.full((*c.low.shape, k), NONE), np.zeros((*c.low.shape, k), np.int64)) for c in clusters]
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids, labels, x = part["vec_id"].to_numpy(), part["label"].to_numpy(), matrix(part["x"], width)
                order = np.argsort(ids, kind="stable")
                ids, labels, x = ids[order], labels[order], x[order]
                for i, cluster in enumerate(clusters):
                    last = kept[i][0][:, :, k - 1]
                    kept[i] = merged(kept[i], walk(replace(cluster, floor=np.maximum(cluster.floor, last)), ids, labels, x, head, same, k), k)
        for cluster, (scores, ids) in zip(clusters, kept):
            m, w, j = np.nonzero(scores > NONE)
            yield pa.RecordBatch.from_arrays([pa.array(cluster.ids[m]), pa.array(w.astype(np.int32)), pa.array(ids[m, w, j]), pa.array(scores[m, w, j])],
                                             names=["anchor_id", "place", "id", "score"])

    return candidates.select("vec_id", "label", "x").mapInArrow(task, "anchor_id bigint, place int, id bigint, score bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and window, with their rank."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def searched(candidates: DataFrame, block: pa.Table, middle: np.ndarray, crowd: np.ndarray, same: bool, k: int) -> DataFrame:
    """(anchor_id, place, id, score, rank): the k best of a block's anchors in every window, written.

    ``same`` looks for other rows of the anchor's label, else for rows of other labels.
    """
    clusters = clusters_of(block, middle, crowd, same)
    width = middle.shape[1]
    head = stored(ranked(walked(candidates, clusters, width, True, same, k), k), "head")
    known = head.where(F.col("rank") == k).select("anchor_id", "place", "score").toArrow()  # one row for an anchor of the block and window
    floors = dict(zip(zip(known["anchor_id"].to_pylist(), known["place"].to_pylist()), known["score"].to_pylist()))
    for c in clusters:
        for i, anchor in enumerate(c.ids.tolist()):
            for w in range(c.floor.shape[1]):
                c.floor[i, w] = max(c.floor[i, w], floors.get((anchor, w), NONE))
    rest = walked(candidates, clusters, width, False, same, k)
    return stored(ranked(head.drop("rank").unionByName(rest), k), "searched")


def blocks(anchors: DataFrame, count: int) -> list[DataFrame]:
    """The anchors in blocks of about BLOCK; anchors of a cluster share as few blocks as they can."""
    if count <= BLOCK:
        return [anchors]
    pieces = -(-count // max(1, BLOCK // 4))
    placed = anchors.withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.lit(pieces)))
    sizes = sorted((r.cluster, r.piece, r["count"]) for r in placed.groupBy("cluster", "piece").count().collect())
    groups, room = [], 0
    for c, p, n in sizes:
        if n > room:
            groups.append([])
            room = max(BLOCK, n)
        groups[-1].append((c, p))
        room -= n
    return [placed.where(reduce(lambda a, b: a | b, [(F.col("cluster") == c) & (F.col("piece") == p) for c, p in g])).drop("piece") for g in groups]


def mined(rows: DataFrame, vector: str = "embedding", anchor_every: int = 100, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and the vector. Rows without label or vec_id take no part, nor do
    those whose vector is null or empty, has null or non-finite entries or another length than most.
    Rows that repeat a vec_id are one row: that with the smallest label, then vector. Ties
    go to the smaller vec_id. An anchor without another row of its label, or without rows of
    others in its windows, has no rows in the result. Inner products of 2^49 or more raise an
    OverflowError.
    """
    given = rows.select("vec_id", "label", F.col(f"`{vector}`").alias("vector")).where("vec_id is not null and label is not null")
    sound, width = integers(given, "vector", SCALE, 0)
    moved = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")).cast("long")
    one = sound.groupBy("vec_id").agg(F.min(F.struct(moved.alias("label"), "x")).alias("r"))
    candidates = stored(one.select("vec_id", "r.label", "r.x"), "candidates")
    anchors = candidates.where(F.col("vec_id") % anchor_every == 0)
    count = anchors.count()
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not count:
        return rows.sparkSession.createDataFrame([], out)

    def sample(of: DataFrame, total: int) -> np.ndarray:
        share = min(1.0, SAMPLE / max(1, total))
        drawn = of.where(F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("vec_id", "x").limit(2 * SAMPLE).toArrow()
        order = np.argsort(drawn["vec_id"].to_numpy())
        return matrix(drawn["x"].combine_chunks(), width)[order] if len(order) else np.zeros((0, width), np.int64)

    drawn = sample(anchors, count)
    if not len(drawn):
        drawn = matrix(anchors.limit(1).toArrow()["x"].combine_chunks(), width)
    middle = centres(drawn, min(CLUSTERS, max(1, int(np.sqrt(len(drawn))))))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.argmax(unit(matrix(batch["x"], width)) @ middle.T, 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of)], names=["vec_id", "label", "x", "cluster"])

    placed = stored(anchors.mapInArrow(nearest, "vec_id bigint, label bigint, x array<bigint>, cluster int"), "anchors")
    crowd = sample(candidates, candidates.count())
    answers = []
    for part in blocks(placed, count):
        block = part.toArrow()
        positives = searched(candidates, block, middle, crowd, True, POSITIVES)
        named = positives.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        got = named.toArrow()  # at most POSITIVES rows for each anchor of the block
        low, high = np.full((len(block), POSITIVES), 1), np.full((len(block), POSITIVES), 0)
        row = {a: i for i, a in enumerate(block["vec_id"].to_pylist())}
        for a, p, s in zip(got["anchor_id"].to_pylist(), got["place"].to_pylist(), got["positive_score"].to_pylist()):
            low[row[a], p], high[row[a], p] = -(-LEAST * s // 100), MOST * s // 100
        # an empty window needs no walk
        low = np.where(low > high, np.iinfo(np.int64).max, low)
        lists = [pa.ListArray.from_arrays(np.arange(len(block) + 1, dtype=np.int32) * POSITIVES, pa.array(w.reshape(-1))) for w in (low, high)]
        windowed = block.append_column("low", lists[0]).append_column("high", lists[1])
        negatives = searched(candidates, windowed, middle, crowd, False, NEGATIVES)
        answers.append(negatives.join(named, ["anchor_id", "place"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return reduce(DataFrame.union, answers)


#: The same in DuckDB's SQL; no vec_id may repeat.
SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS alike, list_dot_product(a.x, c.x)::BIGINT AS score
       FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
 p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
       QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND {LEAST} * positive_score <= 100 * score AND 100 * score <= {MOST} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY rank <= {NEGATIVES}
"""
