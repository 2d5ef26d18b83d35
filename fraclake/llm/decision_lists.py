"""Quality rules learned as a decision list over text statistics.

The statistics are SQL expressions over the text. From labelled documents, sequential covering
learns rules for bad quality: a rule grows by the threshold test with the best information
gain on the growing part, is pruned to the prefix that is best on the pruning part, and the
rows it covers are taken out before the next one. The list is emitted as one conditional
expression in the order of the rules. Everything runs as DataFrame operations: growing reads
counts per feature and bin, a table whose size does not depend on the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import stored

WINDOW = 8
#: The characters that separate words, and those counted as symbols.
BLANKS, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BINS, LEAST_COVER, LEAST_PRECISION, MOST_RULES, MOST_TESTS = 32, 5, 0.9, 16, 4


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words inside windows that occur twice or more; windows are compared by a 64-bit hash."""

    def covered(starts: Column) -> Column:
        n = F.size(starts)
        steps = F.zip_with(F.slice(starts, F.lit(1), n - 1), F.slice(starts, F.lit(2), n - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x)

    def among(codes: Column) -> Column:
        pairs = F.sort_array(F.transform(codes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _let(pairs, lambda s: F.filter(s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])))
        return _let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    codes = _let(hashes, lambda h: F.when(F.size(h) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW))))))
    return _let(codes, lambda c: F.when(c.isNull() | (F.size(F.array_distinct(c)) == F.size(c)), F.lit(0)).otherwise(among(c)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text, all bigint; a null or empty text has zeros."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    of_words = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).alias("n_distinct_words")))
    of_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    found = docs.select("doc_id", of_words.alias("a"), of_lines.alias("b"), (F.length(text) - _count(text, BLANKS)).alias("word_chars"),
                        _count(text, SYMBOLS).alias("n_symbols"), _count(text, UPPER).alias("n_upper"), _count(text, "!?").alias("n_marks"))
    return found.select("doc_id", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in (
        "a.n_words", "word_chars", "n_symbols", "b.n_dup_lines", "a.n_repeat_words", "b.n_lines", "a.n_distinct_words", "n_upper", "n_marks")])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What the rules may test; each is a quotient of statistics."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {"words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / words, "symbols_per_word": F.col("n_symbols") / words,
            "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), "repeat_share": F.col("n_repeat_words") / words,
            "distinct_share": F.col("n_distinct_words") / words, "upper_share": F.col("n_upper") / chars, "marks_per_word": F.col("n_marks") / words,
            "words_per_line": F.col("n_words") / F.greatest("n_lines", F.lit(1))}


@dataclass(frozen=True)
class Test:
    """``feature`` at or above its threshold number ``bin``, or below it."""

    feature: int
    bin: int
    above: bool

    def on_bins(self) -> Column:
        value = F.col("bins")[self.feature]
        return value >= self.bin if self.above else value < self.bin


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _thresholds(labelled: DataFrame) -> list[list[float]]:
    """Quantiles of each feature among bad and among all labelled rows."""
    shares = [k / BINS for k in range(1, BINS)]
    found = features()
    picked = labelled.select("bad", *[c.alias(n) for n, c in found.items()])
    row = picked.agg(*[F.percentile_approx(F.when(F.col("bad"), F.col(n)), shares, 10000).alias(f"bad_{n}") for n in found],
                     *[F.percentile_approx(n, shares, 10000).alias(n) for n in found]).first()
    return [sorted({*(row[n] or []), *(row[f"bad_{n}"] or [])}) for n in found]


def _reached(value: Column, cuts: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: value >= t)) if cuts else F.lit(0)


def learn(labelled: DataFrame) -> list[list[tuple[str, str, float]]]:
    """Rules for bad rows, in order: lists of (feature, ">=" or "<", threshold).

    ``labelled`` has doc_id, the statistics and a boolean ``bad``. A third of the rows, by a
    hash of doc_id, is for pruning. Learning ends when a rule would cover too little or would
    not be right often enough on both parts.
    """
    names = list(features())
    cuts = _thresholds(labelled)
    bins = [_reached(v, c) for v, c in zip(features().values(), cuts)]
    rest = stored(labelled.select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grows"), F.array(*bins).alias("bins")), "binned")
    rules: list[list[Test]] = []
    covered = F.lit(False)
    while len(rules) < MOST_RULES:
        left = rest.where(~covered)
        rule = _grow(left.where("grows"), cuts)
        if not rule:
            break
        rule, precision, cover = _prune(left, rule)
        if precision < LEAST_PRECISION or cover < LEAST_COVER:
            break
        rules.append(rule)
        covered = covered | _all([t.on_bins() for t in rule])
    return [[(names[t.feature], ">=" if t.above else "<", cuts[t.feature][t.bin - 1]) for t in rule] for rule in rules]


def _grow(rows: DataFrame, cuts: list[list[float]]) -> list[Test]:
    rule: list[Test] = []
    while len(rule) < MOST_TESTS:
        inside = rows.where(_all([t.on_bins() for t in rule]))
        counts = (inside.select("bad", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin")
                  .agg(F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")).collect())
        table = [[[0, 0] for _ in range(len(c) + 1)] for c in cuts]
        for r in counts:
            table[r.feature][r.bin] = [r.p, r.n]
        p0, n0 = (sum(x[k] for x in table[0]) for k in (0, 1))
        if not p0 or not n0:
            break
        best, gain = None, 0.0
        for f, column in enumerate(table):
            p, n = p0, n0
            for b in range(1, len(column)):
                p, n = p - column[b - 1][0], n - column[b - 1][1]
                for above, (x, y) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                    g = x * (math.log2(x / (x + y)) - math.log2(p0 / (p0 + n0))) if x else 0.0
                    if g > gain + 1e-9:
                        best, gain = Test(f, b, above), g
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(rows: DataFrame, rule: list[Test]) -> tuple[list[Test], float, int]:
    """The best prefix on the pruning rows, its precision and its cover on all rows."""
    sums = []
    for k in range(1, len(rule) + 1):
        fits = _all([t.on_bins() for t in rule[:k]])
        for part, name in ((~F.col("grows"), "prune"), (F.lit(True), "all")):
            for value, label in ((F.col("bad"), "p"), (~F.col("bad"), "n")):
                sums.append(F.count_if(fits & part & value).alias(f"{name}_{label}_{k}"))
    row = rows.agg(*sums).first()

    def worth(k: int) -> float:
        p, n = row[f"prune_p_{k}"], row[f"prune_n_{k}"]
        return (p - n) / (p + n) if p + n else -1.0

    best = max(range(1, len(rule) + 1), key=lambda k: (worth(k), row[f"all_p_{k}"]))
    p, n = row[f"all_p_{best}"], row[f"all_n_{best}"]
    pruned = row[f"prune_p_{best}"], row[f"prune_n_{best}"]
    precision = min(p / max(1, p + n), pruned[0] / sum(pruned) if sum(pruned) else 1.0)
    return rule[:best], precision, p


def expression(rules: list[list[tuple[str, str, float]]]) -> Column:
    """The number of the first rule that fires, from 1; 0 if none does."""
    found = features()
    out = None
    for k, rule in enumerate(rules, 1):
        fires = _all([found[f] >= F.lit(t) if op == ">=" else found[f] < F.lit(t) for f, op, t in rule])
        out = F.when(fires, F.lit(k)) if out is None else out.when(fires, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The statistics of each row of (doc_id, text), base_failed, rule and kept.

    ``kept`` is false where the base fails or a rule fires. A document with conflicting labels
    is not bad; null labels and labels of unknown documents are left out; without labels there
    are no rules. Repeated rows get equal verdicts; other columns are not looked at.
    """
    found = stored(statistics(docs.select("doc_id", "text")), "statistics")
    bad = labels.where("quality is not null").groupBy("doc_id").agg((F.max("quality") == 0).alias("bad"))
    labelled = found.where(~base_failed()).join(bad, "doc_id")
    rules = learn(stored(labelled, "labelled-statistics"))
    rule = expression(rules).alias("rule")
    out = found.withColumn("base_failed", base_failed()).withColumn("rule", rule)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*first, *[c for c in out.columns if c not in first])
