"""Toxic passages as maximum-scoring segments of token log-odds.

Learning. The distinct words of labelled training texts are counted per class (a word repeated in one text is one
observation), then summed over units: the word itself and its
character 4- and 5-grams (compounds share them). A unit's score is its log-odds between the classes under an
informative Dirichlet prior (the units' overall shares, plus 1/2), less one standard deviation; only units are
kept whose likelihood-ratio statistic exceeds what chance gives among as many units. A word scores as its best unit,
any other word a small negative constant: the log-ratio of both classes' shares of such words.

Scoring. One linear scan per text cuts it into candidate stretches, in which a word scores once, and finds all maximal
scoring segments of these. Their scores follow an extreme-value law:
with lambda and K from the clean class, ``K n exp(-lambda S)`` segments as good are expected by chance in n
tokens. A text's evidence is the sum of ``lambda S - ln(K n)`` over its significant passages; a logistic curve fitted
on the training texts turns it into a probability.

The labelled sample is bounded (``max_labelled``, drawn by hash), and so are lexicon and label broadcasts. Texts
are read whole, each in one task, without any shuffle of text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, free, text_or_empty

#: Labelled rows used for learning at most (in expectation): 12 bytes each in a broadcast.
MAX_LABELLED = 200_000
#: Strength of the Dirichlet prior in tokens.
PRIOR = 1000.0
#: A unit's log-odds, less a standard deviation: below this it says more about language or topic than toxicity.
LEAST_SCORE = 2.0
#: A passage counts as toxic if fewer than this many as good are expected in a clean text of its length.
SIGNIFICANCE = 0.05
#: Up to so many rejected keys are sent to every executor; more are shuffled.
BROADCAST_KEYS = 500_000
#: A worker forgets its word scores beyond so many words.
CACHE = 100_000
WORD = re.compile(r"\w+")


@dataclass
class Lexicon:
    units: dict[str, float]
    other: float
    rate: float  # lambda of the extreme-value law


def units_of(word: str) -> list[str]:
    """The word (marked) and its 4- and 5-grams."""
    grams = {word[i : i + n] for n in (4, 5) for i in range(len(word) - n + 1)}
    return [f"={word}", *grams]


def segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score), left to right.

    ``hits`` are (position, positive score); every token between them scores ``other`` < 0. Linear time: each
    segment keeps the running sums before its start and at its end, and links to the nearest one to the left with a
    smaller sum before it.
    """
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at end, place of the linked one
    total, last = 0.0, -1
    for at, score in hits:
        total += other * (at - last - 1)
        start, before = at, total
        total += score
        last = at
        end_sum = total
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= end_sum:
                found.append((start, at, before, end_sum, j))
                break
            # The earlier segment begins lower and ends lower: both and all between become one.
            start, _, before, _, link = found[j]
            del found[j:]
            j = link
    return [(a, b, high - low) for a, b, low, high, _ in found]


class _Scores(dict):
    """Scores of words, worked out once per worker."""

    def __init__(self, units: dict[str, float]):
        super().__init__()
        self.units = units

    def __missing__(self, word: str) -> float:
        if len(self) > CACHE:
            self.clear()
        best = max((self.units.get(u, 0.0) for u in units_of(word)), default=0.0)
        self[word] = best
        return best


def candidates(words: list[str], scores: dict[str, float], other: float) -> Iterator[list[tuple[int, float]]]:
    """Hits (position, score) of each stretch of the text that may hold passages, a word once in each.

    A stretch ends where its sum falls to zero, and before a word it has had already if that word alone outweighs less
    than what was lost since the last hit, so that it begins a passage of its own. Any other repeat counts as filler.
    """
    hits: list[tuple[int, float]] = []
    seen: set[str] = set()
    total = 0.0  # at the last hit
    for i, w in enumerate(words):
        if not (s := scores[w]):
            continue
        lost = -other * (i - hits[-1][0] - 1) if hits else 0.0
        if hits and (total <= lost or (w in seen and lost >= s)):
            yield hits
            hits, seen, total, lost = [], set(), 0.0, 0.0
        if w not in seen:
            seen.add(w)
            hits.append((i, s))
            total += s - lost
    if hits:
        yield hits


def scan_text(text: str, scores: dict[str, float], other: float) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of words and maximal segments; inside a segment a word scores once, as it does per text in learning."""
    words = WORD.findall(text.lower())
    return len(words), [x for hits in candidates(words, scores, other) for x in segments(hits, other)]


def held_out(key: Column) -> Column:
    """Whether a row is kept for testing: the key's text has crc32 2 modulo 4; a null key counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_labels(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic) of training rows, one per key and per distinct text, at most about ``max_labelled``."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = one.count()
    if n > max_labelled:
        one = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * max_labelled / n))
    texts = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("_h")).join(F.broadcast(one), "doc_id")
    return texts.groupBy("_h").agg(F.min(F.struct("doc_id", "toxic")).alias("s")).select("s.*").distinct()


def learn(docs: DataFrame, training: DataFrame) -> Lexicon:
    """The lexicon from ``training`` (doc_id, toxic), which is bounded."""
    chosen = docs.select("doc_id", F.lower(text_or_empty()).alias("t")).join(F.broadcast(training), "doc_id")
    words = chosen.select("toxic", F.explode(F.array_distinct(F.filter(F.split("t", r"(?U)\W+"), lambda w: w != ""))).alias("word"))
    counted = words.groupBy("word").agg(
        F.sum(F.col("toxic").cast("long")).alias("bad"), F.count("*").alias("n")
    )
    totals = counted.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    n_bad, n_all = int(totals.bad or 0), int(totals.n or 0)
    n_good = n_all - n_bad
    if not n_bad or not n_good:
        return Lexicon({}, -1.0, 1.0)
    length = F.length("word")
    grams = F.flatten(F.transform(F.lit([4, 5]), lambda k: F.when(
        length >= k, F.transform(F.sequence(F.lit(1), F.greatest(length - k + 1, F.lit(1))), lambda i: F.substr(F.col("word"), i, k))
    ).otherwise(F.array().cast("array<string>"))))
    units = F.array_union(F.array(F.concat(F.lit("="), "word")), grams)
    by_unit = counted.select(F.explode(units).alias("unit"), "bad", "n").groupBy("unit").agg(
        F.sum("bad").alias("bad"), F.sum("n").alias("n")
    )
    share = n_bad / n_all
    bad, good = F.col("bad"), F.col("n") - F.col("bad")
    part = bad / F.col("n")
    ratio = F.when(bad > 0, bad * F.log(part / share)).otherwise(0.0) + F.when(
        good > 0, good * F.log((1 - part) / (1 - share))
    ).otherwise(0.0)
    prior = F.lit(PRIOR) * F.col("n") / n_all + 0.5
    odds = F.log((bad + prior) / (n_bad + PRIOR - bad)) - F.log((good + prior) / (n_good + PRIOR - good))
    spread = F.sqrt(1 / (bad + prior) + 1 / (good + prior))
    tested = by_unit.count()
    kept = by_unit.where((part > share) & (ratio >= math.log(max(tested, 2)))).select(
        "unit", (odds - spread).alias("score")
    ).where(F.col("score") >= LEAST_SCORE)
    lexicon = {r.unit: float(r.score) for r in kept.toLocalIterator()}  # bounded by the labelled sample
    # Shares of scoring words in both classes, and the clean distribution of scores for lambda.
    scored = counted.select("bad", "n", F.explode(units).alias("unit"), "word").join(F.broadcast(kept), "unit")
    scored = scored.groupBy("word").agg(F.max("score").alias("score"), F.max("bad").alias("bad"), F.max("n").alias("n"))
    binned = scored.groupBy(F.round("score", 1).alias("s")).agg(
        F.sum("bad").alias("bad"), F.sum(F.col("n") - F.col("bad")).alias("good")
    ).collect()
    hit_bad, hit_good = sum(r.bad for r in binned), sum(r.good for r in binned)
    other = math.log((n_bad - hit_bad + 1) / (n_bad + 2)) - math.log((n_good - hit_good + 1) / (n_good + 2))
    other = min(other, -1e-3)
    chance = [(r.s, (r.good + 0.5) / (n_good + 1)) for r in binned]
    return Lexicon(lexicon, other, _solve_rate(chance, other))


def _solve_rate(chance: list[tuple[float, float]], other: float) -> float:
    """The positive lambda at which the mean of exp(lambda score) is 1 for clean tokens; 1 if there is none."""
    rest = 1 - sum(p for _, p in chance)
    mean = lambda x: rest * math.exp(x * other) + sum(p * math.exp(x * s) for s, p in chance) - 1
    low, high = 1e-6, 1.0
    if not chance or mean(low) >= 0:
        return 1.0
    while mean(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 0 else (low, mid)
    return low


def find_segments(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, segments of (first, last, score)) per row: all maximal segments of the whole text."""
    rows = docs.select(F.col(key), text_or_empty(text).alias("_text"))
    units, other = lexicon.units, lexicon.other
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(units)
        for batch in batches:
            column = batch.column(1)
            found = [scan_text(column[i].as_py(), scores, other) for i in range(len(column))]
            lists = [[{"first": a, "last": b, "score": s} for a, b, s in seg] for _, seg in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array(lists, kind)],
                [key, "n_tokens", "segments"],
            )
        pa.default_memory_pool().release_unused()

    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, n_tokens long, segments array<struct<first:int,last:int,score:double>>"
    return rows.mapInArrow(run, schema)


def with_evidence(found: DataFrame, lexicon: Lexicon, k: float) -> DataFrame:
    """Adds ``passages`` (significant segments) and ``evidence`` to what ``find_segments`` gives."""
    excess = lambda s: s["score"] * lexicon.rate - F.log(F.lit(k) * F.greatest(F.col("n_tokens"), F.lit(1)))
    passages = F.filter("segments", lambda s: excess(s) >= -math.log(SIGNIFICANCE))
    return found.withColumn("passages", passages).withColumn(
        "evidence", F.aggregate("passages", F.lit(0.0), lambda t, s: t + excess(s))
    )


def _fit_curve(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope (at least 0) and offset of a logistic curve over (x, toxic rows, rows), with a weak prior."""
    x, y, n = (np.array(v, float) for v in zip(*bins, strict=True))
    w = np.array([0.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - n * p) - 0.01 * w
        hess = (design * (n * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(0.0, float(w[0])), float(w[1])


def fit(ws: Workspace, docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[Lexicon, float, tuple[float, float]]:
    """Lexicon, K of the extreme-value law, and slope and offset of the curve from evidence to probability."""
    training = ws.write(training_labels(docs, labels, max_labelled), "training")
    lexicon = learn(docs, training)
    chosen = docs.select("doc_id", "text").join(F.broadcast(training), "doc_id")
    labelled = ws.write(find_segments(chosen.select("doc_id", "text"), lexicon).join(F.broadcast(training), "doc_id"), "labelled")
    # K: clean segments per clean token, counted at the scores they have.
    seen = labelled.where("toxic = 0").agg(
        F.sum(F.size("segments")).alias("n"), F.min(F.array_min(F.transform("segments", lambda s: s["score"]))).alias("least"), F.sum("n_tokens").alias("tokens")
    ).first()
    least = seen.least if seen.least is not None else min(lexicon.units.values(), default=1.0)
    k = ((seen.n or 0) + 0.5) * math.exp(min(30.0, lexicon.rate * least)) / ((seen.tokens or 0) + 1)
    k = min(1.0, max(k, 1e-9))
    bins = with_evidence(labelled, lexicon, k).groupBy(F.round(F.log1p(F.col("evidence")), 1).alias("x")).agg(
        F.sum(F.col("toxic").cast("double")).alias("y"), F.count("*").alias("n")
    ).collect()  # at most a few hundred: x is a rounded logarithm
    curve = _fit_curve([(r.x, r.y, r.n) for r in bins]) if lexicon.units and bins else (0.0, -50.0)
    return lexicon, k, curve


def _probability(curve: tuple[float, float]) -> Column:
    return 1 / (1 + F.exp(-(F.log1p(F.col("evidence")) * curve[0] + curve[1])))


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, passages, evidence, n_tokens).

    ``score`` is the probability of label 1. Empty and null texts have no evidence and get the probability of texts
    without a toxic passage. Without labels of both classes every score is 0. Null labels are not used;
    several labels of one document count as toxic if one is. Columns other than doc_id and text are not read.
    """
    lexicon, k, curve = fit(Workspace(docs.sparkSession, "toxicity"), docs, labels, max_labelled)
    return with_evidence(find_segments(docs, lexicon), lexicon, k).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), _probability(curve).alias("score"), "passages", "evidence", "n_tokens"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.3, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``limit``. Labels serve for learning only.

    Rows are judged by the key of their text, so that rows sharing a doc_id are told apart.
    """
    ws = Workspace(docs.sparkSession, "toxic")
    its_id, its_sha = free(docs.columns, "_id", "_sha")
    keyed = docs.select(F.struct("doc_id", F.sha2(text_or_empty(), 256).alias("sha")).alias("key"), "doc_id", "text")
    lexicon, k, curve = fit(ws, docs, labels, max_labelled)
    found = with_evidence(find_segments(keyed, lexicon, key="key"), lexicon, k)
    gone = ws.write(found.where(_probability(curve) >= limit).select(F.col("key.doc_id").alias(its_id), F.col("key.sha").alias(its_sha)).distinct(), "gone")
    same = [F.col("doc_id").eqNullSafe(F.col(its_id)), F.sha2(text_or_empty(), 256) == F.col(its_sha)]
    small = gone.count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(gone) if small else gone, same, "left_anti")
