"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are whole words and the beginnings of longer words. Their log-odds
between toxic and other documents are smoothed by a Dirichlet prior; every
maximal segment of a text is found in one pass, and its score is judged by the
extreme-value law of such segments in text that is not toxic.
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

from rollcall.llm.common import is_held_out
from rollcall.llm.words import shingles, word_hashes
from rollcall.session import staged

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled documents the model is fitted on, ``most_tokens`` its size."""

    sample_rows: int = 24000
    most_tokens: int = 50000
    stems: tuple[int, ...] = (4, 5, 6, 7)  # characters of a word's beginnings
    prior: float = 20.0  # weight of the pooled frequencies, in documents
    # Root of twice the log-likelihood ratio a token needs: six toxic families and no other, say.
    least_z: float = 5.0
    least_z_stem: float = 6.0
    least_kinds: int = 4
    drift: float = 0.15  # what a word without evidence takes off a segment
    most_odds: float = 8.0
    significant: float = 0.01
    threshold: float = 0.3


@dataclass
class Model:
    odds: dict[str, float]
    rate: float  # lambda and K of the extreme-value law
    size: float
    intercept: float
    slope: float


def tokens(text: str, stems: tuple[int, ...]) -> set[str]:
    """The words of a text, and beginnings of longer ones marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words | {word[:n] + "*" for word in words for n in stems if len(word) > n}


class Table:
    """Log-odds of tokens; a word without own ones has those of its longest beginning that has."""

    def __init__(self, odds: dict[str, float], stems: tuple[int, ...]):
        self.odds, self.stems = odds, sorted(stems, reverse=True)
        self.first = min(stems)
        self.heads = {x[: self.first] for x in odds}  # most words are told by these

    def hits(self, text: str) -> tuple[list[tuple[int, float]], int]:
        """The words with evidence, as (place, log-odds), and the number of words.

        The k-th time a word or beginning is met it counts one k-th: words that
        a text has used once are likely to come again.
        """
        words = WORD.findall(text.lower())
        heads, get, first, met, out = self.heads, self.odds.get, self.first, {}, []
        for i, word in enumerate(words):
            if word[:first] not in heads:
                continue
            value = get(word)
            for n in self.stems:
                if value is None and len(word) > n:
                    value = get(token := word[:n] + "*")
                    if value is not None:
                        word = token
            if value is not None:
                met[word] = k = met.get(word, 0) + 1
                out.append((i, value / k))
        return out, len(words)


def segments(found: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in order.

    Words between two entries of ``found`` score ``-drift`` each. One pass with
    a list of candidates that are joined as soon as a later one lifts them; each
    knows the last one before it that begins lower, so that the time is linear.
    """
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, cumulative score before and after, link
    total, at = 0.0, -1
    for place, score in found:
        total -= drift * (place - at - 1)
        at = place
        before, total = total, total + score
        if score <= 0:
            continue
        first, j = place, len(kept) - 1
        while j >= 0 and kept[j][2] >= before:
            j = kept[j][4]
        while j >= 0 and kept[j][3] < total:
            first, _, before, _, link = kept[j]
            del kept[j:]
            j = link
        kept.append((first, place, before, total, j))
    return [(a, b, d - c) for a, b, c, d, _ in kept]


def evidence(parts: list[tuple[int, int, float]], n_words: int, rate: float, size: float, significant: float):
    """The significant segments, and the sum of their minus log chances.

    A segment of score S turns up in n words of clean text by chance
    1 - exp(-K n exp(-lambda S)).
    """
    total, kept = 0.0, []
    for part in parts:
        expected = size * max(1, n_words) * math.exp(-min(700.0, rate * part[2]))
        chance = -math.expm1(-expected)
        if chance <= significant:
            kept.append(part)
            total -= math.log(max(chance, 1e-300))
    return kept, total


def _labelled(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of labelled documents: (text, toxic, part), as many toxic as other ones."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("labelled"), "doc_id"), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for toxic, n in counts.items():
        share = F.when(F.col("toxic") == toxic, F.lit(min(1.0, s.sample_rows / 2 / n))).otherwise(share)
    picked = known.where(unit < share).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # About sample_rows rows of three numbers: a bounded broadcast.
    return text.join(F.broadcast(picked), "doc_id").drop("doc_id").where(F.col("text").isNotNull()), counts


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near copies as one family, so that their words are not evidence again and again.

    A family is the smallest hash of three words in a row: copies with most of
    them in common share it.
    """
    for batch in batches:
        runs = shingles(*word_hashes(batch.column("text").to_pylist()), 3)
        family = [int(x[0].astype(np.int64)) if len(x) else 0 for x in runs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("text"), batch.column("toxic"), pa.array(family, pa.int64())], names=["text", "toxic", "family"]
        )


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Learns from labelled documents that are not held out.

    Two thirds of the sample give the log-odds, one third the laws of segments
    and the calibration. Without both kinds of labels every text scores 0.
    """
    sample, counts = _labelled(docs, labels, s)
    names, kinds = ["token", "toxic", "family"], [pa.string(), pa.int32(), pa.int64()]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(
                batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), batch.column("family").to_pylist(), strict=True
            )
            out = ([], [], [])
            for text, toxic, family in rows:
                own = tokens(text, s.stems)
                for column, values in zip(out, (own, [toxic] * len(own), [family] * len(own)), strict=True):
                    column += values
                if len(out[0]) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
                    out = ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    learn = staged(sample.where("part > 0").select("text", "toxic").mapInArrow(_families, "text string, toxic int, family long"), "learn")
    sizes = dict(learn.select("toxic", "family").distinct().groupBy("toxic").count().collect())
    a, b = sizes.get(1, 0), sizes.get(0, 0)
    if not a or not b:
        return Model({}, 1.0, 1.0, -30.0, 0.0)
    # Families with the token among toxic and other ones, both raised by the prior's share.
    alpha = F.lit(s.prior) * (F.col("y") + F.col("x")) / F.lit(float(a + b))
    top, low = F.col("y") + alpha, F.col("x") + alpha

    def surprise(column: str, families: int) -> Column:
        expected = (F.col("y") + F.col("x")) * F.lit(families / (a + b))
        return F.when(F.col(column) > 0, F.col(column) * F.log(F.col(column) / expected)).otherwise(0.0)

    odds = F.log(top / (a + s.prior - top + 1)) - F.log(low / (b + s.prior - low + 1))
    counted = (
        learn
        .mapInArrow(split, "token string, toxic int, family long")
        .distinct()
        .groupBy("token")
        .agg(F.sum("toxic").cast("double").alias("y"), F.sum(1 - F.col("toxic")).cast("double").alias("x"))
    )
    # A beginning says more than its words only if several of them are in toxic documents.
    lengths = F.array(*(F.lit(n) for n in s.stems))
    begun = (
        counted.where((F.col("y") > 0) & ~F.col("token").endswith("*"))
        .select("token", F.explode(F.filter(lengths, lambda n: n < F.length("token"))).alias("n"))
        .groupBy(F.expr("concat(substring(token, 1, n), '*')").alias("token"))
        .agg(F.count("*").alias("kinds"))
    )
    needed = F.when(F.col("token").endswith("*"), s.least_z_stem).otherwise(s.least_z)
    rows = (
        counted.join(begun, "token", "left")
        .where(~F.col("token").endswith("*") | (F.col("kinds") >= s.least_kinds))
        .withColumn("odds", odds)
        .withColumn("z", F.sqrt(F.greatest(2 * (surprise("y", a) + surprise("x", b)), F.lit(0.0))))
        .where(F.col("z") >= needed)
        .orderBy(F.col("z").desc(), "token")
        .limit(s.most_tokens)
        .select("token", "odds")
        .collect()
    )
    found = {r["token"]: float(np.clip(r["odds"], -s.most_odds, s.most_odds)) for r in rows}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Table(found, s.stems)
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own, n = lookup.hits(text)
                scores = sorted((x[2] for x in segments(own, s.drift)), reverse=True)
                out.append((toxic, n, scores, [x for _, x in own]))
            if out:
                kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["toxic", "n", "scores", "hits"]
                )

    rest = (
        sample.where("part = 0").select("text", "toxic")
        .mapInArrow(measure, "toxic int, n long, scores array<double>, hits array<double>")
        .collect()  # numbers of a third of the bounded sample
    )
    clean = [r for r in rest if not r["toxic"]]
    words = 1 + sum(r["n"] for r in clean)
    # lambda: the mean of exp(lambda s) over the words of clean text is 1, one imagined hit of the
    # highest score included.
    seen = [x for r in clean for x in r["scores"]]
    scores, times = np.unique(np.array([max(found.values(), default=1.0), *(x for r in clean for x in r["hits"])]), return_counts=True)
    shares, quiet = times / (words + len(scores)), 1 - times.sum() / (words + len(scores))
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        mass = (shares * np.exp(np.minimum(700.0, mid * scores))).sum() + quiet * math.exp(-mid * s.drift)
        low, high = (mid, high) if mass < 1 else (low, mid)
    rate = low
    # K: mean number of segments above a level is K n exp(-lambda S); one more than seen at the median score.
    level = float(np.median(seen)) if seen else 0.0
    size = (1 + sum(x >= level for x in seen)) / words * math.exp(min(50.0, rate * level))
    x = np.array([evidence([(0, 0, v) for v in r["scores"]], r["n"], rate, size, s.significant)[1] for r in rest])
    y = np.array([r["toxic"] for r in rest], float)
    weight = np.where(y == 1, counts.get(1, 0) / max(1, y.sum()), counts.get(0, 0) / max(1, (1 - y).sum()))
    intercept, slope = logistic(np.log1p(x), y, weight / weight.mean())
    return Model(found, rate, size, intercept, slope)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a weighted, slightly damped logistic fit, by Newton's steps."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.array([-1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 0.05 * beta
        curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + 0.05 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of every document.

    ``passages`` are the significant segments as (first word, last word,
    score). Null texts count as empty; empty texts score as texts without
    evidence. Other columns are left out; repeated rows are scored alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # most_tokens entries at most
    passages = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lookup = Table(m.odds, s.stems)
        for batch in batches:
            out, scores = [], []
            for text in batch.column("text"):
                own, n = lookup.hits(text.as_py() or "")
                kept, x = evidence(segments(own, s.drift), n, m.rate, m.size, s.significant)
                out.append([{"first": a, "last": b, "score": c} for a, b, c in kept])
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, m.intercept + m.slope * math.log1p(x))))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(out, passages)], names=["doc_id", "score", "passages"]
            )

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        judge, "doc_id long, score double, passages array<struct<first: int, last: int, score: double>>"
    )
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= s.threshold).cast("int").alias("predicted"), "passages",
    )
