"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams of one to three characters, weighted by
their share of the text and their inverse document frequency. The weights are
learned one document at a time by follow-the-regularised-leader with an
elastic-net penalty; a temperature fitted on documents set aside calibrates
the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.bytebpe import slices
from rollcall.llm.common import is_held_out

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that the weights are fitted on (about so many, as
    many of each language as there are); document frequencies are of all training documents."""

    bins: int = 1 << 16
    orders: tuple[int, ...] = (1, 2, 3)
    sample_rows: int = 4000
    epochs: int = 4
    alpha: float = 20.0
    beta: float = 1.0
    l1: float = 0.0001
    l2: float = 0.0001
    calibration_share: float = 0.25


def gram_bins(texts: list[str], s: Settings) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each n-gram order the bin of every position, where the texts begin, and which have letters.

    Every text stands between blanks, so that no n-gram reaches into its
    neighbour; characters that are no letters count as blanks.
    """
    side = " " * (max(s.orders) - 1)
    texts = [x.lower() for x in texts]
    codes = np.frombuffer((side + (2 * side).join(texts) + side).encode("utf-32-le", "replace"), np.uint32)
    letters = _letters()[codes]
    codes = np.where(letters, codes, 32).astype(np.uint64)
    begins = np.concatenate([[0], np.cumsum([len(x) + 2 * len(side) for x in texts])])[:-1]
    hashed, out = np.zeros(len(codes), np.uint64), []
    for n in range(1, max(s.orders) + 1):
        shifted = np.full(len(codes), 32, np.uint64)
        shifted[: len(codes) - n + 1] = codes[n - 1 :]
        hashed = (hashed + shifted + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(31)
        if n in s.orders:
            out.append((hashed >> np.uint64(20)).astype(np.int64) & (s.bins - 1))
    return out, begins, np.add.reduceat(letters.astype(np.int64), begins) > 0


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def _training(docs: DataFrame) -> DataFrame:
    """What may be learned from; texts without letters say nothing."""
    return docs.where(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))


def document_frequencies(docs: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """How many training documents have each bin, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(s.bins, np.int64), 0
        mark = np.zeros(s.bins, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in slices([len(x) for x in texts]):
                grams, begins, _ = gram_bins(texts[begin:end], s)
                edges = [*begins.tolist(), len(grams[0])]
                for x, y in zip(edges, edges[1:], strict=False):
                    for g in grams:
                        mark[g[x:y]] = 1
                    total += mark
                    mark[:] = 0
                n += end - begin
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1)), pa.array(np.append(total[held], n))], names=["bin", "df"]
        )

    rows = docs.select("text").mapInArrow(count, "bin long, df long").groupBy("bin").agg(F.sum("df").alias("df"))
    found = {r["bin"]: r["df"] for r in rows.collect()}  # at most one row per bin
    n = found.pop(-1, 0)
    df = np.zeros(s.bins, np.int64)
    df[list(found)] = list(found.values())
    return df, n


def _sample(docs: DataFrame, s: Settings) -> DataFrame:
    """About ``sample_rows`` training documents, the languages as even as they can be."""
    counts = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    share = s.sample_rows / max(1, len(counts))
    fractions = [F.when(F.col("lang") == lang, F.lit(min(1.0, share / n))) for lang, n in counts.items()]
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    return docs.where(unit < F.coalesce(*fractions, F.lit(0.0)))


class Ftrl:
    """FTRL-proximal for a softmax over dense arrays of bins by languages."""

    def __init__(self, langs: int, s: Settings):
        self.s = s
        self.z = np.zeros((s.bins, langs))
        self.n = np.zeros((s.bins, langs))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n, s = self.z[rows], self.n[rows], self.s
        free = np.sign(z) * s.l1 - z
        return np.where(np.abs(z) > s.l1, free / ((s.beta + np.sqrt(n)) / s.alpha + s.l2), 0.0)

    def learn(self, rows: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        step = (np.sqrt(self.n[rows] + g * g) - np.sqrt(self.n[rows])) / self.s.alpha
        self.z[rows] += g - step * w
        self.n[rows] += g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by search over powers of two."""
    if not len(labels):
        return 1.0
    best, step = 0.0, 2.0
    loss = lambda t: -np.log(softmax(scores / 2.0**t)[np.arange(len(labels)), labels] + 1e-300).mean()
    while step > 0.01:
        best = min((best - step, best, best + step), key=loss)
        step /= 2
    return float(2.0 ** np.clip(best, -8, 8))


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # by bin and language, inverse document frequencies included
    temperature: float


def fit(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Learns from the rows of ``docs`` that are not held out and have a language."""
    train = _training(docs)
    df, n = document_frequencies(train, s)
    idf = np.where(df > 0, np.log((1 + n) / (1 + df)) + 1, 0.0)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows, values = [], []
            for begin, end in slices([len(x) for x in texts]):
                grams, begins, _ = gram_bins(texts[begin:end], s)
                edges = [*begins.tolist(), len(grams[0])]
                for x, y in zip(edges, edges[1:], strict=False):
                    own, count = np.unique(np.concatenate([g[x:y] for g in grams]), return_counts=True)
                    rows.append(own.astype(np.int32))
                    values.append((count / count.sum()).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_order"), batch.column("lang"), pa.array(rows, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                names=["_order", "lang", "bins", "tf"],
            )

    def train_all(table):
        table = table.sort_by("_order")
        langs = sorted(set(table.column("lang").to_pylist()))
        y = np.array([langs.index(x) for x in table.column("lang").to_pylist()])
        rows = [np.asarray(x.values) for x in table.column("bins")]
        xs = [np.asarray(x.values) * idf[r] for x, r in zip(table.column("tf"), rows, strict=True)]
        aside = int(len(y) * s.calibration_share)
        model = Ftrl(len(langs), s)
        for _ in range(s.epochs):
            for i in range(aside, len(y)):
                model.learn(rows[i], xs[i], y[i])
        w = model.weights()
        t = temperature(np.array([xs[i] @ w[rows[i]] for i in range(aside)]).reshape(aside, len(langs)), y[:aside])
        held = np.flatnonzero(np.abs(w).any(axis=1))
        w = (w * idf[:, None])[held]
        return pa.table(
            {
                "bin": pa.array(np.append(held, -1), pa.int64()),
                "weights": pa.array([*w, np.array([t])], pa.list_(pa.float64())),
                "langs": pa.array([None] * len(held) + [langs], pa.list_(pa.string())),
            }
        )

    sample = _sample(train, s).select(F.xxhash64(F.lit("order"), "doc_id", "text").alias("_order"), "lang", "text")
    rows = (
        sample.mapInArrow(features, "_order long, lang string, bins array<int>, tf array<float>")
        .withColumn("_all", F.lit(0))
        .groupBy("_all")
        .applyInArrow(train_all, "bin long, weights array<double>, langs array<string>")
        .collect()  # at most one row per bin
    )
    if not rows:
        return Model([], np.zeros((s.bins, 0), np.float32), 1.0)
    langs = next(r["langs"] for r in rows if r["langs"])
    weights = np.zeros((s.bins, len(langs)), np.float32)
    for r in rows:
        if r["bin"] >= 0:
            weights[r["bin"]] = r["weights"]
    return Model(langs, weights, next(r["weights"][0] for r in rows if r["bin"] < 0))


def predict(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the calibrated probability of that language.

    Texts that are null, empty or without a letter get ``und`` and 0, as does
    everything if nothing could be learned. All columns and rows are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by bins times languages
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = np.array([*m.langs, UNKNOWN], dtype=object)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            best, score = np.full(len(texts), len(m.langs)), np.zeros(len(texts))
            for begin, end in slices([len(x) for x in texts]) if m.langs else ():
                grams, begins, seen = gram_bins(texts[begin:end], s)
                total = sum(np.add.reduceat(m.weights[g], begins) for g in grams)
                size = np.diff(np.append(begins, len(grams[0])))
                p = softmax(total / (len(grams) * size[:, None]) / m.temperature)
                best[begin:end] = np.where(seen, p.argmax(axis=1), len(m.langs))
                score[begin:end] = np.where(seen, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs[best].tolist(), pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"]
            )

    return docs.select(*names).mapInArrow(label, f"{kinds}, lang_pred string, score double")
