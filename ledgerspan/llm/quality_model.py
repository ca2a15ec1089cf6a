"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is reduced to a few numbers inside its task. The model is a sum of lookup tables, one per
feature and one per chosen pair of features: trees of a few leaves are boosted on one feature after the
other, round and round, and add up in the feature's table; pairs follow on what is left. A score is then
a few additions of table entries, vectorised over a batch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.llm.common import crc_remainder, stored

SAMPLE = 20_000  # labelled rows that the fit may use at most, those lowest by hash of the id
DIVISOR, HELD_OUT = 5, 0
THRESHOLD = 0.3
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, LEAST = 0.15, 20.0  # learning rate; least rows of a leaf

FEATURES = (
    "log_words", "word_length", "long_words", "distinct", "distinct_pairs", "top_word", "same_as_last", "repeated_lines", "words_a_line",
    "upper", "digits", "symbols", "pipes", "marks", "stops", "beyond_ascii", "byte_entropy", "bare_words",
)


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, DIVISOR) == HELD_OUT


def describe(text: str | None) -> list[float]:
    """The features of one text; an empty one has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(raw)
    counts = Counter(words)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = bytes_[bytes_ > 0] / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    of = lambda characters: bytes_[list(characters)].sum() / size
    return [
        float(np.log1p(n)), float(lengths.mean()), float((lengths > 20).mean()), len(counts) / n, len(set(zip(words, words[1:]))) / n, max(counts.values()) / n,
        sum(map(bytes.__eq__, words[1:], words)) / n, 1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))),
        bytes_[65:91].sum() / size, bytes_[48:58].sum() / size, of(b"#*$%&<>@^~"), of(b"|"), of(b"!?"), of(b".,;:"), bytes_[128:].sum() / size,
        float(-(share * np.log2(share)).sum()), sum(map(bytes.isalpha, words)) / n,
    ]


def _described(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [describe(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])

    return run


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    return docs.select("doc_id", "text").mapInArrow(_described(to_arrow_type(kind)), f"doc_id {kind.simpleString()}, features array<double>")


@dataclass
class Additive:
    """Bin edges per feature and lookup tables; the score of a row is the sum of its entries."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            out += table[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(x)))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.zeros(0)


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Gain and place of the best cut of bins lo..hi-1 in two, by sums of gradients and curvatures."""
    if hi - lo < 2:
        return 0.0, -1
    cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
    left_g, left_h, right_g, right_h = cg[:-1], ch[:-1], cg[-1] - cg[:-1], ch[-1] - ch[:-1]
    gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - cg[-1] ** 2 / (ch[-1] + 1)
    gain[(left_h < LEAST / 8) | (right_h < LEAST / 8)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), lo + at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A step per bin, from a tree of at most `leaves` leaves over the bins of one feature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, cut, part = max((*_best_cut(g, h, *p), p) for p in parts)
        if gain <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], cut), (cut, part[1])]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best cut of a pair's grid into four quadrants."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total_g, total_h = cg[-1, -1], ch[-1, -1]
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    b_g, b_h = cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h
    c_g, c_h = cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h
    d_g, d_h = total_g - a_g - b_g - c_g, total_h - a_h - b_h - c_h
    gain = sum(x**2 / (y + 1) for x, y in ((a_g, a_h), (b_g, b_h), (c_g, c_h), (d_g, d_h)))
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + 1)
    return float(gain[i, j] - total_g**2 / (total_h + 1)), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boosted on the logistic loss; with one class only, or no rows, the score is the same for all."""
    mean = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(mean / (1 - mean))), [], [])
    model.edges = [quantile_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    logit = np.full(len(y), model.base)

    def gradients():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = gradients()
            step = RATE * shallow_tree(np.bincount(at[j], g, len(table)), np.bincount(at[j], h, len(table)))
            table += step
            logit += step[at[j]]
    model.coarse = [quantile_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    near = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    width = [len(e) + 1 for e in model.coarse]

    def grids(a: int, b: int):
        g, h = gradients()
        cell, n = near[a] * width[b] + near[b], width[a] * width[b]
        return np.bincount(cell, g, n).reshape(width[a], width[b]), np.bincount(cell, h, n).reshape(width[a], width[b])

    gains = sorted(((_quadrants(*grids(a, b))[0], a, b) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((width[a], width[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = RATE * _quadrants(*grids(a, b))[1]
            table += step
            logit += step[near[a], near[b]]
    return model


def lowest_hashes(rows: DataFrame, sample: int) -> int | None:
    """A bound on column `h` that keeps the `sample` lowest, and at most as many more; None where all may stay.

    Counts per range of hashes, finer in the range that the last one falls into; 4,096 numbers at a time reach the driver.
    """
    kept, inside = 0, rows
    for shift in range(52, -1, -12):
        at = F.shiftright("h", shift)
        counts = sorted((r["at"], r["n"]) for r in inside.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect())
        for range_, n in counts:
            if kept + n > sample:
                break
            kept += n
        else:
            return None
        if n <= sample or shift < 12:
            return ((range_ + 1) << shift) - 1
        inside = inside.where(at == range_)
    return None


def training_sample(described: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """At most `sample` labelled rows that are not held out, those whose ids hash lowest, the same at every run."""
    marks = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    hashed = lambda rows: rows.where(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    most = lowest_hashes(hashed(described.select("doc_id")).join(marks, "doc_id").select("h"), sample)
    low = lambda rows: rows if most is None else rows.where(F.col("h") <= most)
    met = low(hashed(described)).join(marks, "doc_id")
    rows = met.select("features", "quality", "h", "doc_id").orderBy("h", "doc_id", "quality", "features").limit(sample).collect()
    return np.array([r["features"] for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r["quality"] for r in rows], float)


def _scored(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Additive(*sent.value)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    return run


def report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`.

    The fit uses labelled rows whose id is not held out; labels, language, source and id are no inputs of a
    score. Null and empty texts have zero features and a score like any other. Rows with a null id are
    scored, never learned from. Repeated rows score alike; without labels all score one half.
    """
    described = stored(features(docs), "quality-features")
    model = fit(*training_sample(described, labels, sample))
    sent = docs.sparkSession.sparkContext.broadcast((model.base, model.edges, model.tables, model.coarse, model.pairs, model.pair_tables))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = described.mapInArrow(_scored(sent), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
