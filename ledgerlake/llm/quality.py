"""A quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits shallow trees to one feature (then one pair of features) at a time and adds them
up in a lookup table per feature and pair, so a score is a sum of table entries. The model is trained on
the driver from a bounded sample of labelled rows; Spark computes the features and scores all rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerlake.llm.common import smallest_hashes, table, whole_text

#: Labelled rows that the model is fitted to, taken in the order of a hash of their id.
TRAIN_ROWS = 20_000
FOLDS = 5
CUT = 0.3
BINS = 24
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.15
#: A leaf holds this much second-order weight at least; RIDGE shrinks leaves.
LEAF = 2.0
RIDGE = 1.0

FEATURES = (
    "log_words", "word_length", "distinct_words", "log_lines", "distinct_lines", "upper", "digits", "symbols", "pipes", "bangs",
    "commas_stops", "other_letters", "marked_words", "one_sign_words", "capital_words", "top_word", "line_length", "run_length",
)

_SYMBOLS = b"#$%&*@^~_=+<>/\\{}[]"


def features(text: bytes) -> list[float]:
    """The numbers in FEATURES; an empty text gives zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, signs = len(words), max(1, len(text) - int(count[32]))
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    common: dict[bytes, int] = {}
    for w in words:
        common[w] = common.get(w, 0) + 1
    marked = sum(v for w, v in common.items() if w[-1] in b"#$%&*!|" and len(w) > 1)
    single = sum(v for w, v in common.items() if len(w) == 1 and not w.isalnum())
    capital = sum(v for w, v in common.items() if 65 <= w[0] <= 90)
    return [
        float(np.log1p(n)),
        signs / n,
        len(common) / n,
        float(np.log1p(len(lines))),
        len(set(lines)) / max(1, len(lines)),
        upper / max(1, upper + lower),
        int(count[48:58].sum()) / signs,
        sum(int(count[b]) for b in _SYMBOLS) / signs,
        int(count[124]) / n,
        int(count[33]) / n,
        int(count[44] + count[46]) / n,
        int(count[128:].sum()) / signs,
        marked / n,
        single / n,
        capital / n,
        max(common.values()) / n,
        float(np.log1p(len(text) / max(1, len(lines)))),
        float(np.log1p(max(map(len, common)))),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def feature_rows(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t.encode()) for t in texts], dtype=object)


@dataclass
class Model:
    """Bin edges, a table per feature, a table per pair, and the intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(self.edges)])

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        b, total = self.bins(rows), np.full(len(rows), self.intercept)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        for (f, g), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[b[:, f], b[:, g]]
        return 1 / (1 + np.exp(-total))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of a run of bins and its gain; cut 0 is none."""
    if len(g) < 2:
        return 0.0, 0
    lg, lh = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    rg, rh = g.sum() - lg, h.sum() - lh
    gain = np.where((lh >= LEAF) & (rh >= LEAF), _gain(lg, lh) + _gain(rg, rh) - _gain(g.sum(), h.sum()), 0.0)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1 if gain[at] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A tree of at most ``leaves`` leaves over the bins of one feature, as a value per bin."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        cuts = [(*_split(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(spans)]
        gain, at, i = max(cuts)
        if not at:
            break
        a, b = spans.pop(i)
        spans += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best four quadrants over two features' bins: its gain, and a value per cell."""
    corner = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    cg, ch = corner(g), corner(h)
    n, m = g.shape
    i, j = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")
    if not i.size:
        return 0.0, np.zeros_like(g)
    parts = [(c[i, j], c[i, m] - c[i, j], c[n, j] - c[i, j], c[n, m] - c[i, m] - c[n, j] + c[i, j]) for c in (cg, ch)]
    gain = sum(_gain(a, b) for a, b in zip(*parts, strict=True)) - _gain(cg[n, m], ch[n, m])
    best = np.unravel_index(int(np.argmax(gain)), gain.shape)
    a, b = int(i[best]), int(j[best])
    out = np.zeros_like(g)
    for rows in (slice(0, a), slice(a, n)):
        for cols in (slice(0, b), slice(b, m)):
            out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return float(gain[best]), out


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Main effects by cyclic boosting, then the PAIRS pairs that explain most of what is left.

    Without rows, or with labels of one kind, the score is that kind's smoothed share (0.5 for none).
    """
    y = labels.astype(float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Model([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), intercept)
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges], intercept)
    bins, total = model.bins(rows), np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for f, t in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(bins[:, f], g, len(t)), np.bincount(bins[:, f], h, len(t)))
            t += step
            total += step[bins[:, f]]

    def cells(f: int, g: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = (len(model.tables[f]), len(model.tables[g]))
        return bins[:, f] * shape[1] + bins[:, g], shape

    def pair(f: int, g: int, slope: tuple[np.ndarray, np.ndarray]) -> tuple[float, np.ndarray]:
        at, shape = cells(f, g)
        return _pair_tree(*[np.bincount(at, s, shape[0] * shape[1]).reshape(shape) for s in slope])

    now = slopes()
    every = [(f, g) for f in range(rows.shape[1]) for g in range(f + 1, rows.shape[1])]
    model.pairs = sorted(every, key=lambda p: (-pair(*p, now)[0], p))[:PAIRS]
    model.pair_tables = [np.zeros(cells(*p)[1]) for p in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for p, t in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * pair(*p, slopes())[1]
            t += step
            total += step.ravel()[cells(*p)[0]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: every FOLDS-th by the checksum of the id; a null id is one."""
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit to at most ``rows`` labelled documents that are not held out; null labels are passed over.

    A document with several labels counts as good if at least half of them are.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    sample = smallest_hashes(known.withColumn("at", F.xxhash64("doc_id")), "at", rows).drop("at")
    # at most ``rows`` rows of 16 bytes
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # copies of one id would outweigh the bound; one text of each stands for it
    got = found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    got = got.select("doc_id", feature_rows(whole_text("text")).alias("x"), "label").toPandas().sort_values("doc_id")
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    return fit(x, got["label"].to_numpy(float))


def quality_score(text: Column, model: Model, spark) -> Column:
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score(np.array([features(t.encode()) for t in texts], float)))

    return score(whole_text(text))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    ``score``: the probability that label 1 is right, from the text alone; null and empty texts are
    scored as texts without words. Repeated rows get equal scores. Other columns are ignored. An empty
    table of documents gives an empty result; without labels every score is 0.5.
    """
    score = quality_score(F.col("text"), train(docs, labels), docs.sparkSession)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects.

    Columns stay as they are, whatever their names; ids, sources and repeats play no part. A null text is scored
    as an empty one, very long texts whole. Without usable labels the model gives every text the same score.
    An empty table gives an empty one.
    """
    return docs.where(quality_score(F.col("text"), train(docs, labels), docs.sparkSession) >= CUT)


def op10_additive_quality(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
