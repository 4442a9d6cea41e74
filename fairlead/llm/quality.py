"""Document quality by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents, ship, sliced

#: Labelled documents that a model is fitted on at most, about; chosen by a hash.
FITTED = 20_000
BINS = 64
TREES, DEPTH, RATE = 80, 4, 0.15
#: Weight of the prior of a leaf, and labelled rows (by curvature) that a leaf needs.
SMOOTHING, LEAST = 1.0, 1.0
CUT = 0.7
CHUNK = 4 << 20

#: Classes of bytes whose shares are statistics.
CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9), "line": (10, 13),
    "stop": b".,;:", "shout": b"!?", "bar": b"|/\\", "mark": b"#$%&*@^~_=+<>", "quote": b"\"'()[]{}-", "wide": range(128, 256),
}
STATISTICS = (
    "chars", "words", "word_length", "long_words", "distinct_words", "top_word", "distinct_lines", "top_line", "line_length",
    "words_marked", "repeated_pairs", *CLASSES, "entropy",
)


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.int64)
    for i, members in enumerate(CLASSES.values()):
        table[list(members)] = i
    return table


_CLASS_OF = _class_table()


def statistics(text: str | None) -> list[float]:
    """Counts and shares of one whole text, in the order of STATISTICS; all 0 for an empty one."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    lines = [x for x in raw.split(b"\n") if x]
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS_OF, weights=bytes_, minlength=len(CLASSES) + 1)[: len(CLASSES)] / len(raw)
    some = bytes_[bytes_ > 0] / len(raw)
    n, letters = len(words), sum(map(len, words))
    return [
        float(len(raw)), float(n), letters / n, sum(len(w) > 15 for w in words) / n, len(seen) / n, max(seen.values()) / n,
        len(set(lines)) / len(lines), max(Counter(lines).values()) / len(lines), len(raw) / len(lines),
        sum(w[-1] < 48 or 58 <= w[-1] < 65 for w in words) / n, 1 - len(pairs) / max(n - 1, 1),
        *shares.tolist(), float(-(some * np.log2(some)).sum()),
    ]


class Trees:
    """Boosted trees of equal depth, flattened: node k of a tree has the children 2k + 1 and 2k + 2."""

    def __init__(self, edges: np.ndarray, prior: float, feature: np.ndarray, bin_: np.ndarray, value: np.ndarray):
        self.edges, self.prior, self.feature, self.bin, self.value = edges, prior, feature, bin_, value

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1).astype(np.int16)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row: all trees are walked level by level at once."""
        if not len(x):
            return np.zeros(0)
        bins = self.binned(x)
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree, row = np.arange(len(self.feature)), np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            right = bins[row, self.feature[tree, node]] > self.bin[tree, node]
            node = 2 * node + 1 + right
        leaf = self.value[tree, node - (2**DEPTH - 1)] if len(tree) else np.zeros((len(x), 0))
        return 1 / (1 + np.exp(-(self.prior + leaf.sum(axis=1))))


def grown(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to labels y by second-order boosting on histograms of BINS bins per statistic."""
    edges = np.stack([np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1]) for c in x.T])
    share = (y.sum() + 1) / (len(y) + 2)
    trees = Trees(edges, float(np.log(share / (1 - share))), np.zeros((0, 2**DEPTH - 1), int), np.zeros((0, 2**DEPTH - 1), int), np.zeros((0, 2**DEPTH)))
    if y.min() == y.max():
        return trees
    bins = trees.binned(x).astype(np.int64)
    k = x.shape[1]
    features, cuts, values = [], [], []
    margin = np.full(len(y), trees.prior)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, BINS)
        for level in range(DEPTH):
            m, first = 2**level, 2**level - 1
            flat = (((node - first)[:, None] * k + np.arange(k)) * BINS + bins).ravel()
            gs, hs = (np.bincount(flat, weights=np.repeat(v, k), minlength=m * k * BINS).reshape(m, k, BINS) for v in (g, h))
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            ga, ha = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + SMOOTHING) + (ga - gl) ** 2 / (ha - hl + SMOOTHING) - ga**2 / (ha + SMOOTHING)
            gain[(hl < LEAST) | (ha - hl < LEAST)] = 0
            best = gain.reshape(m, -1).argmax(1)
            good = gain.reshape(m, -1)[np.arange(m), best] > 1e-6
            feature[first : first + m] = np.where(good, best // BINS, 0)
            cut[first : first + m] = np.where(good, best % BINS, BINS)  # BINS: every row goes left
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**DEPTH - 1)
        value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + SMOOTHING)
        margin += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(edges, trees.prior, np.array(features), np.array(cuts), np.array(values))


def fitted(docs: DataFrame, labels: DataFrame) -> Trees | None:
    """A model of the documents (doc_id, text) with labels (doc_id, label 0 or 1); None if no row is labelled.

    About FITTED labels, chosen by a hash, are sent to the documents, so no text is shuffled.
    """
    ship(docs.sparkSession)
    labels = labels.filter(F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("double").alias("y"))
    total = labels.count()
    if not total:
        return None
    cells = 1_000_000
    some = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(cells)) < -(-cells * FITTED // total))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            x = pa.array([statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, batch.column("y")], ["x", "y"])

    found = sorted((r.x, r.y) for r in rows.select("text", "y").mapInArrow(run, "x array<double>, y double").collect())
    return grown(np.array([x for x, _ in found]), np.array([y for _, y in found])) if found else None


def scored(docs: DataFrame, model: Trees | None) -> DataFrame:
    """(doc_id, score, predicted) for every document, from its whole text alone.

    A null text counts as empty; without a model every score is 0.5; repeated rows and null
    doc_id are kept; other columns are not read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            x = np.array([statistics(t.as_py()) for t in batch.column("text")])
            score = sent.value.score(x) if sent.value is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def held_out():
    """One quarter of the documents by a checksum of their id; their labels are never learned."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    model = fitted(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
