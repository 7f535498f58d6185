"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of character and word statistics.  Features are binned at quantiles
of a bounded training sample; cyclic boosting then visits the features in turn, each time
fitting a shallow tree (up to ``LEAVES`` runs of bins) to the logistic gradients and adding its
leaves to the feature's lookup table.  Afterwards the feature pairs whose residuals gain most
from a cut in each get two-way tables, boosted in the same cyclic way.  A score is the
logistic of the intercept plus one table entry per feature and per pair, so scoring is
binning and additions on whole batches.

The sample is bounded: at most ``SAMPLE`` labelled rows, those with the smallest hash of the id.
Labels, language, source and id are never inputs of a score.

Defined cases: a null text scores as an empty one; a null label and labels without a document do not train;
several labels of one id count as the highest; with no labels every score is 0.5, with one
class the smoothed share; ids may repeat or be null (then not held out); extra columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store
from larkspur.llm.words import Hasher, byte_values, mix, non_space, runs, text_bytes

SAMPLE = 20_000
BINS, LEAVES, PAIRS = 32, 4, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.15
RIDGE = 1.0
THRESHOLD = 0.3

FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "shouting", "punctuation",
            "spaces", "lines_per_word", "distinct_words", "repeated_triples", "repeated_lines",
            "longest_word", "commonest_word", "not_ascii")


def _classes() -> np.ndarray:
    """Per byte: 1 upper, 2 lower, 3 digit, 4 symbol, 5 ! and ?, 6 other punctuation, 7 space, 8 not ASCII."""
    t = np.zeros(256, np.uint8)
    t[0x21:0x7F] = 6
    t[0x41:0x5B], t[0x61:0x7B], t[0x30:0x3A] = 1, 2, 3
    t[[ord(c) for c in "#*$%&|<>"]], t[[ord("!"), ord("?")]] = 4, 5
    t[[0x20, *range(0x09, 0x0E)]] = 7
    t[0x80:] = 8
    return t


def _repeat_share(values: np.ndarray) -> float:
    """The share of entries that equal an earlier one."""
    return 1 - len(np.unique(values)) / len(values) if len(values) else 0.0


def features(hasher: Hasher, texts: pa.Array) -> np.ndarray:
    """(texts, FEATURES) of an Arrow string column."""
    buf, off = text_bytes(texts)
    kind = _classes()[buf]
    n = len(off) - 1
    counts = np.zeros((n, 9))
    hashes, doc, start, end = hasher.words(texts)
    bounds = runs(doc, n)
    newline = np.flatnonzero(buf == 0x0A)
    line_cuts = np.searchsorted(newline, off)
    out = np.zeros((n, len(FEATURES)))
    for k in range(n):
        a, z = off[k], off[k + 1]
        counts[k] = np.bincount(kind[a:z], minlength=9)[:9]
        h = hashes[bounds[k]: bounds[k + 1]]
        w = len(h)
        lengths = end[bounds[k]: bounds[k + 1]] - start[bounds[k]: bounds[k + 1]]
        lines = newline[line_cuts[k]: line_cuts[k + 1]] - a
        if w:
            _, times = np.unique(h, return_counts=True)
            triple = mix(h[:-2]) + h[1:-1] * np.uint64(3) + h[2:] * np.uint64(5) if w > 2 else h[:0]
            # A line's hash: the sum of its words' hashes at their places.
            line_of = np.searchsorted(lines, start[bounds[k]: bounds[k + 1]])
            first = np.flatnonzero(np.append(True, line_of[1:] != line_of[:-1]))
            place = np.arange(w) - np.repeat(first, np.diff(np.append(first, w)))
            line_hash = np.add.reduceat(mix(h + place.astype(np.uint64)), first)
            out[k, 10:15] = (len(times) / w, _repeat_share(triple), _repeat_share(line_hash),
                             np.log1p(lengths.max()), times.max() / w)
        c, total, letters = counts[k], max(1, z - a), max(1.0, counts[k][1] + counts[k][2])
        out[k, :10] = (np.log1p(z - a), np.log1p(w), lengths.mean() if w else 0.0, c[1] / letters, c[3] / total,
                       c[4] / total, c[5] / total, c[6] / total, c[7] / total, len(lines) / max(1, w))
        out[k, 15] = c[8] / total
    return out


class Model:
    """Bin edges per feature, a lookup table per feature and per chosen pair, and an intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else c for c in x.T]
        p = (y.sum() + 0.5) / (len(y) + 1)
        self.intercept = float(np.log(p / (1 - p)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        if len(np.unique(y)) == 2:
            self._boost(self.bin(x), y)

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._margin(self.bin(x)), -30, 30)))

    def _margin(self, b: np.ndarray) -> np.ndarray:
        m = np.full(len(b), self.intercept)
        for j, t in enumerate(self.tables):
            m += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            m += t[b[:, i], b[:, j]]
        return m

    def _boost(self, b: np.ndarray, y: np.ndarray) -> None:
        m = self._margin(b)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                g, h = _gradients(m, y)
                step = RATE * _shallow_tree(np.bincount(b[:, j], g, len(table)), np.bincount(b[:, j], h, len(table)))
                table += step
                m += step[b[:, j]]
        g, h = _gradients(m, y)
        gains = {}
        for i in range(len(self.tables)):
            for j in range(i + 1, len(self.tables)):
                gains[i, j] = _quadrants(*self._grids(b, i, j, g, h))[0]
        self.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
        self.pair_tables = [np.zeros((len(self.tables[i]), len(self.tables[j]))) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                g, h = _gradients(m, y)
                step = RATE * _quadrants(*self._grids(b, i, j, g, h))[1]
                table += step
                m += step[b[:, i], b[:, j]]

    def _grids(self, b: np.ndarray, i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(self.tables[i]), len(self.tables[j]))
        at = b[:, i] * shape[1] + b[:, j]
        return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))


def _gradients(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
    return y - p, np.maximum(p * (1 - p), 1e-6)


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a greedy tree with at most LEAVES runs of bins."""
    G, H = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))

    def worth(a, z):
        return (G[z] - G[a]) ** 2 / (H[z] - H[a] + RIDGE)

    cuts = [0, len(g)]
    while len(cuts) <= LEAVES:
        best = (1e-9, None)
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z - a > 1:
                c = np.arange(a + 1, z)
                gain = worth(a, c) + worth(c, z) - worth(a, z)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(c[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:z] = (G[z] - G[a]) / (H[z] - H[a] + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The gain and the values per cell of the best tree with one cut in each of two features."""
    G, H = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    r, c = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]
    if not r.size or not c.size:
        return 0.0, np.zeros(g.shape)

    def parts(S):
        a, b, d = S[r, c], S[r, -1] - S[r, c], S[-1, c] - S[r, c]
        return a, b, d, S[-1, -1] - a - b - d

    gain = sum(x ** 2 / (w + RIDGE) for x, w in zip(parts(G), parts(H), strict=True)) - G[-1, -1] ** 2 / (H[-1, -1] + RIDGE)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    a, b, d, e = (float((x / (w + RIDGE))[i, j]) for x, w in zip(parts(G), parts(H), strict=True))
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1:], out[i + 1:, : j + 1], out[i + 1:, j + 1:] = a, b, d, e
    return float(gain[i, j]), out


def _hasher() -> Hasher:
    return Hasher(non_space(), byte_values())


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _hasher()
    for batch in batches:
        x = features(hasher, batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])


def held_out(id_col: str):
    """The rows kept from training: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model of the labels of rows that are not held out, from at most ``sample`` of them."""
    store.small_batches(docs.sparkSession)
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id"))
              .groupBy("id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Bounded by ``sample`` rows of an id and a label.
    rows = (texts.join(F.broadcast(marked), "id").select("y", "text").mapInArrow(_features_of, "y int, x array<double>")
            .toArrow())
    x = np.asarray(rows["x"].combine_chunks().flatten()).reshape(rows.num_rows, len(FEATURES))
    # The rows' order follows the tasks; a fixed order makes equal inputs give equal tables.
    order = np.lexsort(x.T)
    return Model(x[order], np.asarray(rows["y"], dtype=np.float64)[order])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (score >= threshold), less clashing columns."""
    spark = docs.sparkSession
    store.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    docs = store.without(docs, "held_out", "score", "predicted")
    names = docs.columns
    schema = docs.select(*names).withColumn("score", F.lit(0.0)).schema
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            s = shared.value.score(features(hasher, batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*batch.schema.names, "score"])
    return (docs.mapInArrow(run, schema).withColumn("held_out", held_out(id_col))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` scored by a model fitted on the labels that are not held out."""
    return score(docs, fit(docs, labels), **options)
