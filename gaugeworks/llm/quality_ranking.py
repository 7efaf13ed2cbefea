"""Quality scores from pairwise preferences (Bradley-Terry).

The chance that one document is preferred to another is the logistic function of the difference of their scores, and a score is linear in
features of the text. Preference pairs join all better-labelled documents with all worse ones; logistic loss on feature differences gives
the weights. A quantile of the scores, the share of worse documents among those labelled, becomes the threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_texts, written

#: Labelled rows that learn weights together, about, and rows of a label that each such group should have.
GROUP_ROWS, LEAST = 20_000, 100
BINS, GRID = 12, 256

FEATURES = (
    "n_words", "word_chars", "symbols", "punctuation", "digits", "capitals", "unique_words", "repeated_next", "top_word", "repeated_lines",
    "line_words", "short_words", "lone_marks", "longest_word", "no_letters", "ending_marks", "same_characters", "colons", "brackets",
)
SYMBOLS = frozenset(b"#*$%&|<>=@~^_\\")
SHORT = 3


def features(text: str | None) -> list[float]:
    """Figures of a whole text; all are 0 for a text without words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    letters = int(count[65:91].sum() + count[97:123].sum() + count[128:].sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split("\n") if line]
    held: dict[str, int] = {}
    for w in words:
        held[w] = held.get(w, 0) + 1
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float(count[list(SYMBOLS)].sum() / size),
        marks / size,
        float(count[48:58].sum() / size),
        float(count[65:91].sum() / size),
        len(held) / n,
        sum(map(eq, words, words[1:])) / n,
        max(held.values()) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        float(np.log1p(n / max(len(lines), 1))),
        float((lengths <= SHORT).mean()),
        sum(not w.isalnum() and not any(map(str.isalnum, w)) for w in held) / len(held),
        float(np.log1p(lengths.max())),
        1 - letters / size,
        float((count[46] + count[33] + count[63]) / n),
        float(count[count > 0].max() / size),
        float((count[58] + count[59]) / n),
        float((count[40] + count[41] + count[91] + count[93] + count[123] + count[125]) / n),
    ]


@dataclass
class Ranking:
    """Weights of binned features, and the score that parts worse from better."""

    edges: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    at_cut: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Cumulative indicators: one column for each edge that a feature has passed."""
        return (x[:, :, None] > self.edges).reshape(len(x), -1).astype(np.float32)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.binned(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, and `at_cut` at the threshold."""
        z = self.slope * (self.raw(x) - self.cut) + np.log(self.at_cut / (1 - self.at_cut))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def learn(x: np.ndarray, label: np.ndarray, at_cut: float, edges: np.ndarray | None = None, penalty: float = 1e-3, rounds: int = 400) -> Ranking:
    """Fits weights to all preference pairs. Without both labels there is no preference, and all scores equal `at_cut`.

    The loss of a document is its mean over all documents of the other label. That mean depends on the document's score only, so it is
    worked out on a grid of scores, between whose points rows are dealt by distance: linear in the rows, and every pair counts.
    """
    quantiles = np.linspace(0, 1, BINS + 1)[:-1]
    if edges is None:
        edges = np.quantile(x, quantiles, axis=0).T if len(x) else np.zeros((len(FEATURES), BINS))
    ranking = Ranking(edges, np.zeros(edges.size, np.float32), 0.0, 1.0, at_cut)
    good, n_good = label == 1, int((label == 1).sum())
    if not n_good or n_good == len(label):
        return ranking
    z = ranking.binned(x)
    w, m, v = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for t in range(1, rounds + 1):  # gradient steps of adapted size
        s = (z @ w.astype(np.float32)).astype(np.float64)
        low, step = s.min(), max(float(s.max() - s.min()), 1e-9) / (GRID - 1)
        at = np.minimum(((s - low) / step).astype(np.int64), GRID - 2)
        part = (s - low) / step - at
        below = 1 / (1 + np.exp(np.clip(step * (np.arange(GRID)[:, None] - np.arange(GRID)), -40, 40)))  # chance that the first loses
        held = [np.bincount(at[k], 1 - part[k], GRID) + np.bincount(at[k] + 1, part[k], GRID) for k in (~good, good)]
        lost, won = below @ held[0] / (len(label) - n_good), below.T @ held[1] / n_good
        pull = np.where(good, lost[at] * (1 - part) + lost[at + 1] * part, 0) / n_good
        push = np.where(good, 0, won[at] * (1 - part) + won[at + 1] * part) / (len(label) - n_good)
        g = -((pull - push).astype(np.float32) @ z) + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    ranking.weights = w.astype(np.float32)
    raw = ranking.raw(x)
    ranking.cut = float(np.quantile(raw, 1 - n_good / len(x)))
    ranking.slope = float(1 / max(raw.std(), 1e-6)) * 2
    return ranking


def _ordered(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles; its own inverse on bit patterns."""
    bits = (x + 0.0).view(np.int64)  # -0.0 becomes 0.0
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def quantiles(rows: DataFrame, column: str, width: int, at: Sequence[float]) -> np.ndarray:
    """Exact quantiles (linear between rows, as numpy's) of each place of an array column over all rows: one line per place.

    Ranks are narrowed down by counting, eight bits of the values' order at a time; only the counts around the ranks leave the tasks.
    """
    ranks = (rows.count() - 1) * np.array(at)
    left = np.tile(np.concatenate([np.floor(ranks), np.ceil(ranks)]).astype(np.int64), (width, 1))
    prefix = np.zeros_like(left)
    for shift in range(56, -1, -8):

        def count(batches: Iterator[pa.RecordBatch], known: np.ndarray = prefix.copy(), shift: int = shift) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                for k in range(width):
                    cells = _ordered(np.ascontiguousarray(x[:, k])) >> np.int64(shift)
                    if shift < 56:
                        cells = cells[np.isin(cells >> np.int64(8), known[k])]
                    cells, counts = np.unique(cells, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(cells), pa.int32()), pa.array(cells), pa.array(counts)], names=["place", "cell", "n"])

        got = rows.select(column).mapInArrow(count, "place int, cell long, n long").groupBy("place", "cell").agg(F.sum("n").alias("n")).toArrow()
        place, cell, n = (got.column(c).to_numpy() for c in ("place", "cell", "n"))
        for k, j in np.ndindex(*left.shape):
            here = np.flatnonzero((place == k) & ((cell >> 8 == prefix[k, j]) | (shift == 56)))
            here = here[np.argsort(cell[here])]
            ends = np.cumsum(n[here])
            i = int(np.searchsorted(ends, left[k, j], side="right"))
            left[k, j] -= ends[i] - n[here[i]]
            prefix[k, j] = cell[here[i]]
    values = np.where(prefix < 0, prefix ^ np.int64(2**63 - 1), prefix).view(np.float64)
    a, b, part = values[:, : len(at)], values[:, len(at) :], ranks - np.floor(ranks)
    return np.where(part < 0.5, a + (b - a) * part, b - (b - a) * (1 - part))


def train(docs: DataFrame, labels: DataFrame, at_cut: float = 0.5, group_rows: int = GROUP_ROWS) -> Ranking:
    """A ranking from all labelled documents (labels: doc_id and quality, 1 or 0). Documents without a text or a label are left out.

    Bins and threshold are exact quantiles of all rows. Weights are learned on groups of about `group_rows` rows, dealt by hash, and averaged
    by the number of each group's rarer label; a label too rare for all groups lends each of its rows to several.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    figures = map_texts(docs.where("text is not null and doc_id is not null"), ["doc_id"], "x array<double>", lambda: lambda texts: [[features(t) for t in texts]])
    dealt = F.xxhash64("doc_id", "quality").alias("dealt")
    rows = written(figures.join(known.hint("merge"), "doc_id").select("x", "quality", dealt), "quality-features")
    number = {r.quality: r["count"] for r in rows.groupBy("quality").count().collect()}
    if len(number) < 2:
        return learn(np.empty((0, len(FEATURES))), np.empty(0, np.int64), at_cut)
    edges = quantiles(rows, "x", len(FEATURES), np.linspace(0, 1, BINS + 1)[:-1])
    groups = -(-sum(number.values()) // group_rows)
    copies = {q: min(groups, -(-LEAST * groups // n)) for q, n in number.items()}

    def one(table: pa.Table) -> pa.Table:
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
        label = table.column("quality").to_numpy()
        order = np.lexsort([label, *x.T])  # whatever order rows come in
        weights = learn(x[order], label[order], at_cut, edges).weights
        rarer = min(int((label == 1).sum()), int((label == 0).sum()))
        return pa.table({"dealt": [table.column("dealt")[0].as_py()], "n": [rarer], "weights": [weights.astype(float).tolist()]})

    spread = F.explode(F.sequence(F.lit(0), F.when(F.col("quality") == 1, copies[1]).otherwise(copies[0]) - 1))
    lent = rows.withColumn("copy", spread).withColumn("dealt", F.pmod(F.pmod("dealt", F.lit(groups)) + F.col("copy"), F.lit(groups)))
    learned = lent.groupBy("dealt").applyInArrow(one, "dealt long, n long, weights array<double>").orderBy("dealt").collect()
    weights = np.average([r.weights for r in learned], axis=0, weights=[r.n for r in learned]).astype(np.float32)
    ranking = Ranking(edges, weights, 0.0, 1.0, at_cut)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = ranking.raw(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(z.astype(float)), 1).cast(pa.list_(pa.float64()))], names=["raw"])

    raws = written(rows.select("x").mapInArrow(raw, "raw array<double>"), "quality-scores")
    ranking.cut = float(quantiles(raws, "raw", 1, [number[0] / sum(number.values())])[0, 0])
    ranking.slope = 2 / max(float(raws.agg(F.stddev_pop(F.col("raw")[0])).first()[0]), 1e-6)
    return ranking


def score(docs: DataFrame, ranking: Ranking, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns with score. Null texts count as empty; every row gives one row, repeated ones too."""

    def make() -> Callable:
        def run(texts: list[str | None]) -> list[list]:
            return [ranking.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))]

        return run

    return map_texts(docs, keep, "score double", make)
