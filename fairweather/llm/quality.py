"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are binned by quantiles of the training rows; every tree is grown
level by level from histograms of gradients. The fitted trees are flattened
into arrays, and a batch of documents walks through all trees at once.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweather.llm.line_frequency import word_statistics

# Labelled rows learnt from, about: more are thinned by a hash of the text.
TRAINING_ROWS = 20_000
BINS = 64


@dataclass(frozen=True)
class Settings:
    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    smoothing: float = 1.0
    least_rows: float = 1.0  # of summed curvature in a leaf, times four about its rows


FEATURES = [
    "log_words",
    "word_length",
    "symbol_share",
    "repeated_line_share",
    "repeated_word_share",
    "distinct_word_share",
    "upper_share",
    "digit_share",
    "punctuation_share",
    "letter_share",
    "line_length",
    "top_word_share",
    "ends_share",
    "exclamation_share",
    "bar_share",
]


def document_statistics(text: str | None) -> list[float]:
    """The statistics of one text; all zero for a null or empty one."""
    text = text or ""
    n_words, word_chars, n_symbols, dup_lines, repeated = word_statistics(text)
    if not n_words:
        return [0.0] * len(FEATURES)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    distinct = Counter(text)
    total = {"upper": 0, "digit": 0, "alpha": 0, "space": 0}
    for char, n in distinct.items():
        total["upper"] += n * char.isupper()
        total["digit"] += n * char.isdigit()
        total["alpha"] += n * char.isalpha()
        total["space"] += n * char.isspace()
    chars = len(text)
    punctuation = chars - total["alpha"] - total["digit"] - total["space"]
    return [
        float(np.log1p(n_words)),
        word_chars / n_words,
        n_symbols / chars,
        dup_lines / max(1, len(lines)),
        repeated / n_words,
        len(counts) / max(1, len(words)),
        total["upper"] / chars,
        total["digit"] / chars,
        punctuation / chars,
        total["alpha"] / chars,
        chars / max(1, len(lines)),
        max(counts.values(), default=0) / n_words,
        sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / max(1, len(lines)),
        distinct["!"] / n_words,
        distinct["|"] / n_words,
    ]


@dataclass(frozen=True)
class Trees:
    """Flattened trees: nodes of all trees in one array, children beside each other.

    An inner node sends values up to ``limit`` of its feature to ``child``,
    others to ``child + 1``; a leaf is its own child and has an infinite limit.
    """

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of features."""
        at = np.broadcast_to(self.roots, (len(features), len(self.roots)))
        row = np.arange(len(features))[:, None]
        for _ in range(self.depth):
            at = self.child[at] + (features[row, self.feature[at]] > self.limit[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit(features: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Trees:
    """Boost trees on the logistic loss; one class alone, or no row, gives a constant."""
    positive = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(positive / (1 - positive)))
    n_features = features.shape[1]
    cuts = [
        np.unique(np.quantile(features[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(features) else np.zeros(0)
        for f in range(n_features)
    ]
    binned = np.stack([np.searchsorted(c, features[:, f]) for f, c in enumerate(cuts)], axis=1)
    slots = binned + np.arange(n_features) * BINS
    raw = np.full(len(labels), base)
    nodes: list[list] = []  # feature, limit, child, value
    roots = []
    for _ in range(settings.trees if 0 < labels.sum() < len(labels) else 0):
        p = 1 / (1 + np.exp(-raw))
        gradient, curvature = labels - p, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, np.inf, len(nodes), 0.0])
        at = np.full(len(labels), roots[-1])
        level = [roots[-1]]
        for depth in range(settings.depth + 1):
            code = np.full(len(nodes), -1)
            code[level] = np.arange(len(level))
            own = code[at]
            here = own >= 0
            size = len(level) * n_features * BINS
            index = (own[here, None] * (n_features * BINS) + slots[here]).ravel()
            g, h = (
                np.bincount(index, np.repeat(v[here], n_features), size).reshape(len(level), n_features, BINS)
                for v in (gradient, curvature)
            )
            total_g, total_h = g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)
            left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
            right_g, right_h = total_g[:, None, None] - left_g, total_h[:, None, None] - left_h
            s = settings.smoothing
            gain = left_g**2 / (left_h + s) + right_g**2 / (right_h + s) - (total_g**2 / (total_h + s))[:, None, None]
            gain[(left_h < settings.least_rows) | (right_h < settings.least_rows)] = -np.inf
            best = gain.reshape(len(level), -1).argmax(axis=1)
            following = []
            for k, node in enumerate(level):
                f, b = divmod(int(best[k]), BINS)
                if depth == settings.depth or gain[k, f, b] <= 1e-9 or b >= len(cuts[f]):
                    nodes[node][3] = settings.rate * total_g[k] / (total_h[k] + s)
                    continue
                child = len(nodes)
                nodes[node][:3] = [f, cuts[f][b], child]
                nodes += [[0, np.inf, child + side, 0.0] for side in (0, 1)]
                following += [child, child + 1]
                mine = np.flatnonzero(at == node)
                at[mine] = child + (binned[mine, f] > b)
            level = following
            if not level:
                break
        raw += np.array([n[3] for n in nodes])[at]
    table = list(zip(*nodes, strict=True)) if nodes else [[], [], [], []]
    return Trees(
        np.array(roots, np.int64),
        np.array(table[0], np.int64),
        np.array(table[1], float),
        np.array(table[2], np.int64),
        np.array(table[3], float),
        settings.depth,
        base,
    )


def _with_statistics(documents: DataFrame, text: str) -> DataFrame:
    columns = documents.columns

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [document_statistics(t) for t in batch.column(columns.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.list_(pa.float64()))], [*columns, "_statistics"]
            )

    schema = documents.select("*", F.array().cast("array<double>").alias("_statistics")).schema
    return documents.mapInArrow(measure, schema)


def learn(labelled: DataFrame, text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Trees:
    """Trees from labelled texts (label 0 or 1; others and null texts are left out).

    The statistics of about ``TRAINING_ROWS`` rows, a part chosen by a hash of
    the text and all other columns, reach the driver; nothing else of the corpus
    does. Copies of a text that another column tells apart, such as an id, are
    drawn each; of rows that repeat in every column at most twice as many are
    taken.
    """
    others = [F.col(f"`{c}`") for c in labelled.columns if c not in (text, label)]
    usable = labelled.where(F.col(label).isin(0, 1) & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.xxhash64(text, *others).alias("draw")
    )
    share = min(1.0, TRAINING_ROWS / max(1, usable.count()))
    drawn = usable.where(F.pmod("draw", F.lit(1 << 20)) < share * (1 << 20)).limit(2 * TRAINING_ROWS)
    rows = _with_statistics(drawn, "text").select("label", "_statistics").toPandas()
    # the same order whatever the tasks' order, so that the trees are the same
    features = np.array(rows["_statistics"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort((*features.T, rows["label"].to_numpy()))
    return fit(features[order], rows["label"].to_numpy(float)[order], settings)


def predict(documents: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """Documents with ``score``, the probability of label 1; null and empty texts too."""
    columns = documents.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [document_statistics(t) for t in batch.column(columns.index(text)).to_pylist()]
            scores = trees.score(np.array(values, float).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*columns, "score"])

    return documents.mapInArrow(score, documents.select("*", F.lit(0.0).alias("score")).schema)
