"""Quality classifier: gated attention over the passages of a document.

A document is a bag of passages (runs of ``PASSAGE`` bytes of its UTF-8
text, whole text). Every passage is encoded by byte statistics and a learned
layer; gated attention weights, learned from document labels only, say how
much each passage counts, and the weighted passage representation is scored.

Training uses a bounded sample: at most ``SAMPLE_PER_CLASS`` labelled rows
of each class, taken in the order of a hash of their id among texts of up to
``SAMPLE_BYTES`` bytes. Ids choose the sample and the held-out fold and are
never an input of a score. Scoring reads every passage of every text.

Defined results: a null or empty text is one empty passage and gets a score
like any other; labels that are null or have no document are ignored; with
labels of one class only (or none) the score is that class (or 0.5)
everywhere; repeated documents are scored each; other columns are carried by
``with_score`` (whose new column name the caller chooses).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import prepare

PASSAGE = 512
SHORT = 32
SAMPLE_PER_CLASS = 1500
SAMPLE_BYTES = 32_000
BIGRAMS = 512
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE = 30, 64, 0.01
# Passages whose counts are made in one go, so that a very long text needs
# no more memory than a short one.
BLOCK = 2048
THRESHOLD = 0.3


def _class_table() -> np.ndarray:
    """A class per byte: control, space, digits, lower, upper, each other
    ASCII sign for itself, bytes of multi-byte characters."""
    table = np.zeros(256, np.int64)
    table[[9, 10, 13]] = 1
    table[32] = 2
    table[48:58] = 3
    table[97:123] = 4
    table[65:91] = 5
    table[128:192], table[192:] = 6, 7
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    table[signs] = np.arange(8, 8 + len(signs))
    return table


CLASSES = _class_table()
N_CLASSES = int(CLASSES.max()) + 1
N_FEATURES = N_CLASSES + BIGRAMS + 4


def _block_features(data: np.ndarray) -> np.ndarray:
    """Features of consecutive passages of one run of bytes."""
    n = max(1, -(-len(data) // PASSAGE))
    row = np.arange(len(data)) // PASSAGE
    sizes = np.maximum(np.bincount(row, minlength=n), 1).astype(np.float32)[:, None]
    kinds = CLASSES[data]
    out = np.zeros((n, N_FEATURES), np.float32)
    out[:, :N_CLASSES] = np.bincount(row * N_CLASSES + kinds, minlength=n * N_CLASSES).reshape(n, -1) / sizes
    if len(data) > 1:
        pair = ((data[:-1].astype(np.int64) << 8 | data[1:]) * 40503 >> 4) % BIGRAMS
        pairs = np.bincount(row[:-1] * BIGRAMS + pair, minlength=n * BIGRAMS).reshape(n, -1) / sizes
        out[:, N_CLASSES : N_CLASSES + BIGRAMS] = np.sqrt(pairs)
        out[:, -4] = (pairs**2).sum(axis=1) * 10
        out[:, -3] = pairs.max(axis=1) * 4
        starts = (kinds[1:] > 2) & (kinds[:-1] <= 2)
        out[:, -2] = np.bincount(row[:-1], weights=starts, minlength=n) / sizes[:, 0] * 4
    out[:, -1] = sizes[:, 0] / PASSAGE
    return out


def passage_blocks(text: str | None) -> Iterator[np.ndarray]:
    """Feature rows of all passages of a text, a bounded block at a time."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    step = BLOCK * PASSAGE
    for at in range(0, max(1, len(data)), step):
        yield _block_features(data[at : at + step])


class Model:
    """Gated-attention multiple-instance model (all parameters are small)."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def layer(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {
            "E": layer(N_FEATURES, HIDDEN), "e": np.zeros(HIDDEN, np.float32),
            "V": layer(HIDDEN, ATTENTION), "U": layer(HIDDEN, ATTENTION), "w": layer(ATTENTION),
            "c": layer(HIDDEN), "b": np.zeros(1, np.float32),
        }
        self.mean = np.zeros(N_FEATURES, np.float32)
        self.scale = np.ones(N_FEATURES, np.float32)
        self.constant: float | None = None

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.standardise(x) @ self.p["E"] + self.p["e"])

    def standardise(self, x: np.ndarray) -> np.ndarray:
        """Statistics of short passages are noisy: they are drawn towards the
        mean by n / (n + SHORT) for n bytes."""
        size = x[:, -1:] * PASSAGE
        return (x - self.mean) / self.scale * (size / (size + SHORT))

    def attend(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = np.tanh(h @ self.p["V"])
        g = 1 / (1 + np.exp(-(h @ self.p["U"])))
        return (t * g) @ self.p["w"], t, g

    def score(self, text: str | None) -> float:
        """Attention is a softmax over all passages, summed block by block
        (bounded logits need no running maximum)."""
        if self.constant is not None:
            return self.constant
        total, weighted = 0.0, np.zeros(HIDDEN)
        for x in passage_blocks(text):
            h = self.encode(x)
            a = np.exp(np.clip(self.attend(h)[0], -30, 30).astype(np.float64))
            total += a.sum()
            weighted += a @ h
        return float(1 / (1 + np.exp(-(weighted / total @ self.p["c"] + self.p["b"][0]))))

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels[0]) if len(labels) else 0.5
            return self
        stacked = np.concatenate(bags)
        self.mean = stacked.mean(axis=0)
        self.scale = stacked.std(axis=0) + 0.02
        rng = np.random.default_rng(seed)
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                grads = self._gradients([bags[i] for i in some], labels[some], weight[some])
                step += 1
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    s[k] = 0.999 * s[k] + 0.001 * grad**2
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, bags: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted cross entropy over one batch of bags."""
        sizes = np.array([len(x) for x in bags])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        bag = np.repeat(np.arange(len(bags)), sizes)
        x = self.standardise(np.concatenate(bags))
        h = np.tanh(x @ self.p["E"] + self.p["e"])
        logit, t, g = self.attend(h)
        a = np.exp(np.clip(logit, -30, 30))
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-(z @ self.p["c"] + self.p["b"])))
        dy = (y - labels) * weight / len(bags)
        dz = dy[:, None] * self.p["c"]
        da = (dz[bag] * h).sum(axis=1)
        dl = a * (da - np.add.reduceat(a * da, starts)[bag])
        dt = dl[:, None] * self.p["w"] * g * (1 - t**2)
        dg = dl[:, None] * self.p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz[bag] + dt @ self.p["V"].T + dg @ self.p["U"].T
        de = dh * (1 - h**2)
        return {
            "E": x.T @ de, "e": de.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
            "w": ((t * g) * dl[:, None]).sum(axis=0), "c": (z * dy[:, None]).sum(axis=0), "b": np.array([dy.sum()]),
        }


def in_fold(id_col, folds: int = 5) -> F.Column:
    """True for the held-out rows: crc32(id as text) mod ``folds`` is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Text and label of the bounded training sample (see the module text)."""
    order = F.xxhash64("id")
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "id is not null and label in (0, 1)"
    ).where(~in_fold("id")).distinct()
    small = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.octet_length("text") <= SAMPLE_BYTES
    )
    # Twice as many ids as rows, for those whose text is too long.
    ids = None
    for label in (0, 1):
        some = usable.where(F.col("label") == label).orderBy(order, "id").limit(2 * SAMPLE_PER_CLASS)
        ids = some if ids is None else ids.unionByName(some)
    rows = small.join(F.broadcast(ids), "id")  # at most 4 * SAMPLE_PER_CLASS ids
    parts = [rows.where(F.col("label") == label).orderBy(order, "id", "text").limit(SAMPLE_PER_CLASS) for label in (0, 1)]
    return parts[0].unionByName(parts[1]).select("text", "label")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on the sample. Its size is bounded by the two parameters, so its
    texts (at most 2 * SAMPLE_PER_CLASS * SAMPLE_BYTES bytes) may be fitted
    on the driver; they arrive there one partition at a time."""
    prepare(docs.sparkSession)
    bags, marks = [], []
    for row in training_sample(docs, labels, id_col, text_col, label_col).toLocalIterator():
        bags.append(np.concatenate(list(passage_blocks(row["text"]))).astype(np.float16))
        marks.append(row["label"])
    bags = [x.astype(np.float32) for x in bags]
    return Model().fit(bags, np.array(marks, np.float32))


def with_score(docs: DataFrame, model: Model, name: str = "score", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and the score of the whole text."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score, na_action=None).astype("float64")

    return docs.withColumn(name, score(F.col(text_col)))


def drop_rejected(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows scored ``threshold`` or more, columns unchanged."""
    columns = docs.columns
    name = "score"
    while name in columns:
        name += "_"
    return with_score(docs, model, name, text_col).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in columns])
