"""Quality classification: hashed word n-grams, logistic regression, follow-the-regularised-leader updates.

Tokens are words and runs of marks, as written; their uni- and bigrams are hashed into ``2 ** BITS`` bins and a
document is the set of its bins, scaled to length one. The regression is fitted on a bounded sample of labelled
rows with FTRL-proximal updates (L1 and L2), rows weighted so that both labels weigh the same. A score is the sparse dot
product of a document's bins with the weights, through the logistic function.

Defined results: null and empty texts have no n-gram and get the score of the bias alone; without labelled rows all
scores are 0.5; with one label only the fit still runs and tends to that label; labels of repeated ids are all used;
equal texts get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vizquarry.llm import samples

BITS = 18
TOKEN = re.compile(r"\w+|[^\w\s]+")
MEMO = 400_000
#: Bytes of bins that the fit takes, in the order of their digests.
LEARN_BYTES = 256 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: The bigram of a token with itself, whichever it is.
_SAME = np.uint64(0xD6E8FEB86659FD93)
_TOKENS: dict[str, int] = {}


def features(text: str | None) -> np.ndarray:
    """The distinct bins of a text, ascending."""
    import xxhash

    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.zeros(0, dtype=np.int32)
    missing = set(tokens).difference(_TOKENS)
    if missing:
        if len(_TOKENS) + len(missing) > MEMO:
            _TOKENS.clear()
            missing = set(tokens)
        _TOKENS.update((x, xxhash.xxh3_64_intdigest(x)) for x in missing)
    one = np.fromiter(map(_TOKENS.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    two = np.where(one[:-1] == one[1:], _SAME, one[:-1] * _MIX + one[1:])
    both = np.concatenate([one, two]) * _MIX >> np.uint64(64 - BITS)
    seen = np.zeros(1 << BITS, dtype=bool) if len(both) > 4096 else None
    if seen is None:
        return np.unique(both).astype(np.int32)
    seen[both.astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


class FTRL:
    """FTRL-proximal for logistic loss on sparse binary rows scaled to length one; the last weight is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def update(self, bins: np.ndarray, label: int, weight: float) -> None:
        at = np.append(bins, len(self.z) - 1)
        x = np.append(np.full(len(bins), 1 / np.sqrt(max(1, len(bins)))), 1.0)
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g

    def all_weights(self) -> np.ndarray:
        return self.weights(slice(None))


def fit(rows: list[tuple[np.ndarray, int]], passes: int = 4) -> np.ndarray | None:
    if not rows:
        return None
    model, draw = FTRL(), np.random.default_rng(7)
    share = [max(1, sum(y == k for _, y in rows)) for k in (0, 1)]
    weight = [len(rows) / 2 / n for n in share]
    for _ in range(passes):
        for k in draw.permutation(len(rows)):
            bins, label = rows[k]
            model.update(bins, label, weight[label])
    return model.all_weights()


def score(bins: np.ndarray, weights: np.ndarray | None) -> float:
    if weights is None:
        return 0.5
    total = weights[bins].sum() / np.sqrt(max(1, len(bins))) + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def _hashed(batches):
    import pyarrow as pa

    for batch in batches:
        made = [features(x.as_py()).tobytes() for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(made, pa.binary())], ["label", "bins"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str, text: str, label: str, per_label: int = 3000) -> np.ndarray | None:
    """Weights from about ``per_label`` rows of each label at most; their bins go to the driver, ``LEARN_BYTES`` of them at most."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")
    )
    known = samples.bounded_sample(known.where(learn), "label", "id", per_label)
    rows = samples.sampled_texts(docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")), known)
    found = rows.mapInArrow(_hashed, "label int, bins binary").orderBy(F.xxhash64("bins"), "label")
    learned, size = [], 0
    for label, bins in found.toLocalIterator():
        size += len(bins)
        if size > LEARN_BYTES:
            break
        learned.append((np.frombuffer(bins, dtype=np.int32), label))
    return fit(learned)


def _scored(weights: np.ndarray | None, limit: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [score(features(x.as_py()), weights) for x in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([int(s >= limit) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return run


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = 5,
    held_out: int = 0,
    limit: float = 0.3,
    per_label: int = 3000,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; the fold ``held_out`` teaches nothing."""
    weights = train(docs, labels, samples.remainder("id", folds) != held_out, id_column, text, label, per_label)
    out = samples.remainder(id_column, folds) == held_out
    rows = docs.select(F.col(id_column).alias("doc_id"), out.alias("held_out"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int"
    return rows.mapInArrow(_scored(weights, limit), schema)
