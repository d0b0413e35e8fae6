"""Language identification with string kernels.

The kernel of two texts is the mean over n = 1 .. 4 of the cosine of their n-gram presence vectors (which n-grams
occur at all, hashed into a fixed number of bins per n). A bounded sample gives landmarks and training rows; Nyström
features are the kernel values against the landmarks, whitened; one kernel ridge regression per language is fitted
on them, one against the rest. A batch of texts is scored by matrix products: presence times landmark matrix times
weights. The last two factors don't depend on the text and are multiplied once.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and where no labelled row exists;
equal texts get equal results; whole texts are read, whatever their length; an empty table gives an empty result.
Labels of any number of languages are learned; the training sample holds about ``per_language`` rows of each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vizquarry.llm import samples

#: log2 of the bins for n = 1, 2, 3, 4.
BINS = (10, 12, 13, 13)
SIZES = tuple(1 << b for b in BINS)
OFFSETS = tuple(int(x) for x in np.cumsum([0, *SIZES]))
ODD = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
SHARPNESS = 4.0
#: Documents of one matrix product: 128 x 21,504 presence bytes.
BATCH = 128
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """True for the code points that are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def presence(text: str | None, row: np.ndarray) -> bool:
    """Mark the n-grams of a text in ``row``; False if it has no letter. Runs of other characters are one blank."""
    if not text:
        return False
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return False
    codes = np.where(letter, points, 32).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate([[np.uint64(32)], codes[keep], [np.uint64(32)]])
    rolled = codes
    for n, bits in enumerate(BINS):
        if n:
            rolled = rolled[:-1] * ODD + codes[n:]
        row[OFFSETS[n] + (((rolled ^ (rolled >> np.uint64(29))) * ODD) >> np.uint64(64 - bits)).astype(np.int64)] = 1
    return True


def norms(rows: np.ndarray) -> np.ndarray:
    """1 / length of each row's presence vector, for each n."""
    counts = np.stack([rows[:, a:b].sum(axis=1, dtype=np.int64) for a, b in zip(OFFSETS, OFFSETS[1:])], axis=1)
    return 1.0 / np.sqrt(np.maximum(counts, 1))


def kernel(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The blended-spectrum presence kernel of all pairs."""
    total = np.zeros((len(rows), len(others)), dtype=np.float64)
    x, y = norms(rows), norms(others)
    for n, (a, b) in enumerate(zip(OFFSETS, OFFSETS[1:])):
        total += (rows[:, a:b].astype(np.float32) @ others[:, a:b].astype(np.float32).T) * x[:, n, None] * y[None, :, n]
    return total / len(BINS)


class Model:
    """languages, and per n a matrix (bins x languages) that takes normalised presence to outputs."""

    def __init__(self, languages: list[str], parts: list[np.ndarray], bias: np.ndarray):
        self.languages, self.parts, self.bias = languages, parts, bias

    def outputs(self, rows: np.ndarray) -> np.ndarray:
        scale = norms(rows)
        found = np.tile(self.bias, (len(rows), 1))
        for n, (a, b) in enumerate(zip(OFFSETS, OFFSETS[1:])):
            found += (rows[:, a:b].astype(np.float32) @ self.parts[n]) * scale[:, n, None] / len(BINS)
        return found

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        found = self.outputs(rows) * SHARPNESS
        found = np.exp(found - found.max(axis=1, keepdims=True))
        found /= found.sum(axis=1, keepdims=True)
        best = found.argmax(axis=1)
        return [self.languages[k] for k in best], found[np.arange(len(best)), best]


def fit(rows: np.ndarray, labels: list[str], landmarks: int = 256, ridge: float = 1e-2) -> Model | None:
    """Landmarks are spread over the languages in turn; copies among them are left out."""
    languages = sorted(set(labels))
    if not languages:
        return None
    by_language = [[k for k, x in enumerate(labels) if x == lang] for lang in languages]
    chosen, seen = [], set()
    for turn in range(max(map(len, by_language))):
        for own in by_language:
            if turn < len(own) and len(chosen) < max(landmarks, len(languages)):
                key = rows[own[turn]].tobytes()
                if key not in seen:
                    seen.add(key)
                    chosen.append(own[turn])
    marks = rows[chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.concatenate([kernel(rows[at : at + 512], marks) for at in range(0, len(rows), 512)]) @ whiten
    targets = np.array([[1.0 if x == lang else -1.0 for lang in languages] for x in labels])
    # Each language weighs the same, however many rows it has.
    weight = np.array([1.0 / labels.count(x) for x in labels])[:, None]
    weight *= len(labels) / weight.sum()
    middle, centre = (features * weight).mean(axis=0), (targets * weight).mean(axis=0)
    left = (features - middle) * np.sqrt(weight)
    right = (targets - centre) * np.sqrt(weight)
    solved = np.linalg.solve(left.T @ left + ridge * len(labels) * np.eye(left.shape[1]), left.T @ right)
    onto = whiten @ solved
    scale = norms(marks)
    parts = [(marks[:, a:b].astype(np.float64).T * scale[:, n]) @ onto for n, (a, b) in enumerate(zip(OFFSETS, OFFSETS[1:]))]
    return Model(languages, [p.astype(np.float32) for p in parts], centre - middle @ solved)


def _marked(batches):
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            rows = np.zeros((part.num_rows, OFFSETS[-1]), dtype=np.uint8)
            good = [presence(x.as_py(), rows[k]) for k, x in enumerate(part.column("text"))]
            packed = np.packbits(rows, axis=1)
            marks = pa.array([packed[k].tobytes() for k in range(len(good))], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("label"), marks], ["label", "marks"]).filter(pa.array(good, pa.bool_()))


def train(docs: DataFrame, learn: Column, id_column: str, text: str, lang: str, per_language: int = 400, landmarks: int = 256) -> Model | None:
    """Fit on rows where ``learn`` holds; 2.7 kB of presence bits per sampled row go to the driver."""
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("label")
    )
    sample = samples.bounded_sample(rows, "label", "id", per_language).select("text", "label")
    found = sample.mapInArrow(_marked, "label string, marks binary").orderBy(F.xxhash64("label", "marks"), "label", "marks").toArrow()
    if not found.num_rows:
        return None
    packed = np.stack([np.frombuffer(x.as_py(), dtype=np.uint8) for x in found.column("marks")])
    return fit(np.unpackbits(packed, axis=1, count=OFFSETS[-1]), found.column("label").to_pylist(), landmarks)


def _predicted(model: Model | None):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            langs, scores = [], []
            for at in range(0, batch.num_rows, BATCH):
                part = batch.column("text").slice(at, BATCH)
                rows = np.zeros((len(part), OFFSETS[-1]), dtype=np.uint8)
                good = [presence(x.as_py(), rows[k]) for k, x in enumerate(part)]
                names, values = model.predict(rows) if model else ([UNKNOWN] * len(good), np.zeros(len(good)))
                langs.extend(x if g else UNKNOWN for x, g in zip(names, good))
                scores.extend(float(v) if g else 0.0 for v, g in zip(values, good))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    per_language: int = 400,
    landmarks: int = 256,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; the fold ``held_out`` teaches nothing."""
    out = samples.remainder(id_column, folds) == held_out
    model = train(docs, ~out, id_column, text, lang, per_language, landmarks)
    rows = docs.select(F.col(id_column).alias("doc_id"), out.alias("held_out"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(_predicted(model), schema)
