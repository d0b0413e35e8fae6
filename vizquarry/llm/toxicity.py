"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary text and one on those windows of toxic text that
the first explains worst. What the toxic dictionary holds is then held against distinct training windows of both
kinds, so that copies count once, and only word beginnings that are far more frequent in toxic text stay. Both compressors get the same
ordinary content at the same distance; before it one has the toxic segments, the other nothing. So the two lengths of
an ordinary window are nearly always equal, and a window's gain is what the toxic dictionary alone explains.

A text is cut into windows of ``WORDS`` words, without overlap. Its evidence is the sum of the gains of its windows
beyond ``SLACK`` bytes, against the logarithm of their number. The threshold on it is calibrated on the training
rows, and the score is a logistic curve that passes 0.5 there.

Defined results: null, empty and blank texts have no window, no evidence and the lowest score; without rows of both
labels, or without any telling segment, every score is 0 and predicted 0; equal texts get equal scores; an empty table gives an empty result; texts
are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vizquarry.llm import samples

WORDS = 12
SLACK = 1
#: Sizes of the two trained dictionaries, in bytes.
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 16_384
#: Windows of one training row that the dictionaries are made from: evenly spread ones beyond this number. The threshold
#: comes from whole texts.
TRAIN_WINDOWS = 300
SHARED_BYTES = 12_288
#: A telling segment has that many bytes; its share of toxic windows is that multiple of the ordinary one; and so large a
#: share of the segments kept may owe that to chance, however many windows there are.
LEAST_BYTES, LEAST_RATIO, FALSE_SHARE = 4, 5, 0.001
#: What may stand before a word, besides white space.
_SIGNS = bytes(k for k in range(33, 127) if not chr(k).isalnum())


def windows(text: str | None) -> list[bytes]:
    words = (text or "").lower().split()
    return [(" " + " ".join(words[at : at + WORDS]) + " ").encode() for at in range(0, len(words), WORDS)]


def compressor(content: bytes):
    import zstandard as z

    parameters = z.ZstdCompressionParameters(
        format=z.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_dict_id=0,
        write_checksum=0,
        window_log=16,
        hash_log=13,
        chain_log=13,
        search_log=3,
        min_match=4,
        target_length=8,
        strategy=z.STRATEGY_GREEDY,
    )
    dictionary = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
    return z.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


class Model:
    """Contents of both compressors, the threshold on the evidence and the width of the logistic curve.

    ``marks`` is a pattern that a window must hold to have a gain; without it each window may have one.
    """

    def __init__(self, ordinary: bytes, toxic: bytes, threshold: float = 0.0, width: float = 1.0, marks: bytes = b""):
        self.ordinary, self.toxic, self.threshold, self.width, self.marks = ordinary, toxic, threshold, width, marks
        self._made = None

    def __getstate__(self):
        return {**self.__dict__, "_made": None}

    def gains(self, pieces: list[bytes]) -> list[int]:
        if self._made is None:
            self._made = compressor(self.ordinary).compress, compressor(self.toxic).compress, re.compile(self.marks).search
        plain, toxic, marked = self._made
        return [len(plain(x)) - len(toxic(x)) if marked(x) else 0 for x in pieces]

    def evidence(self, pieces: list[bytes]) -> float:
        """Grows with each window that the toxic dictionary explains; long texts collect a little by chance."""
        total = sum(g - SLACK for g in self.gains(pieces) if g > SLACK)
        return total - 0.5 * math.log1p(len(pieces)) if pieces else -5.0

    def score(self, pieces: list[bytes]) -> float:
        x = (self.evidence(pieces) - self.threshold) / self.width
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def _trained(size: int, pieces: list[bytes]) -> bytes:
    import zstandard as z

    try:
        return z.train_dictionary(size, pieces).as_bytes()
    except z.ZstdError:  # too little text to train on: the text itself
        return b"".join(pieces)[-size:]


def _without_header(dictionary: bytes) -> bytes:
    """The content of a trained dictionary; its entropy tables come first and aren't text."""
    return dictionary[min(len(dictionary) // 4, 512) :] if dictionary[:4] == b"\x37\xa4\x30\xec" else dictionary


def beginnings(word: bytes) -> list[bytes]:
    """The word and what it may begin with, none cut inside a character."""
    ends = [k for k in range(LEAST_BYTES, len(word)) if word[k] & 0xC0 != 0x80]
    return [word[:k] for k in ends] + [word] * (len(word) >= LEAST_BYTES)


def chance(a: int, b: int, share: float) -> float:
    """Logarithm of the chance that ``a`` or more of a + b fall where the share ``share`` belongs (a bound, exact for b = 0)."""
    n = a + b
    x = a / n
    if x <= share:
        return 0.0
    return n * (x * math.log(share / x) + ((1 - x) * math.log((1 - share) / (1 - x)) if b else 0.0))


def telling_segments(candidates: set[bytes], toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[bytes]:
    """Word beginnings that toxic text has far more often, from the windows of distinct rows.

    Both distinct windows and rows are counted, so neither copies nor one long row make a segment telling. The chance
    of such counts is held against a false-discovery bound, which asks for the same certainty of small and large samples.
    """
    known: dict[bytes, list[bytes]] = {}
    counts, sizes = [], []
    for rows in (toxic, ordinary):
        by_window, by_row, seen = Counter(), Counter(), set()
        for row in rows:
            inside = set()
            for window in row:
                if window in seen:
                    continue
                seen.add(window)
                own = set()
                for word in window.split():
                    word = word.lstrip(_SIGNS)
                    if word not in known:
                        known[word] = [s for s in beginnings(word) if s in candidates]
                    own.update(known[word])
                by_window.update(own)
                inside |= own
            by_row.update(inside)
        counts.append((by_window, by_row))
        sizes.append((len(seen), len(rows)))
    shares = [sizes[0][k] / (sizes[0][k] + sizes[1][k]) for k in (0, 1)]
    tested = sorted((max(chance(counts[0][k][s], counts[1][k][s], shares[k]) for k in (0, 1)), -len(s), s) for s in counts[0][0])
    last = max((k for k, x in enumerate(tested, 1) if x[0] <= math.log(FALSE_SHARE * k / len(tested))), default=0)
    kept: list[bytes] = []
    for _, _, s in tested[:last]:
        n, m = counts[0][0][s], counts[1][0][s]
        longer = sum(counts[0][0][x] for x in kept if x.startswith(s))
        if n * sizes[1][0] >= LEAST_RATIO * m * sizes[0][0] and n > longer and not any(s.startswith(x) for x in kept):
            kept.append(s)
    return sorted(kept)


def marks(kept: list[bytes], ordinary: list[bytes]) -> bytes:
    """Pattern of the segments: where a word begins, or anywhere if ordinary text never has them inside a word."""
    text = b"\n".join(ordinary)
    free = {s for s in kept if text.count(s) == text.count(b" " + s)}
    begin = b"[\\s" + re.escape(_SIGNS) + b"]"
    return b"|".join(re.escape(s) if s in free else begin + re.escape(s) for s in kept)


def fit(rows: list[tuple[int, list[bytes]]]) -> Model | None:
    """From (label, windows) of the training rows."""
    by_label = {k: sorted({w for y, own in rows if y == k for w in own}) for k in (0, 1)}
    if not by_label[0] or not by_label[1]:
        return None
    draw = np.random.default_rng(11)

    def some(pieces, n):
        return [pieces[k] for k in draw.choice(len(pieces), min(n, len(pieces)), replace=False)]

    ordinary = _without_header(_trained(ORDINARY_BYTES, some(by_label[0], 30_000)))[-SHARED_BYTES:]
    first = _without_header(_trained(ORDINARY_BYTES, some(by_label[1], 30_000)))[-SHARED_BYTES:]
    gains = Model(ordinary, first).gains(by_label[1])
    order = np.argsort(np.negative(gains), kind="stable")
    worst = [by_label[1][k] for k in order[: max(200, len(order) // 3)]]
    toxic = _without_header(_trained(TOXIC_BYTES, worst))
    candidates = {s for x in toxic.split() for word in (x.lstrip(_SIGNS), x.strip(_SIGNS)) for s in beginnings(word)}
    distinct = [sorted({tuple(own) for y, own in rows if y == k and own}) for k in (1, 0)]
    kept = telling_segments(candidates, *distinct)
    if not kept:
        return None
    segment = b" " + b" ".join(kept) + b" "
    return Model(b"\n" * len(segment) + ordinary, segment + ordinary, marks=marks(kept, by_label[0]))


def calibrate(model: Model, rows: list[tuple[float, int]]) -> None:
    """The threshold with the best F1 on (evidence, label) of the training rows, in the middle of its gap."""
    found = sorted(rows, reverse=True)
    positives, hits, best = sum(y for _, y in found), 0, (-1.0, 0.0)
    for k, (x, y) in enumerate(found):
        hits += y
        below = found[k + 1][0] if k + 1 < len(found) else x - 1
        if below < x:
            best = max(best, (2 * hits / (positives + k + 1), (x + below) / 2))
    model.threshold = best[1]
    model.width = max(0.5, float(np.std([x for x, _ in found])) / 4)


def _cut(batches):
    import pyarrow as pa

    for batch in batches:
        made = []
        for x in batch.column("text"):
            own = windows(x.as_py())
            made.append(own[:: -(-len(own) // TRAIN_WINDOWS)] if own else [])
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(made, pa.list_(pa.binary()))], ["label", "windows"])


def _evident(model: Model):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = [model.evidence(windows(x.as_py())) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.float64()), batch.column("label")], ["evidence", "label"])

    return run


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str, text: str, label: str, per_label: int = 1500) -> Model | None:
    """Fit on about ``per_label`` rows of each label at most."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")
    )
    known = samples.bounded_sample(known.where(learn), "label", "id", per_label)
    rows = samples.sampled_texts(docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")), known)
    found = rows.mapInArrow(_cut, "label int, windows array<binary>").toArrow()
    model = fit(sorted(zip(found.column("label").to_pylist(), found.column("windows").to_pylist())))
    if model is not None:  # on whole texts, as they are scored
        found = rows.mapInArrow(_evident(model), "evidence double, label int").toArrow()
        calibrate(model, list(zip(found.column("evidence").to_pylist(), found.column("label").to_pylist())))
    return model


def _scored(model: Model | None, limit: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [model.score(windows(x.as_py())) if model else 0.0 for x in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([int(s >= limit) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return run


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    folds: int = 5,
    held_out: int = 0,
    limit: float = 0.5,
    per_label: int = 1500,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; the fold ``held_out`` teaches nothing."""
    model = train(docs, labels, samples.remainder("id", folds) != held_out, id_column, text, label, per_label)
    out = samples.remainder(id_column, folds) == held_out
    rows = docs.select(F.col(id_column).alias("doc_id"), out.alias("held_out"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int"
    return rows.mapInArrow(_scored(model, limit), schema)
