"""Quality rules: base counts, and how far a document's histograms are from those of its language.

Two histograms are compared with the language's own by Jensen-Shannon distance (base 2, so 0 to 1): characters by
class, and words by the language's common words with one bin for all others. A distance is judged only where the
document is long enough for it to mean something; above its limit the document is rejected.

References cover all documents. Common words are those with at least ``share`` of a language's words. Each batch names
every word that has half that share among its own; what a word of the full share isn't named for is less than half
of it, so the sums of the reports leave at most 2 / share words per language with none missing, and a second pass
counts those exactly. Languages with less than ``least_share`` of all words, and documents without one, share a
reference.

Defined results: a null text has no words and fails the base rules; null and rare languages have the joint reference;
repeated rows count as often as they occur; ties need no rule; an empty table gives an empty result; only the id,
text and language columns are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vizquarry.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Character classes: capitals, other letters, digits, marks and symbols, sentence punctuation, white space.
N_CLASSES = 6
SENTENCE = ".,;:!?'\"()-"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
JOINT = ""
WINDOW = 8
#: Limits of the two distances and the least characters and words they are judged on.
CLASS_LIMIT, LEAST_CHARS = 0.30, 200
WORD_LIMIT, LEAST_WORDS = 0.40, 50
_TABLE: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The class of every code point."""
    if not _TABLE:
        table = np.full(0x110000, 3, dtype=np.uint8)
        for code in range(0x110000):
            kind = unicodedata.category(chr(code))
            if kind[0] == "L":
                table[code] = 0 if kind in ("Lu", "Lt") else 1
            elif kind == "Nd":
                table[code] = 2
        table[[ord(c) for c in SENTENCE]] = 4
        table[[ord(c) for c in WHITE]] = 5
        _TABLE.append(table)
    return _TABLE[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    # Name each run of 2, 4, 8 ... words by a number of its own; exact, without hashes.
    have, names = 1, ids
    while have < window:
        step = min(have, window - have)
        pair = names[: len(names) - step] * (int(names.max()) + 1) + names[step:]
        names = np.unique(pair, return_inverse=True)[1].reshape(-1)
        have += step
    often = np.bincount(names)[names] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(often)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def _candidates(share: float):
    """Per batch and language: words with at least half the share among its own, and (no word) the number of words."""

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            seen: dict[str | None, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if text.is_valid:
                    seen.setdefault(lang, Counter()).update(WORD.findall(text.as_py()))
            rows = []
            for lang, words in seen.items():
                total = sum(words.values())
                rows.append((lang, None, total))
                rows.extend((lang, w, n) for w, n in words.items() if n >= share / 2 * total)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    return run


def common_candidates(docs: DataFrame, share: float, least_share: float) -> dict[str, list[str]]:
    """For each reference the words that may be common; at most 2 / share each, and at most 1 / least_share languages."""
    found = docs.mapInArrow(_candidates(share), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found = cut_lineage(found)
    totals = found.where("word IS NULL")
    whole = totals.agg(F.sum("n")).first()[0] or 0
    wide = totals.where(F.col("lang").isNotNull() & (F.col("n") >= least_share * whole))
    wide = wide.select("lang", F.concat(F.lit("="), "lang").alias("ref"))
    named = found.join(wide, "lang", "left").select(F.coalesce("ref", F.lit(JOINT)).alias("ref"), "word", "n")
    sums = named.groupBy("ref", "word").agg(F.sum("n").alias("n"))
    least = sums.where("word IS NULL").select("ref", (share / 2 * F.col("n")).alias("least"))
    words = sums.where("word IS NOT NULL").join(least, "ref").where("n >= least")
    kept: dict[str, list[str]] = {r.ref: [] for r in wide.select("ref").collect()}
    for r in words.select("ref", "word").collect():
        kept.setdefault(r.ref, []).append(r.word)
    return {k: sorted(v) for k, v in kept.items()}


MEASURES = "doc_id long, ref string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<long>, word_ids array<int>, word_counts array<long>"


def _measured(candidates: dict[str, list[str]]):
    numbers = {ref: {w: k for k, w in enumerate(words)} for ref, words in candidates.items()}

    def run(batches):
        import pyarrow as pa

        table, symbols = class_table(), [ord(c) for c in SYMBOLS]
        for batch in batches:
            rows = []
            for key, text, lang in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("lang").to_pylist()):
                text = text.as_py() or ""
                ref = JOINT if lang is None or "=" + lang not in numbers else "=" + lang
                words = WORD.findall(text)
                points = code_points(text)
                classes = np.bincount(table[points], minlength=N_CLASSES)
                n_symbols = int(np.isin(points, symbols).sum()) if classes[3] else 0
                known = numbers.get(ref, {})
                counts = Counter(filter(known.__contains__, words))
                rows.append(
                    (
                        key,
                        ref,
                        len(words),
                        len(points) - int(classes[5]),
                        n_symbols,
                        duplicate_lines(text),
                        repeated_words(words),
                        classes.tolist(),
                        [known[w] for w in counts],
                        list(counts.values()),
                    )
                )
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 10, kinds)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in MEASURES.split(", ")])

    return run


def references(measured: DataFrame, candidates: dict[str, list[str]], share: float) -> dict[str, tuple]:
    """Per reference: class shares, the numbers of its common words, and their shares with that of the rest."""
    classes = measured.select("ref", "n_words", *[F.col("classes")[k].alias(f"c{k}") for k in range(N_CLASSES)])
    sums = classes.groupBy("ref").agg(F.sum("n_words").alias("words"), *[F.sum(f"c{k}").alias(f"c{k}") for k in range(N_CLASSES)])
    pairs = measured.select("ref", F.explode(F.arrays_zip("word_ids", "word_counts")).alias("x"))
    counts = pairs.groupBy("ref", F.col("x.word_ids").alias("word")).agg(F.sum("x.word_counts").alias("n"))
    found = {r.ref: ([r[f"c{k}"] for k in range(N_CLASSES)], r.words) for r in sums.collect()}
    if not found:
        return {}
    words: dict[str, dict[int, int]] = {ref: {} for ref in found}
    for r in counts.collect():  # at most 2 / share for each of at most 1 / least_share references
        words[r.ref][r.word] = r.n
    made = {}
    for ref, (class_sums, total) in found.items():
        common = sorted(k for k, n in words[ref].items() if n >= share * total)
        shares = [words[ref][k] / total for k in common]
        all_classes = max(1, sum(class_sums))
        made[ref] = ([c / all_classes for c in class_sums], common, [*shares, max(0.0, 1.0 - sum(shares))])
    return made


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two distributions, base 2."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum()
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum()
    return float(np.sqrt(max(0.0, (a + b) / 2)))


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def _judged(refs: dict[str, tuple]):
    at = {ref: {k: i for i, k in enumerate(common)} for ref, (_, common, _) in refs.items()}

    def run(batches):
        import pyarrow as pa

        kinds = [*[pa.int64()] * 6, pa.bool_(), pa.bool_(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                shares, common, word_shares = refs[r["ref"]]
                n_chars = sum(r["classes"])
                by_class = by_word = None
                if n_chars >= LEAST_CHARS:
                    by_class = distance(np.array(r["classes"]) / n_chars, np.array(shares))
                if r["n_words"] >= LEAST_WORDS:
                    own = np.zeros(len(common) + 1)
                    for k, n in zip(r["word_ids"], r["word_counts"]):
                        if k in at[r["ref"]]:
                            own[at[r["ref"]][k]] = n / r["n_words"]
                    own[-1] = max(0.0, 1.0 - own.sum())
                    by_word = distance(own, np.array(word_shares))
                failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
                far = (by_class or 0.0) > CLASS_LIMIT or (by_word or 0.0) > WORD_LIMIT
                rows.append(
                    (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], failed, not failed and not far, by_class, by_word)
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 10, kinds)], names)

    return run


def quality_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    share: float = 0.005,
    least_share: float = 0.001,
) -> DataFrame:
    """Counts, base_failed, kept and both distances (null: too short to judge) of every document."""
    read = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    candidates = common_candidates(read.select("lang", "text"), share, least_share)
    measured = cut_lineage(read.mapInArrow(_measured(candidates), MEASURES))
    refs = references(measured, candidates, share)
    return measured.mapInArrow(_judged(refs), RESULT)
