"""Bounded training samples and what the learned operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vizquarry.session import cut_lineage

_FRACTIONS = 1 << 20
#: Sampled ids are sent to the executors up to so many (16 bytes each), joined by shuffle beyond.
SENT_IDS = 1_000_000


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % divisor


def bounded_sample(rows: DataFrame, label: str, id_column: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label at most, chosen by a hash of the id; no label is dealt to one task.

    Only the number of rows per label goes to the driver.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_column)), F.lit(_FRACTIONS))
    wanted = F.lit(False)
    for value, n in counts.items():
        wanted = wanted | ((F.col(label) == F.lit(value)) & (part < F.lit(min(_FRACTIONS, int(_FRACTIONS * per_label / n)))))
    return rows.where(wanted)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(text, label) of the rows of ``docs`` (id, text) in a bounded ``sample`` (id, label), read once and stored.

    A filter doesn't lower Spark's size estimate, so the ids are stored and counted; the texts stay where they are.
    """
    sample = cut_lineage(sample)
    known = F.broadcast(sample) if sample.count() <= SENT_IDS else sample
    return cut_lineage(docs.join(known, "id").select("text", "label"))
