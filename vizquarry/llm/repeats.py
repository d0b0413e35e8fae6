"""Suffix-array deduplication with a logarithmic index family.

What has to be found is every ``LENGTH``-byte window that starts at two places. Suffixes are listed sparsely: of the
grams of ``GRAM`` bytes inside a window, the one with the least digest is its anchor, so equal windows have equal
anchors, wherever they stand, and a text has one anchor for about ``(LENGTH - GRAM) / 2`` bytes. Windows that follow each other with the
same anchor form a run; its key is the anchor suffix's first two bytes and then a digest of its gram, which is the order of the suffix arrays.

1. A new batch gets its suffix array: its keys in suffix order (within each part of the shuffle) with their counts. It is
   merge-scanned against the existing levels: a key that it has and that occurs twice or more in all is a long match. Then
   it becomes level 1; two levels of equal size merge into one of twice that size, until no two are equal. So there
   are about log2(batches) levels, and a suffix is rewritten that often.
2. Only runs with a matched key go on. Runs that are alike as a whole (all bytes that their windows span) and occur
   twice are covered as a whole; this settles copies, however many, by counting.
3. Where a key has several unlike runs, one run of each kind is cut into pieces of ``PIECE`` windows, aligned with the anchor. What
   all windows of a piece share is its core. A core that occurs once ends its piece; pieces alike as a whole are
   covered; one of each other kind is opened into its windows, and windows are counted by digest. So an edit in a near copy
   opens the few pieces whose core it just misses, not all that it touches. A run that holds its own anchor twice has
   no alignment; it and the runs with its key are opened into windows at once.
4. Removed bytes are the union of what covered runs and repeated windows span.

Nothing is compared pair by pair, and every step counts with partial sums, so a passage in a third of all documents is
like any other. Texts are read in scans; runs to open and the merged spans are sent to the scan while they number
``SENT`` at most and joined by shuffle beyond. Gram, run, core and window are compared by 64-bit digests, the later ones among equal earlier ones. A row is
known by a 64-bit digest of its id and text.

Defined results: a null text counts as empty; texts shorter than ``LENGTH`` keep all bytes; repeated rows are copies and lose
everything if long enough; null and repeated ids are rows like any other; overlapping repeats inside one text count; an empty
table gives an empty result; other columns are not read; texts are processed whole, in slices whose size decides nothing.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry.session import Rounds, cut_lineage, remove, stored

LENGTH, GRAM = 200, 48
#: Windows of a piece.
PIECE = 16
#: Bytes that are hashed at once, so that the arrays stay in cache.
SLICE = 1 << 16
#: Batches that the query deals its table into.
BATCHES = 3
#: Runs or spans, of 30 bytes at most, that may be sent to the executors.
SENT = 1_000_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 3)
_MIX = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTES = np.random.default_rng(20250311).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if n not in _POWERS:
        made = []
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            row = np.full(n, base, dtype=np.uint64)
            row[0] = 1
            made.append(np.multiply.accumulate(row))
        _POWERS[n] = made[0], made[1]
    return _POWERS[n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX[0]
    x = (x ^ (x >> _U(27))) * _MIX[1]
    return x ^ (x >> _U(31))


class Hashed:
    """Digests of any part of a slice, the same wherever its bytes stand."""

    def __init__(self, data: np.ndarray):
        n = max(len(data), SLICE + LENGTH) + 1
        self.power, self.back = _powers(n)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self.power[: len(data)], out=self.sums[1:])

    def parts(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """Of all parts of one size."""
        n = max(0, len(self.sums) - size)
        return _mixed((self.sums[size:] - self.sums[:n]) * self.back[:n] + _U(size))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:])


def runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """start, last, anchor, key, whole and tied of each run of windows with one anchor in a slice of texts that end at ``ends``.

    ``start`` and ``last`` are places of windows in the slice, ``whole`` the digest of all they span; ``tied`` says that
    the anchor's gram stands in it more than once.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
    width = length - gram + 1
    hashed = Hashed(data)
    grams = hashed.every(gram)
    least = sliding_least(grams, width)
    n = len(least)
    fits = np.zeros(n + 1, dtype=np.int8)
    begins = np.r_[0, ends[:-1]]
    long = ends - begins >= length
    # Windows of a text: from its beginning to its end less their length; those of the next begin after a gap.
    np.add.at(fits, begins[long], 1)
    np.add.at(fits, ends[long] - length + 1, -1)
    fits = np.cumsum(fits[:n], dtype=np.int8) > 0
    head = fits.copy()
    head[1:] &= ~fits[:-1] | (least[1:] != least[:-1])
    tail = fits.copy()
    tail[:-1] &= ~fits[1:] | (least[1:] != least[:-1])
    start, last = np.flatnonzero(head), np.flatnonzero(tail)
    value = least[start]
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    at = start + (view[start] == value[:, None]).argmax(axis=1)
    until = last + width - 1 - (view[last][:, ::-1] == value[:, None]).argmax(axis=1)
    key = (data[at].astype(np.uint64) << _U(56)) | (data[at + 1].astype(np.uint64) << _U(48)) | (value >> _U(16))
    key ^= _U(1 << 63)  # so that signed numbers have the order of the bytes
    whole = hashed.parts(start, last + length)
    return start, last, at, key, whole ^ _mixed((at - start).astype(np.uint64)), at != until


def _texts(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, and the ends of its texts."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def slices(ends: np.ndarray, length: int):
    """(first text, texts, begin, end) of slices: whole texts up to SLICE bytes, or overlapping parts of a longer one."""
    k = 0
    while k < len(ends):
        begin = int(ends[k - 1]) if k else 0
        if ends[k] - begin > SLICE:
            for at in range(begin, int(ends[k]) - length + 1, SLICE):
                yield k, 1, at, min(at + SLICE + length - 1, int(ends[k]))
            k += 1
            continue
        stop = max(k + 1, int(np.searchsorted(ends, begin + SLICE, side="right")))
        yield k, stop - k, begin, int(ends[stop - 1])
        k = stop


def _entries(length: int, gram: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, ends = _texts(batch.column("text"))
            docs = batch.column("doc").to_numpy()
            found = []
            for k, n, begin, end in slices(ends, length):
                own = np.minimum(ends[k : k + n], end) - begin
                start, last, anchor, key, whole, tied = runs(data[begin:end], own, length, gram)
                text = k + np.searchsorted(own, start, side="right")
                base = np.where(text > 0, ends[text - 1], 0) if len(text) else text
                found.append((key.view(np.int64), whole.view(np.int64), docs[text], start + begin - base, last - start, anchor - start, tied))
            if found:
                made = [np.concatenate(v) for v in zip(*found)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
                names = ["key", "whole", "doc", "start", "more", "lead", "tied"]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, kinds)], names)

    return run


ENTRY_SCHEMA = "key long, whole long, doc long, start int, more int, lead int, tied boolean"
PIECE_SCHEMA = "key long, core long, whole long, doc long, start int, more int, settled boolean, sure boolean"
SPAN_SCHEMA = "doc long, starts array<int>, ends array<int>"


def cut(start: np.ndarray, more: np.ndarray, lead: np.ndarray, size: int):
    """The pieces of runs: number of the run, first window, windows after it, and where its aligned piece begins.

    Windows of offset o before the anchor, ``size * b <= o < size * (b + 1)``, are one piece.
    """
    high, low = lead // size, (lead - more) // size
    n = high - low + 1
    run = np.repeat(np.arange(len(start)), n)
    block = np.repeat(high, n) - (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
    anchor = (start + lead)[run]
    begin = np.maximum(start[run], anchor - size * block - size + 1)
    last = np.minimum((start + more)[run], anchor - size * block)
    return run, begin, last - begin, anchor - size * block - size + 1


def _distinct(run: np.ndarray, begin: np.ndarray, digest: np.ndarray):
    """Places of the first window of each digest in a run, how often it occurs, and (run, first, more) of repeated windows."""
    order = np.lexsort((begin, digest, run))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (run[order][1:] != run[order][:-1]) | (digest[order][1:] != digest[order][:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.r_[first, len(order)])
    again = np.zeros(len(order), dtype=bool)
    again[order[np.repeat(times > 1, times)]] = True
    at = np.flatnonzero(again)  # windows of a run follow each other, downwards or upwards
    r, w = run[at], begin[at]
    up = np.lexsort((w, r))
    r, w = r[up], w[up]
    head = np.ones(len(w), dtype=bool)
    head[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1] + 1)
    start = np.flatnonzero(head)
    return order[first], times, (r[start], w[start], np.diff(np.r_[start, len(w)]) - 1)


def _pieces(length: int):
    """Pieces, or windows where ``direct``, of the runs (key, core, start, more, lead, settled, direct) beside each text.

    Of the windows of a run that are alike, which is what makes a text that goes in circles, the first goes on; all that are repeated
    there are ``sure`` to be removed.
    """
    names = [name.split()[0] for name in PIECE_SCHEMA.split(", ")]

    def made(data, at, doc, key, core, start, more, lead, settled, direct):
        """``at``: where the first byte of each run stands in ``data``."""
        import pyarrow as pa

        hashed = Hashed(data)
        found = []
        for size, own in ((1, np.flatnonzero(direct)), (PIECE, np.flatnonzero(~direct))):
            if not len(own):
                continue
            run, begin, after, piece = cut(start[own], more[own], lead[own], size)
            run = own[run]
            shift = at[run] - start[run]
            whole = hashed.parts(begin + shift, begin + after + length + shift)
            if size > 1:
                shared = hashed.parts(piece + size - 1 + shift, piece + length + shift)
                shared ^= _mixed((start[run] + lead[run] - piece).astype(np.uint64))
                found.append((key[run], shared.view(np.int64), whole.view(np.int64), doc[run], begin, after, settled[run], np.zeros(len(run), bool)))
                continue
            one, times, (r, w, n) = _distinct(run, begin, whole)
            none = np.zeros(len(r), np.int64)
            found.append((key[r], none, none, doc[r], w, n, np.ones(len(r), bool), np.ones(len(r), bool)))
            run, begin, whole = run[one], begin[one], whole[one]
            shared = (whole ^ core[run].view(np.uint64)).view(np.int64)
            none = np.zeros(len(run), np.int64)
            found.append((key[run], shared, whole.view(np.int64), doc[run], begin, none, settled[run] | (times > 1), none.astype(bool)))
        columns = [np.concatenate(v) for v in zip(*found)]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names)

    def run(batches):
        for batch in batches:
            data, ends = _texts(batch.column("text"))
            counts = np.diff(np.asarray(batch.column("start").offsets).astype(np.int64))
            flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("key", "core", "start", "more", "lead", "settled", "direct")]
            key, core, start, more, lead, settled, direct = flat
            start, more, lead = (v.astype(np.int64) for v in (start, more, lead))
            text = np.repeat(np.arange(len(counts)), counts)
            # Only a run that is opened into windows may be longer than a slice; it goes on in parts.
            parts = -(-(more + 1) // SLICE)
            own = np.repeat(np.arange(len(start)), parts)
            skip = (np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)) * SLICE
            start, lead, left = start[own] + skip, lead[own] - skip, more[own] - skip
            more, key, core, settled, direct, text = np.minimum(left, SLICE - 1), key[own], core[own], settled[own], direct[own], text[own]
            docs = batch.column("doc").to_numpy()[text]
            begin = start + np.r_[0, ends][text]
            size = more + length
            group = np.cumsum(size) // SLICE
            for g in np.unique(group):
                k = slice(*np.searchsorted(group, (g, g + 1)))
                bytes_ = np.concatenate([data[a : a + n] for a, n in zip(begin[k].tolist(), size[k].tolist())])
                at = np.cumsum(size[k]) - size[k]
                yield made(bytes_, at, docs[k], key[k], core[k], start[k], more[k], lead[k], settled[k], direct[k])

    return run


def _merged(batches):
    """The union of the spans of each document."""
    import pyarrow as pa

    for batch in batches:
        found = []
        spans = batch.column("spans")
        offsets, flat = np.asarray(spans.offsets), spans.values
        starts, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        for k in range(len(spans)):
            a, b = starts[offsets[k] : offsets[k + 1]], ends[offsets[k] : offsets[k + 1]]
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            new = np.r_[True, a[1:] > b[:-1]]
            found.append((a[new].tolist(), b[np.r_[new[1:], True]].tolist()))
        columns = [pa.array(v, pa.list_(pa.int32())) for v in zip(*found)] if found else [pa.array([], pa.list_(pa.int32()))] * 2
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", "starts", "ends"])


class SuffixFamily:
    """A family of suffix arrays over batches of documents (doc, text), each level a stored table."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM):
        if not 2 <= gram < length or length <= PIECE:
            raise ValueError(f"a gram has two bytes or more and is shorter than a window, which has over {PIECE}")
        self.spark, self.length, self.gram = spark, length, gram
        self.matches = Rounds(spark, "key long")
        #: Folders of the runs of each batch.
        self.folders: list[str] = []
        #: (batches in it, suffix array, folder), the largest first.
        self.levels: list[tuple[int, DataFrame, str]] = []

    def add(self, docs: DataFrame) -> None:
        """Index a batch, after a scan for its long matches with itself and with all levels."""
        batch, folder = stored(docs.mapInArrow(_entries(self.length, self.gram), ENTRY_SCHEMA))
        self.folders.append(folder)
        counted = batch.groupBy("key").agg(F.sum(F.when(F.col("tied"), 2).otherwise(1)).alias("n"))
        size, (array, place) = 1, stored(counted.sortWithinPartitions("key"))
        scanned = array.withColumn("new", F.lit(True))
        for _, level, _ in self.levels:
            scanned = scanned.union(level.withColumn("new", F.lit(False)))
        met = scanned.groupBy("key").agg(F.sum("n").alias("n"), F.max("new").alias("new")) if self.levels else scanned
        self.matches.add(met.where("new AND n > 1").select("key"))
        equal = []
        while self.levels and self.levels[-1][0] == size:
            equal.append(self.levels.pop())
            size *= 2
        if equal:
            old = [place, *(folder for _, _, folder in equal)]
            for _, level, _ in equal:
                array = array.union(level)
            array, place = stored(array.groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key"))
            for folder in old:
                remove(self.spark, folder)
        self.levels.append((size, array, place))

    def runs(self) -> DataFrame:
        """The runs of all batches whose key occurs twice."""
        if not self.folders:
            return self.spark.createDataFrame([], ENTRY_SCHEMA)
        entries = self.spark.read.schema(ENTRY_SCHEMA).parquet(*self.folders)
        return entries.join(cut_lineage(self.matches.all().distinct()), "key", "left_semi")

    def _opened(self, docs: DataFrame, runs: DataFrame) -> DataFrame:
        """The pieces of the given runs, from the texts of their documents."""
        runs = cut_lineage(runs)
        names = [c for c in runs.columns if c != "doc"]
        by_text = runs.groupBy("doc").agg(F.collect_list(F.struct(*names)).alias("runs"))
        by_text = by_text.select("doc", *[F.col(f"runs.{c}").alias(c) for c in names])
        texts = docs.join(F.broadcast(by_text) if runs.count() <= SENT else by_text, "doc").select("doc", "text", *names)
        return cut_lineage(texts.mapInArrow(_pieces(self.length), PIECE_SCHEMA))

    def drop(self) -> None:
        """Give back the space of the runs and levels."""
        for folder in [*self.folders, *(folder for _, _, folder in self.levels)]:
            remove(self.spark, folder)
        self.folders, self.levels = [], []

    def repeated(self, docs: DataFrame, last: bool = False) -> DataFrame:
        """doc, starts, ends: the bytes that repeated windows span, merged; ``docs`` are all documents added.

        After the ``last`` call the family holds nothing any more.
        """
        one = F.min(F.struct("doc", "start", "more", "lead")).alias("one")
        found = cut_lineage(self.runs())
        if last:
            self.drop()
        kinds = cut_lineage(found.groupBy("key", "whole").agg(F.count("*").alias("n"), F.max("tied").alias("tied"), one))
        unlike = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.max("tied").alias("direct")).where("kinds > 1 OR direct")
        opened = kinds.join(unlike.select("key", "direct"), "key")
        opened = opened.select("one.*", "key", F.lit(0).cast("long").alias("core"), (F.col("n") > 1).alias("settled"), "direct")
        covered = [_alike(found, kinds, ["key", "whole"], self.length)]
        pieces = self._opened(docs, opened)

        one = F.min(F.struct("doc", "start", "more")).alias("one")
        parts = ["key", "core", "whole"]
        kinds = cut_lineage(pieces.where("NOT sure").groupBy(*parts).agg(F.count("*").alias("n"), F.max("settled").alias("settled"), one))
        unlike = kinds.groupBy("key", "core").count().where("count > 1").select("key", "core")
        opened = kinds.join(unlike, ["key", "core"], "left_semi")
        settled = (F.col("settled") | (F.col("n") > 1)).alias("settled")
        opened = opened.select("one.*", F.col("one.more").alias("lead"), "key", "core", settled, F.lit(True).alias("direct"))
        covered.append(_alike(pieces.where("NOT settled"), kinds, parts, self.length))
        windows = self._opened(docs, opened)

        kinds = windows.where("NOT sure").groupBy(*parts).agg(F.count("*").alias("n"))
        covered.append(_alike(windows.where("NOT settled"), kinds, parts, self.length))
        covered += [_spans(rows.where("sure"), self.length) for rows in (pieces, windows)]
        spans = reduce(DataFrame.union, covered).distinct()
        return spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans")).mapInArrow(_merged, SPAN_SCHEMA)


def _alike(rows: DataFrame, kinds: DataFrame, key: list[str], length: int) -> DataFrame:
    """doc, start, end of the rows whose kind occurs twice."""
    return _spans(rows.join(kinds.where("n > 1").select(*key), key, "left_semi"), length)


def _spans(rows: DataFrame, length: int) -> DataFrame:
    return rows.select("doc", "start", (F.col("start") + F.col("more") + length).alias("end"))


def _kept(batches):
    import pyarrow as pa

    for batch in batches:
        data, ends = _texts(batch.column("text"))
        raw = data.tobytes()
        starts, stops = batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
        rows, begin = [], 0
        for end, a, b in zip(ends.tolist(), starts, stops):
            text, a, b = raw[begin:end], a or [], b or []
            kept = b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)]))
            rows.append((len(text), len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest()))
            begin = end
        made = [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def named(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text and a digest of both that names the row."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("doc", F.xxhash64("id", "text"))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = named(docs, id_column, text)
    family = SuffixFamily(docs.sparkSession, length, gram)
    for k in range(batches):
        family.add(rows.where(F.pmod("doc", F.lit(batches)) == k).select("doc", "text"))
    spans = cut_lineage(family.repeated(rows.select("doc", "text"), last=True))
    n = spans.agg(F.coalesce(F.sum(F.size("starts")), F.lit(0))).first()[0]
    joined = rows.join(F.broadcast(spans) if n <= SENT else spans, "doc", "left").select("id", "text", "starts", "ends")
    kind = rows.schema["id"].dataType.simpleString()
    made = joined.mapInArrow(_kept, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return made.withColumnRenamed("id", id_column)


#: The same rows by counting every window.
CHECK = """
WITH docs AS (
    SELECT row_number() OVER () AS n, doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
    SELECT n, i, md5_number(b[i:i + 199]) AS w FROM (SELECT n, b, unnest(range(1, octet_length(b) - 198)) AS i FROM docs WHERE octet_length(b) >= 200)
), twice AS (
    SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), hit AS (
    SELECT n, i, coalesce(i > 200 + lag(i) OVER (PARTITION BY n ORDER BY i) , true) AS fresh FROM windows SEMI JOIN twice USING (w)
), span AS (
    SELECT n, min(i) AS a, max(i) + 199 AS z FROM (SELECT n, i, sum(fresh::INT) OVER (PARTITION BY n ORDER BY i) AS s FROM hit) GROUP BY n, s
), cut AS (
    SELECT n, a, z, coalesce(lag(z) OVER (PARTITION BY n ORDER BY a), 0) AS before FROM span
), kept AS (
    SELECT n, sum(z - a + 1) AS removed, count(*) AS spans, max(z) AS last, string_agg(hex(b[before + 1:a - 1]), '' ORDER BY a) AS h FROM cut JOIN docs USING (n) GROUP BY n
)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(h, '') || hex(b[coalesce(last, 0) + 1:octet_length(b)]))) AS kept_sha256
FROM docs LEFT JOIN kept USING (n)
"""
