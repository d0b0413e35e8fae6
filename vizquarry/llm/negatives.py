"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

Candidates are put in the order of a Hilbert curve through their quantised components (range partition on the key and
the id, so equal vectors don't meet in one task) and cut into blocks of ``BLOCK`` vectors. Each block is a Parquet row
with its zone map: the least and largest value of each dimension and the labels it holds. The zone maps are also a
table of their own.

Anchors are taken in waves of at most ``WAVE``, neighbours on the curve together, and a wave is broadcast. Interval arithmetic on a
zone map bounds every inner product of an anchor with the block's vectors from both sides. A block is
read for a wave only if some anchor may have a positive there (the bound reaches the fifth best score known so far,
at first from the wave's own anchors), and then only if some window of positives meets the bounds and may still have a
better negative. Inside a task the bounds are tested again, anchor by anchor, against what its earlier blocks have
given. Each task sends its best rows per anchor or window on, and the best of those are exact.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part, nor do extra
columns; exact repeats of a row count once; unlike rows under one id are rows of their own, an anchor's "other rows"
are those with another id; a vector shorter than others counts as padded with zeros; equal scores
are ordered by id; an anchor without positives, and a window without rows, give no row; an empty table gives an
empty result. Components so large that an inner product would not be exact in a double end the query with an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vizquarry.llm.clusters import integers, usable
from vizquarry.session import Rounds, cut_lineage, remove, stored

BLOCK = 512
#: Anchors of a wave, and of one step inside a task.
WAVE, STEP = 8192, 256
#: Bits of a dimension on the curve.
BITS = 3
#: Numbers of chosen blocks are broadcast up to so many (16 MB), joined by shuffle beyond.
SENT_BLOCKS = 2_000_000
_LEAST = np.iinfo(np.int64).min


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve (Skilling's transform) of rows of cells below 2 ** bits, as sortable bytes."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap if i else 0
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= turn
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])  # bit, dimension, row
    return np.packbits(planes.reshape(bits * dims, -1).astype(np.uint8), axis=0).T.copy()


def _keyed(low: np.ndarray, high: np.ndarray):
    def run(batches):
        import pyarrow as pa

        dims = len(low)
        width = np.maximum(1, high - low + 1).astype(np.float64)
        for batch in batches:
            x = _padded(batch.column("x"), dims)
            cells = np.minimum((1 << BITS) - 1, ((x - low) / width * (1 << BITS)).astype(np.int64))
            keys = hilbert_keys(cells, BITS)
            made = pa.array([k.tobytes() for k in keys], pa.binary())
            flat = pa.array(x.reshape(-1), pa.int64())
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dims, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), vectors, made], ["id", "label", "x", "key"])

    return run


def _padded(column, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), dtype=np.int64)
    offsets = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    if len(column) and (np.diff(offsets) == dims).all():
        return flat[offsets[0] : offsets[-1]].astype(np.int64).reshape(-1, dims)
    for k in range(len(column)):
        own = flat[offsets[k] : offsets[k + 1]]
        out[k, : len(own)] = own
    return out


def _packed(dims: int):
    """Blocks from rows in curve order; exact repeats, which follow each other, count once."""

    def run(batches):
        import pyarrow as pa

        ids, labels, x = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dims), np.int64)
        last = None
        for batch in batches:
            own = batch.column("id").to_numpy(), batch.column("label").to_numpy().astype(np.int64), _padded(batch.column("x"), dims)
            whole = np.concatenate([own[0][:, None], own[1][:, None], own[2]], axis=1)
            fresh = np.ones(len(whole), dtype=bool)
            fresh[1:] = (whole[1:] != whole[:-1]).any(axis=1)
            if last is not None and len(whole):
                fresh[0] = (whole[0] != last).any()
            last = whole[-1] if len(whole) else last
            ids, labels, x = (np.concatenate([a, b[fresh]]) for a, b in zip((ids, labels, x), own))
            while len(ids) >= BLOCK:
                yield _block(ids[:BLOCK], labels[:BLOCK], x[:BLOCK])
                ids, labels, x = ids[BLOCK:], labels[BLOCK:], x[BLOCK:]
        if len(ids):
            yield _block(ids, labels, x)

    def _block(ids, labels, x):
        rows = [[x.min(axis=0).tolist()], [x.max(axis=0).tolist()], [np.unique(labels).tolist()], [ids.tolist()], [labels.tolist()], [x.astype("<i4").tobytes()]]
        kinds = [pa_list(), pa_list(), pa_list(), pa_list(), pa_list(), None]
        return _batch(rows, kinds)

    def pa_list():
        import pyarrow as pa

        return pa.list_(pa.int64())

    def _batch(rows, kinds):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array(r, k or pa.binary()) for r, k in zip(rows, kinds)], ["low", "high", "held", "ids", "labels", "vectors"])

    return run


BLOCK_SCHEMA = "low array<long>, high array<long>, held array<long>, ids array<long>, labels array<long>, vectors binary"


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval arithmetic: least and largest inner product of each row of ``q`` with any vector in the box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low + down @ high, up @ high + down @ low


class Wave:
    """Anchors of a wave: ids, labels and vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x.astype(np.float64)

    def __len__(self):
        return len(self.ids)


def best_of(place: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int):
    """The first n rows of each place, by score downwards and id upwards; places ascend."""
    order = np.lexsort((ids, -score, place))
    place, score, ids = place[order], score[order], ids[order]
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
    rank = np.arange(len(place)) - np.repeat(start, np.diff(np.r_[start, len(place)]))
    keep = rank < n
    return place[keep], score[keep], ids[keep]


def bars(place: np.ndarray, score: np.ndarray, n: int, places: int) -> np.ndarray:
    """The n-th best score of each place, below which nothing matters; the least number where there are fewer."""
    out = np.full(places, _LEAST)
    counts = np.bincount(place, minlength=places)
    ends = np.cumsum(counts) - 1
    full = counts >= n
    out[full] = score[ends[full]]
    return out


class Search:
    """What a task has found so far for each place, an anchor or one of its windows.

    ``floor`` and ``cap`` are the scores a place takes, ``anchor`` the row of the wave it belongs to (ascending); ``same``
    asks for the anchor's label, else for any other. ``bar`` is the score below which a row no longer matters.
    """

    def __init__(self, wave: Wave, anchor: np.ndarray, floor: np.ndarray, cap: np.ndarray, same: bool, n: int):
        self.wave, self.anchor, self.same, self.n = wave, anchor, same, n
        self.cap, self.floor, self.bar = cap, floor, floor.copy()
        self.found = (np.zeros(0, np.int64),) * 3

    def wanted(self, low: np.ndarray, high: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Places that the block may give a row to."""
        least, most = bounds(self.wave.x, low.astype(np.float64), high.astype(np.float64))
        alike = np.isin(self.wave.labels, held) if self.same else ~((len(held) == 1) & np.isin(self.wave.labels, held))
        a = self.anchor
        return np.flatnonzero(alike[a] & (most[a] >= self.bar) & (least[a] <= self.cap))

    def read(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, places: np.ndarray) -> None:
        x = x.astype(np.float64)
        found = [self.found]
        rows = np.unique(self.anchor[places])
        for at in range(0, len(rows), STEP):
            part = rows[at : at + STEP]
            scores = (self.wave.x[part] @ x.T).astype(np.int64)
            alike = self.wave.labels[part][:, None] == labels[None, :]
            fits = (alike & (self.wave.ids[part][:, None] != ids[None, :])) if self.same else ~alike
            own = places[(self.anchor[places] >= part[0]) & (self.anchor[places] <= part[-1])]
            row = np.searchsorted(part, self.anchor[own])
            for k in range(0, len(own), STEP):
                r, p = row[k : k + STEP], own[k : k + STEP]
                s = scores[r]
                i, j = np.nonzero(fits[r] & (s >= self.bar[p][:, None]) & (s <= self.cap[p][:, None]))
                found.append(best_of(p[i], s[i, j], ids[j], self.n))
        self.found = best_of(*(np.concatenate(v) for v in zip(*found)), self.n)
        self.bar = np.maximum(self.floor, bars(self.found[0], self.found[1], self.n, len(self.anchor)))


def _arrays(row: dict, dims: int):
    ids, labels = np.array(row["ids"], np.int64), np.array(row["labels"], np.int64)
    return ids, labels, np.frombuffer(row["vectors"], "<i4").reshape(len(ids), dims)


def _chosen(search):
    """The blocks that any place of the wave needs."""

    def run(batches):
        import pyarrow as pa

        own = search.value
        for batch in batches:
            keep = []
            for row in batch.select(["low", "high", "held"]).to_pylist():
                keep.append(bool(len(own.wanted(*(np.array(row[k], np.int64) for k in ("low", "high", "held"))))))
            yield batch.select(["block"]).filter(pa.array(keep, pa.bool_()))

    return run


def _found(search, dims: int):
    def run(batches):
        import pyarrow as pa

        shared = search.value
        own = Search(shared.wave, shared.anchor, shared.floor, shared.cap, shared.same, shared.n)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                places = own.wanted(*(np.array(row[c], np.int64) for c in ("low", "high", "held")))
                if len(places):
                    own.read(*_arrays(row, dims), places)
        place, score, ids = own.found
        columns = [pa.array(place, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["place", "score", "id"])

    return run


def ranked(blocks: DataFrame, zones: DataFrame, search: Search, dims: int) -> DataFrame:
    """place, score, id, rank: the first rows of each place over all blocks that it needs."""
    spark = blocks.sparkSession
    # What the wave's own anchors offer raises the bars before any block is read; they are candidates as well.
    probe = Search(search.wave, search.anchor, search.floor, search.cap, search.same, search.n)
    probe.read(search.wave.ids, search.wave.labels, search.wave.x, np.arange(len(search.anchor)))
    search.floor = search.bar = probe.bar
    sent = spark.sparkContext.broadcast(search)  # WAVE vectors and their windows, at most
    chosen = cut_lineage(zones.mapInArrow(_chosen(sent), "block long"))
    read = blocks.join(F.broadcast(chosen) if chosen.count() <= SENT_BLOCKS else chosen, "block", "left_semi")
    rows = read.mapInArrow(_found(sent, dims), "place int, score long, id long")
    return rows.selectExpr("*", "row_number() OVER (PARTITION BY place ORDER BY score DESC, id) AS rank").where(F.col("rank") <= search.n)


def keyed_rows(vectors: DataFrame) -> tuple[DataFrame, str, int]:
    """(id, label, x, key) with padded vectors and their places on the curve, stored; the folder; the number of dimensions."""
    placed = vectors.select(F.posexplode("x").alias("p", "v")).groupBy("p").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    box = sorted(placed.collect()) or [(0, 0, 0)]  # a row per dimension
    low, high = (np.array([pick(0, r[k]) for r in box], np.int64) for k, pick in ((1, min), (2, max)))
    if len(box) * int(max(-low.min(), high.max())) ** 2 >= 1 << 52:
        raise ValueError("components too large for exact inner products")
    keyed, path = stored(vectors.mapInArrow(_keyed(low, high), "id long, label long, x array<long>, key binary"))
    return keyed, path, len(box)


def candidate_blocks(keyed: DataFrame, dims: int) -> DataFrame:
    """Hilbert-ordered blocks of the rows, stored."""
    placed = keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "label", "x")
    blocks = placed.select("id", "label", "x").mapInArrow(_packed(dims), BLOCK_SCHEMA)
    return cut_lineage(blocks.withColumn("block", F.monotonically_increasing_id()))


def mine(
    table: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    scale: int = 256,
    id_column: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column ``id``. A negative's score is between the two percentages of its positive's.
    """
    spark = table.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    rows = table.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    vectors = rows.select("id", "label", integers(F.col("v"), scale).alias("x"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = Rounds(spark, schema)
    keyed, path, dims = keyed_rows(vectors)
    blocks = candidate_blocks(keyed, dims)
    zones = cut_lineage(blocks.select("block", "low", "high", "held"))
    anchors = keyed.where(is_anchor).dropDuplicates(["id", "label", "x"]).repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    # Runs of neighbours: partitions, and parts of WAVE rows where one has more.
    place = F.monotonically_increasing_id()
    run = F.shiftleft(F.shiftright(place, 33), 22) + F.floor(place.bitwiseAND((1 << 33) - 1) / WAVE)
    anchors = cut_lineage(anchors.select("id", "label", "x", "key", run.alias("run")))
    remove(spark, path)
    for low, high in waves(anchors):
        own = anchors.where(F.col("run").between(low, high)).orderBy("key", "id").select("id", "label", "x").toArrow()
        x = np.array(own.column("x").to_pylist(), np.int64).reshape(own.num_rows, dims)
        found = mined(blocks, zones, Wave(own.column("id").to_numpy(), own.column("label").to_numpy(), x), dims, positives, negatives, least_percent, most_percent)
        if found is not None:
            out.add(found)
    return out.all()


def waves(anchors: DataFrame) -> list[tuple[int, int]]:
    """Ranges of runs that hold ``WAVE`` anchors at most."""
    made: list[tuple[int, int]] = []
    held = 0
    for run, n in sorted(anchors.groupBy("run").count().collect()):
        if made and held + n <= WAVE:
            made[-1], held = (made[-1][0], run), held + n
        else:
            made.append((run, run))
            held = n
    return made


def mined(blocks, zones, wave: Wave, dims: int, positives: int, negatives: int, least: int, most: int) -> DataFrame | None:
    """The negatives of a wave's anchors."""
    spark = blocks.sparkSession
    rows = np.arange(len(wave))
    open_ = np.full(len(wave), _LEAST + 1), np.full(len(wave), -_LEAST - 1)
    near = ranked(blocks, zones, Search(wave, rows, *open_, True, positives), dims).orderBy("place", "rank").toArrow()
    anchor, score, other = (near.column(c).to_numpy() for c in ("place", "score", "id"))  # WAVE x positives rows
    if not len(anchor):
        return None
    anchor = anchor.astype(np.int64)
    floor, cap = -(-least * score // 100), most * score // 100
    found = ranked(blocks, zones, Search(wave, anchor, floor, cap, False, negatives), dims)
    named = spark.createDataFrame(
        [(k, int(wave.ids[a]), int(p), int(s)) for k, (a, p, s) in enumerate(zip(anchor, other, score))],
        "place int, anchor_id long, positive_id long, positive_score long",
    )
    columns = ["anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
    return found.join(F.broadcast(named), "place").select(*columns)


#: The same rows by scoring every pair of an anchor and a row.
CHECK = """
WITH base AS (
    SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda v: floor(v::DOUBLE * 256)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = len(embedding)
), scored AS (
    SELECT a.id AS anchor, r.id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
    FROM base a JOIN base r ON a.id % 100 = 0 AND a.id <> r.id
), positive AS (
    SELECT anchor, id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
    (row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
