"""Near-duplicate detection with circulant MinHash, banding and exact Jaccard verification.

1. Equal word sequences form a class; one row of each class goes on. Copies, however many, end here.
2. Circulant MinHash: a permutation scrambles the shingle hashes once, a second one is applied after a circular shift
   by k and its minimum is coordinate k. ``BANDS`` bands of ``ROWS`` coordinates, drawn from all of them, give buckets.
3. A bucket isn't expanded into its pairs. First its smallest member is compared with the others, on full shingle
   sets. Members that this links, directly or through other buckets, need no more. Buckets that still hold several
   components get up to ``PIVOTS`` further pivots, up to ``MOST_PIVOTS`` in later rounds; a pivot is compared with the
   members of other components and then leaves the bucket. This ends when no bucket holds two components with a pair
   not yet compared. A bucket of thousands holds many pairs a little below the limit, so from the second pivot on a
   pair's texts are read only if longer sketches, of 1,024 coordinates, don't rule it out at four deviations.
4. Connected components over the verified links; the smallest id is the component's.

A pair at the limit of 0.8 shares no bucket with probability 2e-4, at 0.82 with 6e-5 and at 0.85 with 6e-6 (simulated: the
bands draw on few coordinates and aren't independent); the sketches rule out one at the limit with probability 3e-5 and one 0.02 above it with 3e-7. No
pair is left out by number, size or rank.

Defined results: null and wordless texts have 0 shingles, are linked with nothing and kept; fewer words than the
width are one shingle; repeated rows are copies; a null id gets its class's component and is kept only where the
whole class has null ids; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vizquarry.llm import shingles
from vizquarry.session import cut_lineage

COORDINATES, ROWS, BANDS = 128, 6, 40
PIVOTS, MOST_PIVOTS = 1024, 4096
#: One bit of each of so many further coordinates, kept as that many 64-bit words.
SKETCH_BITS = 1024
SKETCH_WORDS = SKETCH_BITS // 64
#: A low bit: minima are small numbers, their high bits are nearly all 0.
_SKETCH_BIT = 17
_MIX = tuple(np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_S32, _S33 = np.uint64(32), np.uint64(33)
#: Elements of one step, so that its arrays stay in cache.
_STEP = 256


def _bands() -> np.ndarray:
    """Which coordinates make up each band: a fixed draw, distinct within a band."""
    draw = np.random.default_rng(20240611)
    return np.stack([draw.choice(COORDINATES, ROWS, replace=False) for _ in range(BANDS)])


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """All coordinates of a set of 64-bit shingle hashes."""
    x = hashes.copy()
    x ^= x >> _S33
    x *= _MIX[0]
    x ^= x >> _S33
    x *= _MIX[1]  # the scrambling permutation; what follows is the shifted one
    x *= _MIX[2]
    shift = (np.arange(coordinates, dtype=np.uint64) * _MIX[2])[:, None]
    least = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(x), _STEP):
        y = x[None, at : at + _STEP] + shift
        y ^= y >> _S32
        y *= _MIX[3]
        np.minimum(least, y.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: np.ndarray) -> np.ndarray:
    key = np.arange(len(bands), dtype=np.uint64) * _MIX[0]
    for r in range(bands.shape[1]):
        key = (key ^ least[bands[:, r]]) * _MIX[1]
        key ^= key >> _S32
    return key.view(np.int64)


def _signed(width: int):
    def run(batches):
        import pyarrow as pa

        bands = _bands()
        for batch in batches:
            sizes, keys, starts = [], [], [0]
            for text in batch.column("text"):
                words = text.as_py().split(" ") if text.as_py() else []
                if len(words) < width:
                    sizes.append(min(1, len(words)))
                else:
                    hashes = np.unique(shingles.rolling(shingles.word_hashes(words), width))
                    sizes.append(len(hashes))
                    keys.append(band_keys(signature(hashes), bands))
                starts.append(starts[-1] + (BANDS if len(words) >= width else 0))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            buckets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int64()))
            columns = [batch.column("digest"), batch.column("rep"), batch.column("text"), pa.array(sizes, pa.int64()), buckets]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "rep", "text", "n_shingles", "buckets"])

    return run


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One bit of each of many coordinates: two sets differ in (1 - Jaccard) / 2 of them, on average."""
    bits = signature(hashes, SKETCH_BITS) >> np.uint64(_SKETCH_BIT) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def most_differing(percent: int) -> int:
    """Bits that the sketches of two similar enough sets differ in, at most, with four deviations to spare."""
    p = (1 - percent / 100) / 2
    return int(np.ceil(SKETCH_BITS * p + 4 * np.sqrt(SKETCH_BITS * p * (1 - p))))


def _sketched(width: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for text in batch.column("text"):
                hashes = np.unique(shingles.rolling(shingles.word_hashes(text.as_py().split(" ")), width))
                found.append(sketch(hashes).tolist())
            made = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("buckets"), made], ["rep", "buckets", "sketch"])

    return run


def _similar(width: int, percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            kept = []
            for a, b in zip(batch.column("text_a"), batch.column("text_b")):
                x, y = shingles.shingle_set(a.as_py(), width), shingles.shingle_set(b.as_py(), width)
                both = len(x & y)
                kept.append(100 * both >= percent * (len(x) + len(y) - both))
            found = batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
            yield found

    return run


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of the links (a, b) can reach."""
    edges = cut_lineage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        # Jump: take over the label of the node that is one's label.
        above = step.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = step.join(above, "label").select("node", "old", F.col("above").alias("label"))
        jumped = cut_lineage(jumped)
        labels = jumped.select("node", "label")
        if jumped.where("old <> label").isEmpty():
            return labels


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links, worked out on the components that these join."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    nodes = cut_lineage(nodes)
    of = lambda x: nodes.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
    joined = links.join(of("a"), "a").join(of("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    over = components(joined.where("a <> b").distinct()).select(F.col("node").alias("label"), F.col("label").alias("over"))
    return cut_lineage(nodes.join(over, "label", "left").select("node", F.coalesce("over", "label").alias("label")))


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_similar(width, percent), "a long, b long")


def _sizes_allow(a, b, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _labels(classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The component of each class representative that has a verified link: node, label."""
    texts = classes.where("rep IS NOT NULL")
    rows = texts.select(F.explode("buckets").alias("bucket"), "rep", F.col("n_shingles").alias("n"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.min(F.struct("rep", "n")).alias("pivot"))
    shared = shared.where("rows > 1").select("bucket", "pivot")
    live = cut_lineage(rows.join(shared, "bucket").select("bucket", "rep", "n", "pivot"))
    pairs = live.where("rep <> pivot.rep").select(F.col("pivot.rep").alias("a"), F.col("rep").alias("b"), F.col("pivot.n").alias("na"), "n")
    pairs = pairs.where(_sizes_allow(F.col("na"), F.col("n"), percent)).select("a", "b").distinct()
    compared = cut_lineage(pairs)
    # Only texts that share a bucket are read from here on.
    members = live.select("rep").distinct()
    texts = cut_lineage(texts.select("rep", "text", "buckets").join(members, "rep", "left_semi"))
    links = cut_lineage(_verified(compared, texts, width, percent))
    live = live.where("rep <> pivot.rep").select("bucket", "rep", "n")
    labels, turn, pivots, sketches = components(links), 0, PIVOTS, None
    while True:
        turn += 1
        rows = live.join(labels, live.rep == labels.node, "left").select("bucket", "rep", "n", F.coalesce("label", "rep").alias("label"))
        mixed = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        live = cut_lineage(rows.join(mixed.select("bucket"), "bucket", "left_semi"))
        if live.isEmpty():
            return labels
        if sketches is None:
            asked = texts.join(live.select("rep").distinct(), "rep", "left_semi").select("rep", "text", "buckets")
            made = asked.mapInArrow(_sketched(width), "rep long, buckets array<long>, sketch array<long>")
            sketches = cut_lineage(made.dropDuplicates(["rep"]))
        slot = F.pmod(F.xxhash64("rep", F.lit(turn)), F.lit(pivots))
        pivots = min(MOST_PIVOTS, 4 * pivots)
        chosen = cut_lineage(live.groupBy("bucket", slot.alias("slot")).agg(F.min("rep").alias("rep")).select("bucket", "rep"))
        members = live.join(sketches, "rep")
        x, y = members.alias("x"), members.join(chosen, ["bucket", "rep"], "left_semi").alias("y")
        differ = sum(F.bit_count(F.col("x.sketch")[k].bitwiseXOR(F.col("y.sketch")[k])) for k in range(SKETCH_WORDS))
        # A pair meets in each bucket it shares; it counts in the first of them.
        first = F.get(F.array_intersect("x.buckets", "y.buckets"), F.lit(0)) == F.col("x.bucket")
        near = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label"))
        near = near & _sizes_allow(F.col("x.n"), F.col("y.n"), percent) & (differ <= most_differing(percent)) & first
        pairs = x.join(y, near).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
        pairs = cut_lineage(pairs.join(compared, ["a", "b"], "left_anti"))
        links = cut_lineage(_verified(pairs, texts, width, percent))
        if not links.isEmpty():
            labels = relabelled(labels, links)
        live = live.join(chosen, ["bucket", "rep"], "left_anti").select("bucket", "rep", "n")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, kept."""
    normal = docs.select(F.col(id_column).cast("long").alias("doc_id"), shingles.normalised(F.col(text)).alias("text"))
    normal = normal.withColumn("digest", F.unhex(F.sha2("text", 256)))
    classes = normal.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("text").alias("text"))
    signed = classes.mapInArrow(_signed(width), "digest binary, rep long, text string, n_shingles long, buckets array<long>")
    classes = cut_lineage(signed)
    labels = _labels(classes, width, percent)
    named = classes.select("digest", "rep", "n_shingles").join(labels, F.col("rep") == F.col("node"), "left")
    named = named.select("digest", "n_shingles", F.coalesce("label", "rep").alias("component"))
    found = normal.select("doc_id", "digest").join(named, "digest", "left")
    # Texts without words are alike but linked with nothing.
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    ).withColumnRenamed("doc_id", id_column)
