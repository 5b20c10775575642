"""SimHash near-duplicates by tiled exact comparison.

Fingerprints come from XXH64 hashes of word shingles. Documents that share a
fingerprint collapse to one node, so a group of copies costs one row. Nodes are
sorted into tiles by the population counts of their four 16-bit parts: a tile pair
whose counts differ by more than the radius (summed over the parts) cannot hold a
link and is never formed. The remaining tile pairs are compared whole with NumPy
exclusive-or and bit counts, so no link is lost and no candidate is capped.

A tile pair reports a spanning forest of its links (at most one edge a node), not
all pairs. Components follow from alternating large-star / small-star rounds, each
written to the shared scratch folder.

Cases: null and empty texts have fingerprint zero and are linked like any other;
fewer words than a shingle form one shingle; rows that repeat a doc_id are separate
rows of one result value; null ids never become a component_id unless the component
has no other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import repeat
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.llm.common import materialise, text_rows, texts

SHINGLE = 3
RADIUS = 2
SEED = 42
PARTS = 4
#: Fingerprints in a tile (on average; tiles are cut by hash).
TILE = 2048
_BLOCK = 1 << 15
#: Fingerprints of components of several rows that may be broadcast: about 40 bytes each.
BROADCAST_ROWS = 500_000


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the lower-cased (A-Z) words' shingles; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        ones += np.unpackbits(h[i:i + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED,
                 carry: bool = False) -> DataFrame:
    """``id, fp`` (the fingerprint's bits as a signed long) per row, and ``row`` with ``carry``."""
    source, place = text_rows(docs, id_col, text_col, carry)
    kept = [c for c in source.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle, seed) for t in texts(b, place)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(fp.view(np.int64))], [*kept, "fp"])

    schema = source.drop("text").withColumn("fp", F.lit(0).cast("long")).schema
    return source.mapInArrow(run, schema)


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Half of the popcount differences (the lexicographically non-negative ones) within the radius."""
    found = [()]
    for _ in range(PARTS):
        found = [(*o, d) for o in found for d in range(-radius, radius + 1)]
    return [o for o in found if sum(map(abs, o)) <= radius and o >= (0,) * PARTS]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star per component of the links (i, j) over nodes 0..n-1: (node, root)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def compare(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with popcount(a[i] ^ b[j]) <= radius, in blocks of bounded memory."""
    step = max(1, (1 << 21) // max(1, len(b)))
    rows, cols = [], []
    for s in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[s:s + step, None] ^ b[None, :]) <= radius)
        rows.append(i + s)
        cols.append(j)
    return np.concatenate(rows), np.concatenate(cols)


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Spanning links ``u > v`` between distinct fingerprints ``fp`` within ``radius`` bits."""
    part = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int") for k in range(PARTS)]
    keyed = nodes.select("fp", *[p.alias(f"p{k}") for k, p in enumerate(part)])
    ps = [f"p{k}" for k in range(PARTS)]
    # At most 17^4 keys, whatever the input: the counts are small enough to broadcast.
    sizes = keyed.groupBy(*ps).agg(F.ceil(F.count(F.lit(1)) / tile).alias("chunks"))
    tiles = (keyed.join(F.broadcast(sizes), ps)
             .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
             .groupBy(*ps, "chunk").agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    tiles = materialise(tiles, "simhash-tiles")
    step = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{k}") for k, d in enumerate(o)], F.lit(not any(o)).alias("same"))
                               for o in _offsets(radius)]))
    left = (tiles.withColumn("o", step)
            .select(*[(F.col(p) + F.col(f"o.d{k}")).alias(p) for k, p in enumerate(ps)], F.col("chunk").alias("c1"),
                    F.col("fps").alias("a"), F.col("o.same").alias("same")))
    pairs = left.join(tiles.withColumnRenamed("fps", "b"), ps).filter("NOT same OR c1 <= chunk").select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            a, b = batch.column("a"), batch.column("b")
            for k in range(batch.num_rows):
                x = a[k].values.to_numpy().view(np.uint64)
                y = b[k].values.to_numpy().view(np.uint64)
                i, j = compare(x, y, radius)
                if len(i):
                    both = np.concatenate([x, y])
                    distinct, at = np.unique(both, return_inverse=True)
                    node, root = forest(at[i], at[len(x) + j], len(distinct))
                    u.append(distinct[node].view(np.int64))
                    v.append(distinct[root].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long").filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (u, v): root is the least node of its component.

    Large-star and small-star rounds on a parent forest; each round is two
    pre-aggregated minima and two equi-joins, written to the scratch folder.
    """
    e = materialise(edges.select("u", "v").distinct(), "cc-edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialise(large, "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").filter("u <> v").distinct())
        e = materialise(small, "cc-small")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                seed: int = SEED, carry: bool = False) -> DataFrame:
    """One row per input row: ``id, fp, component_id`` (least id reachable over links), ``first``
    (true for one row of each component) and ``row`` with ``carry``."""
    rows = fingerprints(docs, id_col, text_col, shingle, seed, carry)
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "simhash-rows")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid"))
    nodes = materialise(rows.groupBy("fp").agg(best.alias("best"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius))
    owner = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "best", "n"))
    owner = materialise(owner, "simhash-owner")
    lead = owner.groupBy("root").agg(F.min("best").alias("lead"), F.sum("n").alias("rows")).filter("rows > 1")
    # Only fingerprints of components of several rows: all other rows lead themselves.
    shared = materialise(owner.join(lead, "root").select("fp", "lead"), "simhash-shared")
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    return (rows.join(shared, "fp", "left")
            .select("id", "fp", F.when(F.col("lead").isNull(), F.col("id")).otherwise(F.col("lead.id")).alias("component_id"),
                    F.coalesce(F.col("rid") == F.col("lead.rid"), F.lit(True)).alias("first"), *(["row"] if carry else [])))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     radius: int = RADIUS) -> DataFrame:
    """The input's rows and columns, one row of each near-duplicate component."""
    return near_groups(docs, id_col, text_col, shingle, radius, carry=True).filter("first").select("row.*")
