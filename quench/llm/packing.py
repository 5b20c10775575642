"""Best-fit packing of token sequences by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens. How pieces fit depends only on
how many there are of each length, and there are at most ``capacity`` lengths, so Spark
counts lengths and the plan is made from that histogram: for each bin, a bitset
subset-sum over the available lengths (large ones first, as many copies as are left)
finds the fullest feasible combination. The combination is then removed as many times
as the counts allow, which is what removing one bin at a time would do, since the
search gives the same answer until a length runs out. The plan is therefore bounded by
the capacity, not by the corpus. Each bin starts from the longest piece left, the usual
refinement of the heuristic: without it long pieces are left over with nothing to fill them.

The tokenizing pass numbers the pieces of each length within its task. A count per
(task, length), pre-aggregated, turns that into a rank among all pieces of the length
without a sort or a window over hot lengths, and the rank gives sequence and offset.

Cases: null or empty texts are the separator alone; rows that repeat a doc_id are
packed each for itself; a null doc_id is kept; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quench.llm.common import col, materialise, text_of
from quench.llm.tokens import encoder

CAPACITY = 2048
SEPARATOR = 0
#: (task, length) rows that may be broadcast: 24 bytes each.
BROADCAST_ROWS = 1_000_000
_ROWS = 500


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR,
           tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (``<u4`` bytes) of every document, and ``task, nth``:
    the piece is the nth of its length in that task. Written to the scratch folder."""
    source = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, seen = encoder(tokenizer, "word"), TaskContext.get().partitionId(), Counter()
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                b = whole.slice(at, _ROWS)
                row, piece, start, length, ids, nth = [], [], [], [], [], []
                for i, text in enumerate(b.column("text")):
                    data = enc.encode(text.as_py()) + end
                    for k, s in enumerate(range(0, len(data) // 4, capacity)):
                        cut = data[4 * s:4 * (s + capacity)]
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(cut) // 4)
                        ids.append(cut)
                        nth.append(seen[len(cut) // 4])
                        seen[len(cut) // 4] += 1
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids", "task", "nth"])

    schema = T.StructType([source.schema["doc_id"], *T._parse_datatype_string("piece int, start long, length long, ids binary, task int, nth long")])
    return materialise(source.mapInArrow(run, schema), "pack-pieces")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest feasible combination {length: copies}: bitset subset-sum over lengths in
    descending order, stopping once the bin can be filled exactly."""
    reach, steps, full = 1, [], 1 << capacity
    mask = (full << 1) - 1
    for length in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        left, k = min(counts[length], capacity // length), 1
        while left and not reach & full:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << length * k) & mask
            left -= k
            k *= 2
        if reach & full:
            break
    target, out = reach.bit_length() - 1, Counter()
    for length, k, before in reversed(steps):
        if not before >> target & 1:
            out[length] += k
            target -= length * k
    return dict(out)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """One bin: the longest piece left and the fullest feasible combination beside it."""
    longest = max(n for n, c in counts.items() if c > 0)
    beside = fullest({n: c - (n == longest) for n, c in counts.items() if n <= capacity - longest}, capacity - longest)
    beside[longest] = beside.get(longest, 0) + 1
    return beside


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repeats, {length: copies}) in the order in which minimum bin slack fills bins."""
    counts, out = {n: c for n, c in histogram.items() if c > 0}, []
    while counts:
        combination = fill(counts, capacity)
        repeats = min(counts[n] // c for n, c in combination.items())
        out.append((repeats, combination))
        for n, c in combination.items():
            counts[n] -= repeats * c
            if not counts[n]:
                del counts[n]
    return out


def _places(steps: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, copies a sequence, first offset)."""
    used, out, sequence = Counter(), {}, 0
    for repeats, combination in steps:
        offset = 0
        for n in sorted(combination, reverse=True):
            out.setdefault(n, []).append((used[n], sequence, combination[n], offset))
            used[n] += repeats * combination[n]
            offset += n * combination[n]
        sequence += repeats
    return {n: np.array(v, np.int64) for n, v in out.items()}


def assign(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (see ``pieces``; further columns are kept) with ``sequence_id`` and ``offset``."""
    counts = materialise(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    places = _places(plan(histogram, capacity))
    from pyspark.sql import Window

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    if counts.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    ranked = cut.join(first, ["task", "length"]).withColumn("rank", F.col("first") + F.col("nth")).drop("first", "nth", "task")
    kept = [c for c in ranked.columns if c != "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                rows = places[n]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                slot, within = np.divmod(rank[at] - row[:, 0], row[:, 2])
                sequence[at] = row[:, 1] + slot
                offset[at] = row[:, 3] + within * n
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(run, ranked.drop("rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, separator: int = SEPARATOR,
         tokenizer: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``: one row per piece."""
    return assign(pieces(docs, id_col, text_col, capacity, separator, tokenizer), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids``: each packed sequence's ids as ``<u4`` bytes (at most ``capacity`` of them)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.concat(F.lit(b""), F.aggregate(
        parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))).alias("ids"))
