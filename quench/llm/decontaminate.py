"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item (an item of fewer words
is one window). Of the ``k``-gram hashes in every span of ``window`` words the least
(rightmost on ties) is kept, in documents and items alike, so a shared span of at
least ``window`` words always shares a fingerprint: the guarantee of winnowing with
span ``window - k + 1``. Items shorter than a window are fingerprinted by the hash of
all their words, and documents by every n-gram of those lengths.

Documents are read once. A fixed-size bitmap of the benchmark's fingerprints (at most
``2^FILTER_BITS`` bits whatever the benchmark's size; a fuller one only filters less)
drops fingerprints that can't match; the rest are extended to the windows that cover
them and joined with the benchmark's on fingerprint and whole window text, so every
reported hit is exact. The benchmark side of the join is broadcast only when its
measured size is small.

Cases: null or empty texts have no words; an item without words has no window; rows
that repeat a doc_id are scored each for itself; items with equal ids count once, null
item ids are not counted or listed; an empty benchmark hits nothing; other columns are
carried in one struct.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.llm.common import BROADCAST_BYTES, col, materialise, sole_cache, text_of, text_rows, texts

WINDOW = 10
K = 5
FILTER_BITS = 24
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ over UTF-8
_CACHE: dict[bytes, int] = {}
_CACHE_MAX = 400_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
_ROWS = 2000


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


def _hashes(words: list[bytes]) -> np.ndarray:
    if len(_CACHE) > _CACHE_MAX:
        _CACHE.clear()
    for w in set(words).difference(_CACHE):
        _CACHE[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_CACHE.__getitem__, words), np.uint64, len(words))


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, mixed, as uint64."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    g = np.full(m, np.uint64(n))
    for j in range(n):
        g = g * _MULT + h[j:j + m]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(32))


def winnow(g: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes, the position of the least, rightmost on ties."""
    if len(g) < span:
        return np.empty(0, np.int64)
    v = np.lib.stride_tricks.sliding_window_view(g, span)[:, ::-1]
    return np.arange(len(v)) + (span - 1) - v.argmin(axis=1)


def windows(words: list[bytes], h: np.ndarray, window: int, k: int) -> list[tuple[int, int, int]]:
    """(start, length, fingerprint) of an item's windows; one shorter window if it has fewer words."""
    n = len(words)
    if 0 < n < window:
        return [(0, n, int(_grams(h, n)[0]))]
    g = _grams(h, k)
    return [(s, window, int(g[p])) for s, p in enumerate(winnow(g, window - k + 1))]


def _signed(x) -> int:
    return int(np.uint64(x).view(np.int64))


_WINDOW_ROWS = "fp long, len int, text string"


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """``item_id, fp, len, text`` of every window occurrence of the benchmark."""
    source = benchmark.select(col(id_col).cast("string").alias("item_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text")):
                words = words_of(text.as_py())
                for s, n, fp in windows(words, _hashes(words), window, k):
                    out.append((item, _signed(fp), n, b" ".join(words[s:s + n]).decode()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                                             ["item_id", "fp", "len", "text"])

    return source.mapInArrow(run, f"item_id string, {_WINDOW_ROWS}").distinct()


def _bitmap(fps: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit ``fp mod 2^bits`` is set for every fingerprint: at most 2^(bits-6) rows reach the driver."""
    slot = F.col("fp").bitwiseAND(F.lit((1 << bits) - 1))
    words = (fps.groupBy(F.shiftright(slot, 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((fp & 63) as int))")).alias("b")).toPandas())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return out


def _maybe(bitmap: np.ndarray, fp: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    at = fp & np.uint64((1 << bits) - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def candidates(words: list[bytes], bitmap: np.ndarray, short: list[int], window: int, k: int) -> list[tuple[int, int, int]]:
    """(start, length, fingerprint) of the document's windows whose fingerprint may be the benchmark's."""
    h = _hashes(words)
    out = []
    g = _grams(h, k)
    at = winnow(g, window - k + 1)  # the fingerprint of the window that starts at i is g[at[i]]
    if len(at):
        fp = g[at]
        for s in np.flatnonzero(_maybe(bitmap, fp)):
            out.append((int(s), window, fp[s]))
    for n in short:
        fp = _grams(h, n)
        for s in np.flatnonzero(_maybe(bitmap, fp)):
            out.append((int(s), n, fp[s]))
    return out


def scan(docs: DataFrame, id_col: str, text_col: str, bitmap: np.ndarray, short: list[int], window: int, k: int, carry: bool) -> DataFrame:
    """``id, n_words, cand`` (candidate windows, each distinct one with its starts) and ``row`` with ``carry``."""
    source, place = text_rows(docs, id_col, text_col, carry)
    kept = [c for c in source.columns if c != "text"]
    cand_type = pa.list_(pa.struct([("fp", pa.int64()), ("len", pa.int32()), ("text", pa.string()), ("starts", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole_cache("decontaminate", _CACHE.clear)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                b = whole.slice(at, _ROWS)
                n_words, cand = [], []
                for text in texts(b, place):
                    words = words_of(text)
                    n_words.append(len(words))
                    found: dict[tuple, list[int]] = {}
                    for s, n, fp in candidates(words, bitmap, short, window, k):
                        found.setdefault((_signed(fp), n, b" ".join(words[s:s + n])), []).append(s)
                    cand.append([{"fp": f, "len": n, "text": t.decode(), "starts": s} for (f, n, t), s in found.items()])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(n_words, pa.int64()), pa.array(cand, cand_type)],
                                                 [*kept, "n_words", "cand"])

    probe = source.drop("text").withColumns({"n_words": F.lit(0).cast("long"),
                                             "cand": F.lit(None).cast("array<struct<fp:long,len:int,text:string,starts:array<int>>>")})
    return source.mapInArrow(run, probe.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, k: int = K, carry: bool = False) -> DataFrame:
    """One row per input row: ``id, n_words, n_hit, items`` (sorted ids of items with a window in it)
    and ``row`` with ``carry``."""
    marks = materialise(benchmark_windows(benchmark, item_id_col, item_text_col, window, k), "bench-windows")
    distinct = marks.select("fp", "len", "text").distinct()
    short = [r["len"] for r in marks.filter(F.col("len") < window).select("len").distinct().collect()]  # < window values
    size = marks.agg(F.sum(F.octet_length("text") + F.octet_length(F.coalesce("item_id", F.lit(""))) + 32)).first()[0] or 0
    side = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)

    rows = scan(docs, id_col, text_col, _bitmap(marks.select("fp")), short, window, k, carry)
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "bench-scan")
    found = rows.filter(F.size("cand") > 0).select("rid", F.explode("cand").alias("c")).select("rid", "c.*")
    found = materialise(found.join(side(distinct), ["fp", "len", "text"], "left_semi"), "bench-hits")

    # Words covered: windows in order of start, each adds what lies beyond the furthest end so far.
    spans = F.array_sort(F.flatten(F.collect_list(F.transform("starts", lambda s: F.struct(s.alias("s"), (s + F.col("len")).alias("e"))))))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["end"], x["e"]).alias("end"),
                                (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["end"], x["s"]))).alias("n")),
        lambda acc: acc["n"])
    hit = found.groupBy("rid").agg(covered.alias("n_hit"))
    names = marks.filter("item_id IS NOT NULL").select("fp", "len", "text", "item_id")
    items = (found.join(side(names), ["fp", "len", "text"]).select("rid", "item_id").distinct()
             .groupBy("rid").agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    found_by_row = materialise(hit.join(items, "rid", "left"), "bench-found")
    size = found_by_row.agg(F.sum(32 + 8 * F.size(F.coalesce("items", F.array().cast("array<string>"))) +
                                  F.octet_length(F.concat_ws("", "items")))).first()[0] or 0
    side = F.broadcast if size <= BROADCAST_BYTES else (lambda df: df)
    return (rows.drop("cand").join(side(found_by_row), "rid", "left")
            .select("id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), *(["row"] if carry else [])))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns without those that hold a benchmark window."""
    return decontaminate(docs, benchmark, id_col, text_col, carry=True).filter("n_hit = 0").select("row.*")
