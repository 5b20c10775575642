"""Language-model scores by a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing: a context h that was seen c(h)
times gives P(w|h) = (c(hw) + mu P(w|h')) / (c(h) + mu), with h' the context without its
first word, down to the additive unigram model. As an automaton, every seen context is a
state; a seen continuation is an arc that carries the logarithm of that value; any other
word follows the failure arc, which carries log(mu / (c(h) + mu)) and leads to h'. One
left-to-right traversal of a text carries the state and adds up the arcs' weights.

The model covers all training rows and grows with the corpus, so no task holds it whole:

1. Documents are packed into blocks of some megabytes of text, kept as token numbers and the
   hashes of the block's words (written, so that both later passes see the same blocks and
   neither splits a text again).
2. Every block sends the hashes of its distinct n-grams, with its own training counts,
   to hash buckets; a bucket sums the counts over blocks and answers each block with the
   totals of what it asked for, in the same order. Counts are combined in the block before
   the shuffle, so the commonest words cost a row a block. Buckets grow in number with
   the tokens. There is a row for every block and bucket, so their sizes bound the rows:
   16 times fewer of them for blocks and buckets four times as large.
3. Every block builds the automaton of its own n-grams from the answers and scores its
   documents with it. This gives the same scores as the whole model, since a traversal
   only meets arcs and states of the text's own n-grams. The texts of a block are traversed
   side by side, a NumPy lane each; a long text is several lanes, each of which
   first reads the ``order - 1`` tokens before it, after which its state no longer
   depends on what came earlier.

Cases: null or empty texts are the end token alone; rows that repeat a doc_id are scored
(and learnt from) each for itself; a null doc_id counts as the empty text for the fold;
without training rows all counts are zero; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quench.llm.common import col, fold, materialise, text_of

ORDER = 2
MU = 30.0
ADD = 0.1
FOLDS, HELD_OUT = 10, 0
BLOCK_BYTES = 16 << 20
#: n-gram entries (before merging) that a bucket holds, on average.
BUCKET_ENTRIES = 4_000_000
#: Tokens that a lane of the traversal scores.
LANE = 256
_END, _START = b"\n", b"\n\n"  # no word contains white space
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BLOCK_SCHEMA = "block long, tokens long, documents binary, sequence binary, words binary"


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _documents(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_next_batch()


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, tokens, documents, sequence, words``: whole documents as token numbers, and the hash behind each number."""
    source = docs.select(col(id_col).alias("id"), (fold(id_col, FOLDS) == HELD_OUT).alias("held_out"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        sequences: list[np.ndarray] = []
        number: dict[bytes, int] = {_START: 0, _END: 1}

        def out():
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lengths = pa.array([len(x) - 1 for x in sequences], pa.int64())
            rows = pa.RecordBatch.from_arrays([*rows.columns, lengths], ["id", "held_out", "n_tokens"])
            words = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([sum(map(len, sequences))]), pa.array([_ipc(rows)], pa.binary()),
                 pa.array([_pack(np.concatenate(sequences))], pa.binary()), pa.array([words.tobytes()], pa.binary())],
                ["block", "tokens", "documents", "sequence", "words"])

        for b in batches:
            at, rows = 0, b.select(["id", "held_out"])
            for i, t in enumerate(b.column("text")):
                text = t.as_py().encode().lower()
                size += len(text)
                sequences.append(np.array([0, *[number.setdefault(w, len(number)) for w in text.split()], 1], np.int32))
                if size >= block_bytes:
                    held.append(rows.slice(at, i + 1 - at))
                    yield out()
                    at, held, sequences, number, size, block = i + 1, [], [], {_START: 0, _END: 1}, 0, block + 1
            if at < b.num_rows:
                held.append(rows.slice(at))
        if held:
            yield out()

    return source.mapInArrow(run, _BLOCK_SCHEMA)


class Grams:
    """The n-grams of a block's documents, each text as start, words, end.

    ``starts``: where each text begins in the block's sequence of tokens. ``ids[k]``: by position, the
    local number of the k-gram that ends there (-1: none);
    ``keys[k]``: the distinct k-grams' sorted hashes, tagged with k; ``first[k]``: a position of each.
    """

    def __init__(self, batch: pa.RecordBatch, sequence: bytes, words: bytes, order: int):
        token = _unpack(sequence, "<i4")
        self.n_tokens = batch.column("n_tokens").to_numpy()
        lengths = self.n_tokens + 1
        self.starts = np.cumsum(lengths) - lengths
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(token)) - self.starts[self.document]
        word = np.frombuffer(words, "<u8")[token]
        self.train = ~np.array(batch.column("held_out").to_pylist(), bool)[self.document]
        self.ids, self.keys, self.first, gram = {}, {}, {}, word
        for k in range(1, order + 1):
            if k > 1:
                gram = np.concatenate([gram[:1], gram[:-1]]) * _MULT + word
                gram ^= gram >> np.uint64(31)
            valid = np.flatnonzero(place >= max(k - 1, 1))  # the start alone is not a token
            tagged = (gram[valid] & ~np.uint64(3)) | np.uint64(k - 1)
            keys, first, inverse = np.unique(tagged, return_index=True, return_inverse=True)
            ids = np.full(len(token), -1, np.int64)
            ids[valid] = inverse
            self.ids[k], self.keys[k], self.first[k] = ids, keys, valid[first]

    def counts(self, k: int) -> np.ndarray:
        """The block's training count of each distinct k-gram."""
        at = (self.ids[k] >= 0) & self.train
        return np.bincount(self.ids[k][at], minlength=len(self.keys[k])).astype(np.uint32)

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """All orders' keys in ascending order, and what sorts them."""
        keys = np.concatenate([self.keys[k] for k in sorted(self.keys)])
        by = np.argsort(keys, kind="stable")
        return keys[by], by


def _bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin and end in sorted keys (bucket: range of the top 32 bits)."""
    edge = np.array([((b << 32) + buckets - 1) // buckets for b in range(buckets)], np.uint64) << np.uint64(32)
    return np.concatenate([np.searchsorted(keys, edge), [len(keys)]])


def _pack(a: np.ndarray) -> bytes:
    """Bytes of equal significance together, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes())


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def requests(packed: DataFrame, order: int, buckets: int) -> DataFrame:
    """``bucket, block, keys, counts``: sorted n-gram hashes (as differences) and training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, *parts in zip(b.column("block").to_pylist(), b.column("documents"), b.column("sequence"), b.column("words")):
                rows, sequence, words = [x.as_py() for x in parts]
                grams = Grams(_documents(rows), sequence, words, order)
                keys, by = grams.flat()
                counts = np.concatenate([grams.counts(k) for k in sorted(grams.keys)])[by]
                edges = _bucket_edges(keys, buckets)
                rows = [(i, s, e) for i, (s, e) in enumerate(zip(edges[:-1], edges[1:])) if e > s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _, _ in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()),
                     pa.array([_pack(np.diff(keys[s:e], prepend=np.uint64(0))) for _, s, e in rows], pa.binary()),
                     pa.array([_pack(counts[s:e]) for _, s, e in rows], pa.binary())], ["bucket", "block", "keys", "counts"])

    return packed.mapInArrow(run, "bucket int, block long, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """``block, bucket, totals`` for every request, and the bucket's part of ``n`` (training tokens) and ``v`` (distinct ones)."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpack(x.as_py(), "<u8"), dtype=np.uint64) for x in table.column("keys")]
        counts = [_unpack(x.as_py(), "<u4") for x in table.column("counts")]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.uint64)
        one = totals[(distinct & np.uint64(3)) == 0]
        ends = np.cumsum([len(k) for k in keys])
        rest = [0] * (len(keys) - 1)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "totals": pa.array([_pack(totals[inverse[e - len(k):e]]) for k, e in zip(keys, ends)], pa.binary()),
                         "n": pa.array([int(one.sum()), *rest], pa.int64()), "v": pa.array([int((one > 0).sum()), *rest], pa.int64())})

    return asked.groupBy("bucket").applyInArrow(run, "block long, bucket int, totals binary, n long, v long")


class Automaton:
    """States are the block's seen contexts (0: the root). The arcs, sorted by ``state * width + token``,
    lead to ``go`` with ``weight``; a state's failure arc leads to ``fail_to``, the shorter context, with ``fail_weight``;
    the root has an arc for every token."""

    def __init__(self, grams: Grams, totals: dict[int, np.ndarray], n: int, v: int, order: int, mu: float):
        token = grams.ids[1]
        base, width = {1: 1}, len(grams.keys[1])
        for k in range(2, order):
            base[k] = base[k - 1] + len(grams.keys[k - 1])
        self.start = base[order - 1] + len(grams.keys[order - 1]) if order > 1 else 0  # the state of a text's beginning
        self.width, self.order = width, order
        p = {1: (totals[1] + ADD) / (n + ADD * (v + 1))}
        self.root_go = base[1] + np.arange(width) if order > 1 else np.zeros(width, np.int64)
        self.root_weight = np.log10(p[1])
        # A beginning precedes every training text's first word, so it was seen as often as the end.
        end = token[grams.starts[0] + grams.n_tokens[0]] if width else 0
        began = float(totals[1][end]) if width else 0.0
        fail_to, fail_weight = [np.zeros(1, np.int64)], [np.zeros(1)]
        if order > 1:
            fail_to.append(np.zeros(width, np.int64))
            fail_weight.append(np.log10(mu / (totals[1] + mu)))
        arcs, go, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for k in range(2, order + 1):
            at = grams.first[k]
            if k == 2:
                from_start = grams.ids[1][at - 1] < 0
                context = np.where(from_start, began, totals[1][grams.ids[1][at - 1]])
                state = np.where(from_start, self.start, base[1] + grams.ids[1][at - 1])
            else:
                context, state = totals[k - 1][grams.ids[k - 1][at - 1]], base[k - 1] + grams.ids[k - 1][at - 1]
            shorter = grams.ids[k - 1][at]
            p[k] = (totals[k] + mu * p[k - 1][shorter]) / (context + mu)
            seen = totals[k] > 0
            arcs.append((state * width + token[at])[seen])
            go.append((base[k] + np.arange(len(at)) if k < order else base[k - 1] + shorter)[seen])
            weight.append(np.log10(p[k])[seen])
            if k < order:
                fail_to.append(base[k - 1] + shorter)
                fail_weight.append(np.log10(mu / (totals[k] + mu)))
        if order > 1:
            fail_to.append(np.zeros(1, np.int64))
            fail_weight.append(np.array([np.log10(mu / (began + mu))]))
        self.fail_to, self.fail_weight = np.concatenate(fail_to), np.concatenate(fail_weight)
        arcs = np.concatenate(arcs)
        by = np.argsort(arcs)
        self.arcs = np.concatenate([arcs[by], [np.iinfo(np.int64).max]])  # the last one matches nothing
        self.go, self.weight = np.concatenate(go)[by], np.concatenate(weight)[by]

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each lane's token leads and the weights met on the way: failure arcs until some state has an arc."""
        total, to, open_ = np.zeros(len(state)), np.empty(len(state), np.int64), np.arange(len(state))
        while len(open_):
            at = state[open_]
            root = at == 0
            key = at * self.width + token[open_]
            arc = np.searchsorted(self.arcs, key)
            found = (self.arcs[arc] == key) & ~root
            lane, arc = open_[found], arc[found]
            to[lane] = self.go[arc]
            total[lane] += self.weight[arc]
            lane = open_[root]
            to[lane] = self.root_go[token[lane]]
            total[lane] += self.root_weight[token[lane]]
            open_ = open_[~found & ~root]
            total[open_] += self.fail_weight[state[open_]]
            state[open_] = self.fail_to[state[open_]]
        return to, total

    def scores(self, token: np.ndarray, starts: np.ndarray, n_tokens: np.ndarray, lane: int) -> np.ndarray:
        """The log-probability of each text: its tokens follow the beginning at ``starts``."""
        cuts = -(-n_tokens // lane)
        document = np.repeat(np.arange(len(starts)), cuts)
        part = np.arange(len(document)) - (np.cumsum(cuts) - cuts)[document]
        begin = starts[document] + 1 + part * lane
        end = np.minimum(begin + lane, (starts + n_tokens + 1)[document])
        position = begin - np.minimum(self.order - 1, part * lane)
        by = np.argsort(position - end)  # longest first, so that the lanes still open are a prefix
        begin, end, position = begin[by], end[by], position[by]
        state = np.where(position == starts[document[by]] + 1, self.start, 0)
        total = np.zeros(len(by))
        steps = end - position
        for i in range(int(steps.max(initial=0))):
            m = int(np.searchsorted(-steps, -i))
            state[:m], weight = self.step(state[:m], token[position[:m] + i])
            total[:m] += np.where(position[:m] + i >= begin[:m], weight, 0.0)
        return np.bincount(document[by], weights=total, minlength=len(starts))


def _scored(batch: pa.RecordBatch, sequence: bytes, words: bytes, reply: list[tuple[int, bytes]], n: int, v: int, order: int, mu: float,
            lane: int) -> dict[str, pa.Array]:
    grams = Grams(batch, sequence, words, order)
    keys, by = grams.flat()
    flat = np.empty(len(keys), np.uint64)
    flat[by] = np.concatenate([_unpack(t, "<u8") for _, t in sorted(reply)])
    cuts = np.cumsum([len(grams.keys[k]) for k in sorted(grams.keys)])[:-1]
    totals = {k: part.astype(np.float64) for k, part in zip(sorted(grams.keys), np.split(flat, cuts))}
    at = grams.ids[1] >= 0
    one, doc, docs = totals[1][grams.ids[1][at]], grams.document[at], batch.num_rows
    automaton = Automaton(grams, totals, n, v, order, mu)
    score = automaton.scores(grams.ids[1], grams.starts, grams.n_tokens, lane)
    base = np.log10((one + ADD) / (n + ADD * (v + 1)))
    return {"held_out": batch.column("held_out"), "n_tokens": pa.array(grams.n_tokens),
            "n_known": pa.array(np.bincount(doc, weights=one > 0, minlength=docs).astype(np.int64)),
            "train_tokens": pa.array([n] * docs, pa.int64()), "base_score": pa.array(np.bincount(doc, weights=base, minlength=docs)),
            "score": pa.array(score)}


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, mu: float = MU,
              block_bytes: int = BLOCK_BYTES, bucket_entries: int = BUCKET_ENTRIES, lane: int = LANE) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row (logarithms to base 10)."""
    if not 1 <= order <= 4:
        raise ValueError("order is 1 to 4")
    packed = materialise(blocks(docs, id_col, text_col, block_bytes), "lm-blocks")
    tokens = packed.agg(F.sum("tokens")).first()[0] or 0
    buckets = max(1, -(-tokens * order // bucket_entries))
    replies = materialise(answers(requests(packed, order, buckets)), "lm-answers")
    n, v = (x or 0 for x in replies.agg(F.sum("n"), F.sum("v")).first())

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        reply = list(zip(right.column("bucket").to_pylist(), right.column("totals").to_pylist()))
        for parts in zip(left.column("documents"), left.column("sequence"), left.column("words")):
            rows, sequence, words = [x.as_py() for x in parts]
            batch = _documents(rows)
            out.append(pa.table({"id": batch.column("id"), **_scored(batch, sequence, words, reply, n, v, order, mu, lane)}))
        return pa.concat_tables(out).combine_chunks()

    schema = T.StructType([T.StructField("id", docs.select(col(id_col)).schema[0].dataType),
                           *T._parse_datatype_string("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")])
    return packed.groupBy("block").cogroup(replies.select("block", "bucket", "totals").groupBy("block")).applyInArrow(run, schema)
