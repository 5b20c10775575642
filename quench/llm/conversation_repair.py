"""Repair of conversations whose turns were lost, emptied, cut, repeated or given the wrong role.

The repaired roles must read (system)? (user assistant)+, or be empty. Keep costs 0, Rerole to
user or assistant 3, Delete 4 (required for blank and duplicate rows), Insert of an empty user or
assistant text 3; a truncated row that is not deleted adds 3. Of the cheapest repairs the one
whose edit initials are ASCII-least is taken.

Method: Hirschberg's divide and conquer over four states (nothing yet, after system, after user,
after assistant). The cost vector forward to the middle and the one backward from the end meet
there; the crossing with the least sum is taken and both halves are solved again, so space is
linear. A prefix's audit ends with a row's own edit and therefore is never a prefix of another's;
so the forward vector needs only the rank of its four audits beside their costs, and of equal sums
the crossing of least rank is the audit-least one.

Scale: equal rows of a turn are counted before they are ordered. Rows are range-partitioned by
(conversation, turn, role, text), so one conversation may span any number of tasks, and read in
chunks of ``CHUNK`` rows. A conversation inside one chunk is solved there. Of the others every chunk
gives its 4 x 4 matrix of costs and ranks; matrices are multiplied in a tree of groups of at most
``FAN`` (the chunks of a task first), and going down the tree again each node's crossings fix the
states between its children: the same divide and conquer, across tasks. What is one value by
its nature (the digest and audit of a conversation) is streamed chunk by chunk.

Cases: null role and text are one space; a null conversation id is a conversation of its own;
turns are ordered with nulls first, rows of the same turn by role and text; roles count by their
first character; repeated rows are duplicates; a conversation with no rows left (``all_ids``) has
zeros, an empty audit and the digest of the empty text; an empty table gives an empty result;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quench.llm.common import col, materialise

SPACE = " \t\n\x0b\x0c\r"
CHUNK, CHUNK_CHARS, FAN = 1024, 8 << 20, 64
INF = 1 << 60
GONE = 8  # the class of rows that must be deleted; others: 2 * initial (s, u, a, other) + truncated
#: State after an insert, and the cost of the inserts that complete the roles at the end.
INSERT = (2, 2, 3, 2)
TAIL = (0, 6, 3, 0)
#: What may stand for one row, in ASCII order of its initials: up to two inserts, then the row's edit.
PIECES = sorted("I" * j + e for j in range(3) for e in "DKR")


def _steps(code: int) -> dict[tuple[int, int], tuple[int, int]]:
    """{(state before, state after): (cost, index of the piece)}, cheapest and ASCII-least."""
    best = {}
    for q in range(4):
        at, seen = q, []
        for j in range(3):
            if at in seen:
                break  # two inserts that lead back
            ends = [("D", at, 4)]
            if code < GONE:
                initial, extra = "sua-"[code // 2], 3 * (code % 2)
                after = 3 if at == 2 else 2
                ends.append(("R", after, 3 + extra))
                if (initial, at) == ("s", 0):
                    ends.append(("K", 1, extra))
                elif initial == "-ua"[after - 1]:
                    ends.append(("K", after, extra))
            for edit, to, cost in ends:
                option = (3 * j + cost, PIECES.index("I" * j + edit))
                best[q, to] = min(best.get((q, to), option), option)
            seen.append(at)
            at = INSERT[at]
    return best


STEPS = [_steps(code) for code in range(GONE + 1)]
MOVES = [[(q, to, cost, piece) for (q, to), (cost, piece) in steps.items()] for steps in STEPS]


def _ranked(found: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    order = sorted(range(4), key=lambda q: found[q][1:])
    rank = [0] * 4
    for r, q in enumerate(order):
        rank[q] = r
    return [f[0] for f in found], rank


def _forward(units, lo: int, hi: int, cost: list[int], rank: list[int]) -> tuple[list[int], list[int]]:
    for code, times in units[lo:hi]:
        more = 4 * (times - 1)
        found = [(INF, 9, 9)] * 4
        for q, to, c, piece in MOVES[code]:
            option = (cost[q] + c + more, rank[q], piece)
            if option < found[to]:
                found[to] = option
        cost, rank = _ranked(found)
    return cost, rank


def _backward(units, lo: int, hi: int, cost: list[int]) -> list[int]:
    for code, times in reversed(units[lo:hi]):
        before = [INF] * 4
        for q, to, c, _ in MOVES[code]:
            before[q] = min(before[q], cost[to] + c + 4 * (times - 1))
        cost = before
    return cost


def _unit(state: int) -> tuple[list[int], list[int]]:
    return [0 if q == state else INF for q in range(4)], [0] * 4


def crossings(units, start: int, end: int) -> list[int]:
    """The state before each unit and after the last, by Hirschberg's recursion."""
    out = [start] * len(units) + [end]

    def solve(lo, hi, s, e):
        if hi - lo < 2:
            return
        mid = (lo + hi) // 2
        cost, rank = _forward(units, lo, mid, *_unit(s))
        rest = _backward(units, mid, hi, _unit(e)[0])
        out[mid] = min(range(4), key=lambda q: (cost[q] + rest[q], rank[q]))
        solve(lo, mid, s, out[mid])
        solve(mid, hi, out[mid], e)

    solve(0, len(units), start, end)
    return out


def matrix(units) -> list[int]:
    """Costs and ranks from each state to each, as 32 numbers."""
    rows = [_forward(units, 0, len(units), *_unit(q)) for q in range(4)]
    return [x for cost, _ in rows for x in cost] + [x for _, rank in rows for x in rank]


def _through(cost: list[int], rank: list[int], m: list[int]) -> tuple[list[int], list[int]]:
    """A forward vector carried through a matrix."""
    return _ranked([min((cost[q] + m[4 * q + to], rank[q], m[16 + 4 * q + to]) for q in range(4)) for to in range(4)])


def product(kids: list[list[int]]) -> list[int]:
    rows = []
    for q in range(4):
        v = _unit(q)
        for m in kids:
            v = _through(*v, m)
        rows.append(v)
    return [min(x, INF) for cost, _ in rows for x in cost] + [x for _, rank in rows for x in rank]


def between(kids: list[list[int]], start: int, end: int) -> list[int]:
    """The states before each of the children and after the last."""
    vectors = [_unit(start)]
    for m in kids[:-1]:
        vectors.append(_through(*vectors[-1], m))
    out = [end]
    for (cost, rank), m in zip(reversed(vectors), reversed(kids)):
        out.append(min(range(4), key=lambda q, c=cost, r=rank, m=m, e=out[-1]: (c[q] + m[4 * q + e], r[q])))
    return out[::-1]


def best_end(m: list[int]) -> int:
    """The last state of a whole conversation, from its matrix."""
    return min(range(4), key=lambda q: (m[q] + TAIL[q], m[16 + q]))


def edits_of(units, rows, start: int, end: int, last: bool) -> tuple[list[tuple], int]:
    """``(edit, times, role, text)`` in order, and their cost; ``rows`` has (role, text) a unit."""
    states, edits, cost = crossings(units, start, end), [], 0

    def insert(state):
        edits.append(("I", 1, "assistant" if state == 2 else "user", ""))
        return INSERT[state]

    for (code, times), (role, text), q, to in zip(units, rows, states, states[1:]):
        c, piece = STEPS[code][q, to]
        cost += c + 4 * (times - 1)
        if times > 1:
            edits.append(("D", times - 1, role, text))
        for _ in range(len(PIECES[piece]) - 1):
            q = insert(q)
        edit = PIECES[piece][-1]
        edits.append((edit, 1, ("assistant" if q == 2 else "user") if edit == "R" else role, text))
    if last:
        cost += TAIL[end]
        for _ in range(TAIL[end] // 3):
            end = insert(end)
    return edits, cost


EDITS = "array<struct<edit:string,times:bigint,role:string,text:string>>"
_EDITS = pa.list_(pa.struct([("edit", pa.string()), ("times", pa.int64()), ("role", pa.string()), ("text", pa.string())]))


def _named(edits):
    return [dict(zip(("edit", "times", "role", "text"), e)) for e in edits]


def _illegal(a: str, b: str) -> int:
    return a[:1] + b[:1] not in ("su", "ua", "au")


class _Chunk:
    """Rows of one conversation in order, with the illegal neighbours among them."""

    def __init__(self, conv):
        self.conv, self.units, self.rows, self.chars, self.illegal, self.count = conv, [], [], 0, 0, 0

    def add(self, role, text, code, times):
        if self.rows:
            self.illegal += _illegal(self.rows[-1][0], role)
        self.illegal += times - 1  # equal neighbours are never a legal pair
        for c, n in ((code, times),) if code == GONE else ((code, 1), (GONE, times - 1)):
            if n:
                self.units.append((c, n))
                self.rows.append((role, text))
        self.chars += len(text)
        self.count += 1


def _chunks(batches, chunk_rows):
    """``(chunk number, chunk, whether it is a whole conversation)`` of a sorted task."""
    def rows():
        for batch in batches:
            yield from zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "role", "text", "code", "times")])

    chunk, number, cut = None, 0, True  # the first conversation of a task may have begun in another
    for conv, role, text, code, times in rows():
        if chunk is not None and chunk.conv == conv and (chunk.count >= chunk_rows or chunk.chars >= CHUNK_CHARS):
            yield number, chunk, False
            chunk, number, cut = _Chunk(conv), number + 1, True
        elif chunk is None or chunk.conv != conv:
            if chunk is not None:
                yield number, chunk, not cut
                number, cut = number + 1, False
            chunk = _Chunk(conv)
        chunk.add(role, text, code, times)
    if chunk is not None:
        yield number, chunk, False  # the last one may go on in another task


def _solve_chunks(conv_type: str, chunk_rows: int):
    schema = (f"conv {conv_type}, part bigint, chunk bigint, edits {EDITS}, cost bigint, illegal bigint, first string, last string,"
              " m array<bigint>, codes array<int>, times array<bigint>, roles array<string>, texts array<string>")

    def task(batches):
        part = TaskContext.get().partitionId()
        fields = {"edits": _EDITS, "m": pa.list_(pa.int64()), "codes": pa.list_(pa.int32()), "times": pa.list_(pa.int64()),
                  "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "first": pa.string(), "last": pa.string()}

        def batch_of(rows, conv_field):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], conv_field if c == "conv" else fields.get(c, pa.int64())) for c in names], names)

        names = ["conv", "part", "chunk", "edits", "cost", "illegal", "first", "last", "m", "codes", "times", "roles", "texts"]
        held, size, kind = [], 0, None

        def watched():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv").type
                yield b

        for number, c, whole in _chunks(watched(), chunk_rows):
            row = dict.fromkeys(names) | {"conv": c.conv, "part": part, "chunk": number, "illegal": c.illegal, "first": c.rows[0][0], "last": c.rows[-1][0]}
            m = matrix(c.units)
            if whole:
                edits, row["cost"] = edits_of(c.units, c.rows, 0, best_end(m), True)
                row["edits"] = _named(edits)
            else:
                row |= {"m": m, "codes": [u for u, _ in c.units], "times": [n for _, n in c.units],
                        "roles": [r for r, _ in c.rows], "texts": [t for _, t in c.rows]}
            held.append(row)
            size += c.chars + 100 * c.count
            if size > CHUNK_CHARS:
                yield batch_of(held, kind)
                held, size = [], 0
        if held:
            yield batch_of(held, kind)

    return task, schema


def _multiply(batches):
    for batch in batches:
        kids = batch.column(batch.schema.get_field_index("kids")).to_pylist()
        m = [product([k["m"] for k in ks]) for ks in kids]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m, pa.list_(pa.int64())), pa.array([best_end(x) for x in m], pa.int32())],
                                         [*batch.schema.names, "m", "best_end"])


def _spread(batches):
    """States for the children of each node whose own first and last state are known."""
    for batch in batches:
        rows = batch.select(["kids", "s", "e"]).to_pylist()
        kids = [[{"kid": k["kid"], "s": s, "e": e} for k, s, e in zip(r["kids"], st, st[1:])]
                for r in rows for st in [between([k["m"] for k in r["kids"]], r["s"], r["e"])]]
        kind = pa.list_(pa.struct([("kid", pa.int64()), ("s", pa.int32()), ("e", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("conv")), batch.column(batch.schema.get_field_index("node")),
                                          pa.array(kids, kind)], ["conv", "node", "states"])


def _fixed_states(open_chunks: DataFrame, conv_type: str, fan: int) -> DataFrame:
    """``conv, part, chunk, s, e, final`` for chunks of conversations that span several, by the tree of matrices."""
    # a node is named by its group on the level above; the first level has the chunks of one task
    level = open_chunks.select("conv", F.col("part").alias("node"), F.col("chunk").alias("kid"), "m")
    levels = []
    most = open_chunks.agg(F.max("part")).first()[0] or 0
    while True:
        grouped = level.groupBy("conv", "node").agg(F.array_sort(F.collect_list(F.struct("kid", "m"))).alias("kids"))
        schema = f"conv {conv_type}, node bigint, kids array<struct<kid:bigint,m:array<bigint>>>, m array<bigint>, best_end int"
        levels.append(materialise(grouped.mapInArrow(_multiply, schema), "repair-tree"))
        if most == 0:
            break
        most //= fan
        top = levels[-1]
        level = top.select("conv", F.floor(F.col("node") / fan).alias("node") if most else F.lit(0).cast("long").alias("node"), F.col("node").alias("kid"), "m")
    states = levels[-1].select("conv", "node", F.lit(0).alias("s"), F.col("best_end").alias("e"), F.lit(True).alias("final"))
    for k, tree in enumerate(reversed(levels)):
        nodes = tree.select("conv", "node", "kids").join(states.select(F.col("conv").alias("c"), F.col("node").alias("n"), "s", "e", "final"),
                                                         F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n")))
        last = nodes.select("conv", "node", F.when(F.col("final"), F.element_at("kids", -1)["kid"]).alias("last"))
        spread = nodes.select("conv", "node", "kids", "s", "e").mapInArrow(
            _spread, f"conv {conv_type}, node bigint, states array<struct<kid:bigint,s:int,e:int>>")
        kids = spread.select("conv", "node", F.explode("states").alias("x")).select("conv", "node", "x.*")
        kids = kids.join(last.select(F.col("conv").alias("c"), F.col("node").alias("n"), "last"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n")))
        kids = kids.withColumn("final", F.coalesce(F.col("kid") == F.col("last"), F.lit(False)))
        final_level = k == len(levels) - 1
        states = materialise(kids.select("conv", *([F.col("node").alias("part"), F.col("kid").alias("chunk")] if final_level else [F.col("kid").alias("node")]),
                                         "s", "e", "final"), "repair-states")
    return states


def _finish(batches):
    """The edits of chunks whose first and last state are known."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            edits, cost = edits_of(list(zip(r["codes"], r["times"])), list(zip(r["roles"], r["texts"])), r["s"], r["e"], r["final"])
            keep = [batch.column(batch.schema.get_field_index(c)).slice(i, 1) for c in ("conv", "part", "chunk")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([_named(edits)], _EDITS), pa.array([cost], pa.int64()), pa.array([r["illegal"]], pa.int64()),
                                              pa.array([r["first"]]), pa.array([r["last"]])],
                                             ["conv", "part", "chunk", "edits", "cost", "illegal", "first", "last"])


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text`` after the damage that a crc32 of conversation and turn decides."""
    def plain(name):
        return F.coalesce(col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat_ws(":", plain(conv_col), plain(turn_col)).cast("binary")), F.lit(20))
    base = rows.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), plain(role_col).alias("role"), plain(text_col).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1))
    return (base.filter("kind <> 0").select("conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                                            text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy"))


def _classed(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, times, blank, first, truncated, code``: equal rows of a turn counted."""
    r1, r2 = F.xxhash64("role", "text"), F.xxhash64(F.lit("second"), "role", "text")
    counted = materialise(rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
                          .withColumn("r1", r1).withColumn("r2", r2), "repair-rows")
    turn = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    firsts = counted.groupBy("conv", "r1", "r2").agg(F.min(turn).alias("at"))
    # one row a side for each key: no key is hot
    firsts = firsts.select(F.col("conv").alias("c"), F.col("r1").alias("a"), F.col("r2").alias("b"), F.col("at.turn").alias("t"), F.lit(True).alias("is_first"))
    same = (F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("r1") == F.col("a")) & (F.col("r2") == F.col("b")))
    text = F.btrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    out = counted.join(firsts, same, "left").select(
        "conv", "turn", "role", "text", "times", (text == "").alias("blank"), F.col("is_first").isNotNull().alias("first"),
        (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.when(initial == "s", 0).when(initial == "u", 2).when(initial == "a", 4).otherwise(6).alias("initial"))
    return materialise(out.withColumn("code", F.when(F.col("blank") | ~F.col("first"), F.lit(GONE)).otherwise(F.col("initial") + F.col("truncated").cast("int"))), "repair-classed")


def _facts(classed: DataFrame) -> DataFrame:
    """Gaps and counts of faults per conversation, pre-aggregated per turn."""
    n, dup = F.col("times"), ~F.col("blank")
    per_turn = classed.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(dup, n - F.col("first").cast("long")).otherwise(0)).alias("duplicate"),
        F.sum(F.when(dup & F.col("first") & F.col("truncated"), 1).otherwise(0)).alias("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return per_turn.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
                                        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def repair(rows: DataFrame, chunk_rows: int = CHUNK, fan: int = FAN) -> DataFrame:
    """The repair of ``conv, turn, role, text`` rows, in chunks: ``conv, part, chunk, edits`` (in the order of part and
    chunk; ``edit, times, role, text``, where deleted rows keep theirs), ``cost, illegal, first, last`` and ``whole``
    (the conversation has no other chunk)."""
    return _repair(_classed(rows), chunk_rows, fan)


def _repair(classed: DataFrame, chunk_rows: int, fan: int) -> DataFrame:
    conv_type = classed.schema["conv"].dataType.simpleString()
    nulls_first = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64).asc(), F.substring("text", 1, 64).asc()]
    dealt = (classed.select("conv", "turn", "role", "text", "code", "times").repartitionByRange(*nulls_first)
             .sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"))
    task, schema = _solve_chunks(conv_type, chunk_rows)
    chunks = materialise(dealt.select("conv", "role", "text", "code", "times").mapInArrow(task, schema), "repair-chunks")
    shown = ["conv", "part", "chunk", "edits", "cost", "illegal", "first", "last"]
    is_open = F.col("m").isNotNull()
    states = _fixed_states(chunks.filter(is_open), conv_type, fan).select(F.col("conv").alias("c"), F.col("part").alias("p"), F.col("chunk").alias("k"), "s", "e", "final")
    rest = chunks.filter(is_open).join(states, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("chunk") == F.col("k")))
    done = rest.select("conv", "part", "chunk", "illegal", "first", "last", "codes", "times", "roles", "texts", "s", "e", "final").mapInArrow(
        _finish, f"conv {conv_type}, part bigint, chunk bigint, edits {EDITS}, cost bigint, illegal bigint, first string, last string")
    return materialise(chunks.filter(~is_open).select(*shown).withColumn("whole", F.lit(True))
                       .unionByName(done.withColumn("whole", F.lit(False))), "repair-edits")


def _stream(batches):
    """Digest, audit, cost and illegal pairs of conversations that arrive chunk by chunk in order."""
    def rows():
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1).to_pylist()[0], batch.column(batch.schema.get_field_index("conv")).slice(i, 1)

    def result():
        return pa.RecordBatch.from_arrays([conv, pa.array([illegal]), pa.array([cost]), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])],
                                          ["conv", "illegal", "cost", "audit", "repaired_sha256"])

    conv = None
    for r, key in rows():
        if conv is None or r["conv"] != conv[0].as_py():
            if conv is not None:
                yield result()
            conv, illegal, cost, audit, digest, last, some = key, 0, 0, [], hashlib.sha256(), None, False
        illegal += r["illegal"] + (0 if last is None else int(_illegal(last, r["first"])))
        cost, last = cost + r["cost"], r["last"]
        audit.append(r["audit"])
        if r["repaired"]:
            digest.update(("\n" * some + r["repaired"]).encode())
            some = True
    if conv is not None:
        yield result()


def digests(all_ids: DataFrame, rows: DataFrame, chunk_rows: int = CHUNK, fan: int = FAN) -> DataFrame:
    """One row per id of ``all_ids`` (column ``conv``): ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` of the repair of ``rows``."""
    classed = _classed(rows)
    conv_type = classed.schema["conv"].dataType.simpleString()
    edits = F.col("edits")
    audit = F.array_join(F.transform(edits, lambda e: F.repeat(e["edit"], e["times"].cast("int"))), "")
    repaired = F.array_join(F.transform(F.filter(edits, lambda e: e["edit"] != "D"), lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n")
    pieces = _repair(classed, chunk_rows, fan).withColumn("audit", audit).withColumn("repaired", repaired)
    whole = pieces.filter("whole").select("conv", "illegal", "cost", "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    spread = (pieces.filter("NOT whole").select("conv", "part", "chunk", "illegal", "first", "last", "cost", "audit", "repaired")
              .repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", "chunk")
              .mapInArrow(_stream, f"conv {conv_type}, illegal bigint, cost bigint, audit string, repaired_sha256 string"))
    every = (all_ids.select("conv").unionByName(_facts(classed), allowMissingColumns=True)
             .unionByName(whole, allowMissingColumns=True).unionByName(spread, allowMissingColumns=True))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.groupBy("conv").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
