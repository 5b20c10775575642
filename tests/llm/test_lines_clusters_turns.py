"""Line de-duplication, centroid clustering and conversation repair against plain versions."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quench.llm import conversation_repair as cr
from quench.llm import kmeans, line_dedup
from quench.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.fixtures import EXTRA, ROWS, documents
from tests.llm.test_operators import same

SF = "/root/testdata/sf0.001"
A, B, C = "This line is shared by many documents.", "  ANOTHER shared line of the corpus\t", "short line"
LINES = [*ROWS, (20, f"{A}\n{C}\n{B}"), (21, f"{A.upper()}\r\n{C}\n\n{A}"), (21, f"{A}\nunique line number one of all"), (22, f"x\n{A} \n{B}\n{C}"),
         (23, "another SHARED line of the corpus"), (None, A), (None, f"{A}\n"), (24, "\n".join(f"line {i % 700} of a very long document" for i in range(20_000))),
         (25, "\n".join(f"line {i} of a very long document" for i in range(300))), (26, "\n".join(f"LINE {i} of a very long document" for i in range(100, 400)))]


def line_rows(found):
    return [(r["id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()]


@pytest.mark.parametrize("batches, fanout", [(4, 2), (7, 3), (1, 2)])
def test_line_dedup_awkward(spark, batches, fanout):
    docs = documents(spark, [(i, t, "en") for i, t, *_ in LINES])
    found = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout)
    rows = [r[:2] for r in LINES]
    same(line_rows(found), [(i, *w) for (i, _), w in zip(rows, brute.line_dedup(rows))])
    assert found.select("row.*").columns == ["doc_id", "text", "lang", *EXTRA]


def test_line_dedup_large_side_by_shuffle(spark, monkeypatch):
    """Too many frequent keys and documents for a broadcast: hot keys apart, the same rows."""
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", 1)
    monkeypatch.setattr(line_dedup, "BROADCAST_DOCS", 1)
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 1000)
    rows = [r[:2] for r in LINES]
    same(line_rows(line_dedup.dedup_lines(documents(spark, [(i, t, "en") for i, t in rows]))),
         [(i, *w) for (i, _), w in zip(rows, brute.line_dedup(rows))])


def test_line_dedup_empty(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []


def test_runs_are_disjoint_and_levelled(spark):
    runs, seen = line_dedup.Runs(spark, 2), {}
    rng = random.Random(3)
    for b in range(5):
        keys = {rng.randrange(60): rng.randrange(1, 4) for _ in range(30)}
        frame = spark.createDataFrame([(k, k, n, n, 100 - b) for k, n in keys.items()], "h1 long, h2 long, n long, m long, top long")
        hits = [tuple(r[c] for c in ("h1", "n", "run_n", "run_top")) for f in runs.add(frame) for r in f.collect()]
        assert sorted(hits) == sorted((k, n, *seen[k]) for k, n in keys.items() if k in seen)
        seen = {k: (n, 100 - b) for k, n in keys.items()} | seen
    held = [(r["h1"], r["n"], r["top"]) for run in runs.runs for r in run.collect()]
    assert sorted(held) == sorted((k, *v) for k, v in seen.items())
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    plan = runs.runs[0].join(runs.runs[1].hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]


VECTORS = [(1, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, [0.1, 0.2, 0.3]), (3, None), (4, [0.1, None, 0.3]), (5, [0.1, float("nan"), 0.3]),
           (6, [float("inf"), 0.0, 0.0]), (7, [1.0, 2.0]), (8, []), (None, [0.3, -1.7, 2.5]), (None, [0.4, -1.7, 2.5]), (9, [-0.001, 0.999, 3.75]),
           (10, [-3.0, 1.0, 0.0]), (11, [0.0, 0.0, 0.0]), (12, [0.0, 0.0, 0.0])]


def vectors(spark, rows):
    extra = ", ".join(f"`{c}` int" for c in ("v", "id", "cluster", "x"))
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], f"vec_id long, embedding array<double>, {extra}").repartition(3)


@pytest.mark.parametrize("k", [1, 4, 40])
def test_clustering_awkward(spark, k):
    got = kmeans.with_inertia(*kmeans.cluster(vectors(spark, VECTORS), k=k, dims=3)).collect()
    same([tuple(r) for r in got], brute.kmeans(VECTORS, k=k, dims=3))


def test_clustering_given(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").limit(200).collect()]
    got = kmeans.with_inertia(*kmeans.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    same([tuple(r) for r in got.collect()], brute.kmeans(rows))


def test_clustering_empty_and_too_large(spark):
    assert kmeans.with_inertia(*kmeans.cluster(vectors(spark, []), dims=3)).collect() == []
    assert kmeans.with_inertia(*kmeans.cluster(vectors(spark, [(1, None)]), dims=3)).collect() == []
    with pytest.raises(ValueError, match="too large"):
        kmeans.cluster(vectors(spark, [(1, [1e300, 0.0, 0.0])]), dims=3)


def test_table_gathers_are_exact():
    rng = np.random.default_rng(2)
    v, w = rng.integers(-500, 500, (300, 7)), rng.integers(-500, 500, (9, 7))
    w[4] = w[2]  # a tie
    plain = ((v[:, None] - w[None]) ** 2).sum(2)
    got = kmeans.nearest(v, w)
    assert (got[0] == plain.argmin(1)).all() and (got[1] == plain.min(1)).all()


def units_of(faults, rows):
    code = {"s": 0, "u": 2, "a": 4}
    return [(cr.GONE if f in ("blank", "duplicate") else code.get(r[:1], 6) + (f == "truncated"), 1) for f, (r, _) in zip(faults, rows)]


def repaired(units, rows, start=0, end=None):
    edits, cost = cr.edits_of(units, rows, start, cr.best_end(cr.matrix(units)) if end is None else end, True)
    return cost, "".join(e[0] * e[1] for e in edits), tuple(f"{e[2]}:{e[3]}" for e in edits if e[0] != "D")


def test_repair_is_the_audit_least_cheapest():
    """All conversations of up to three rows, and random longer ones."""
    rng = random.Random(5)
    kinds = list(itertools.product(("system", "user", "assistant", "tool", ""), ("", "truncated", "blank")))
    cases = [c for n in range(1, 4) for c in itertools.product(kinds, repeat=n)]
    cases += [[rng.choice(kinds) for _ in range(rng.randrange(4, 40))] for _ in range(300)]
    for case in cases:
        rows, faults = [(r, "t") for r, _ in case], [f for _, f in case]
        assert repaired(units_of(faults, rows), rows) == brute.cheapest_repair(faults, rows)


def test_tree_of_matrices_gives_the_same_crossings():
    rng = random.Random(6)
    for _ in range(200):
        units = [(rng.randrange(9), 1) for _ in range(rng.randrange(2, 60))]
        units = [(c, rng.randrange(1, 4) if c == cr.GONE else 1) for c, _ in units]
        cuts = [0, *sorted(rng.sample(range(1, len(units)), min(len(units) - 1, 3))), len(units)]
        parts = [units[a:b] for a, b in zip(cuts, cuts[1:])]
        kids = [cr.matrix(p) for p in parts]
        assert cr.product(kids) == cr.matrix(units) or all(
            a == b or min(a, b) >= cr.INF for a, b in zip(cr.product(kids)[:16], cr.matrix(units)[:16]))
        end = cr.best_end(cr.matrix(units))
        states = cr.between(kids, 0, end)
        whole = cr.crossings(units, 0, end)
        assert states == [whole[c] for c in cuts]


def turns(spark, rows):
    extra = ", ".join(f"`{c}` int" for c in ("conv", "code", "m", "part"))
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], f"conv_id long, turn long, role string, text string, {extra}").repartition(5)


def awkward_turns():
    rng = random.Random(9)
    words = ["Hello there.", "no end", "", " \n", "What?", "long " * 3000 + "end.", "É.", None]
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(words)) for c in [*range(40), None] for _ in range(rng.randrange(1, 9))]
    rows += [(100, t, rng.choice(roles[:2]), rng.choice(["a.", "b", f"text {t}.", f"cut {t}"])) for t in range(600)]
    rows += [(101, 3, "user", "same.")] * 300 + [(101, 4, "assistant", "x.")] * 2
    rows += [(102, t, "user" if t % 2 == 0 else "assistant", "ok.") for t in range(200)]
    return rows


COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("chunk_rows, fan", [(1024, 64), (5, 2), (1, 3)])
def test_repair_awkward(spark, chunk_rows, fan):
    rows = awkward_turns()
    given = turns(spark, rows)
    got = cr.digests(given.select(F.col("conv_id").alias("conv")), cr.damage(given), chunk_rows, fan).select(COLUMNS).collect()
    same([tuple(r) for r in got], brute.conversations([r[0] for r in rows], brute.damage(rows)))


def test_repair_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Cut"), (1, 2, "user", "Hi.")]
    frame = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    edits = [tuple(e) for r in cr.repair(frame).orderBy("part", "chunk").collect() for e in r["edits"]]
    assert edits == [("K", 1, "user", "Hi."), ("R", 1, "assistant", "Cut"), ("D", 1, "user", "Hi.")]


def test_repair_empty(spark):
    given = turns(spark, [])
    assert cr.digests(given.select(F.col("conv_id").alias("conv")), cr.damage(given)).collect() == []


def test_repair_given(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.01").select("conv_id", *COLUMNS[1:]).collect()
    same([tuple(r) for r in got], brute.conversations([r[0] for r in rows], brute.damage(rows)))
