r"""Secret scan: fixed rules plus a comparison of two character Markov models.

Base rules (leftmost, non-overlapping within a kind) find assignments, access keys and
long hexadecimal runs. The method adds strings that look random: a first-order Markov
model of the characters of random strings, trained on all that the base rules found in
the corpus, against one of ordinary identifiers, trained on the tokens of a bounded sample of
documents outside any base match (``SAMPLE`` documents of least id hash). A candidate (a run of
``LEAST`` or more token characters with a letter) whose log-likelihood ratio
reaches ``THRESHOLD``, and ``RATE`` for each pair of characters, is added as kind ``random``
unless it overlaps a base span. Without the rate, long ordinary names of a form that is rare in the
sample (paths, camel case) would sum many small steps up to the threshold.

Everything is DataFrame functions. Regular expressions run on whole texts; a match's place
follows from the lengths of the gaps before it (``split``) and of the matches
(``regexp_extract_all``). The models are at most 128 x 128 character pairs, counted in Spark
and handed back as one constant array. Scanning needs no shuffle.

Cases: null or empty texts have no span; rows that repeat a doc_id are scanned each for
itself; without base matches the random model is uniform; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quench.llm.common import col, text_of

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so demanding the length in the pattern finds the same matches as filtering by it.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN = 6
TOKEN, LEAST = r"[A-Za-z0-9+/_=-]", 16
#: A maximal run of token characters with a letter among them.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*+[A-Za-z])" + TOKEN + "{%d,}" % LEAST
THRESHOLD = 12.0
RATE = 2.0
SAMPLE = 4000
#: Matches folded into one array at a time: appending copies, so a text of n matches costs n * CHUNK + (n / CHUNK)^2 steps.
CHUNK = 256
_ALPHABET = 67
_PRIOR_RANDOM, _PRIOR_ORDINARY = 20.0, 5.0


def _located(text: Column, pattern: str, guard: Column, value_group: int = 0, least: int = 0) -> Column:
    """array<struct<s, e, v>>: start, end (code points) and value of each match whose value has ``least`` characters.

    ``guard`` is a cheap condition without which a text has no match."""
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if value_group:
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
        matches = F.zip_with(whole, value, lambda m, v: F.struct(F.length(m).alias("m"), v.alias("v")))
    else:
        matches = F.transform(whole, lambda m: F.struct(F.length(m).alias("m"), m.alias("v")))
    parts = F.zip_with(gaps, matches, lambda g, x: F.struct(F.length(g).alias("g"), x["m"].alias("m"), x["v"].alias("v")))
    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    place = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def one(a: Column, x: Column) -> Column:
        ends = a["at"] + x["g"] + F.coalesce(x["m"], F.lit(0))
        span = F.struct((a["at"] + x["g"]).alias("s"), ends.alias("e"), x["v"].alias("v"))
        return F.struct(ends.alias("at"), F.when(x["m"].isNotNull() & (F.length(x["v"]) >= least), F.concat(a["out"], F.array(span)))
                        .otherwise(a["out"]).alias("out"))

    def chunk(done: Column, xs: Column) -> Column:
        return F.concat(done, F.array(F.aggregate(xs, F.struct(F.element_at(done, -1)["at"].alias("at"), none.alias("out")), one)))

    def folded(p: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(p), F.lit(CHUNK))
        return F.aggregate(firsts, F.array(place), lambda done, i: chunk(done, F.slice(p, i, CHUNK)),
                           lambda done: F.flatten(F.transform(done, lambda d: d["out"])))

    found = F.get(F.transform(F.array(parts), folded), 0)  # a lambda's argument, so that the parts are found once
    return F.when(guard, found).otherwise(none)


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    t = F.col("text")
    return text.select("id", "text", _located(t, ASSIGN, t.contains("=") | t.contains(":"), 2, LEAST_ASSIGN).alias("assign"),
                       _located(t, ACCESS, t.contains("AKIA")).alias("access"), _located(t, HEX, t.rlike(HEX)).alias("hex"))


def _pairs(strings: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of adjacent ASCII characters in the column ``t``: at most 128 x 128 rows reach the driver."""
    chars = strings.select(F.split("t", "").alias("c")).filter(F.size("c") > 1)
    pairs = chars.select(F.explode(F.zip_with(
        F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: F.ascii(a) * 128 + F.ascii(b))).alias("p"))
    return {divmod(r["p"], 128): r["n"] for r in pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect() if r["p"] < 128 * 128}


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> list[float]:
    """The log-likelihood ratio of every character pair (row-major, 128 x 128): random over ordinary."""
    found = _base(docs, id_col, text_col).select(F.explode(F.concat(*[F.transform(k, lambda x: x["v"]) for k in KINDS[:3]])).alias("t"))
    random = _pairs(found)
    picked = docs.select(col(id_col).alias("id")).filter("id IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(sample)
    plain = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(picked.distinct()), "id", "left_semi")
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = plain.withColumn("text", F.regexp_replace("text", pattern, " "))
    tokens = plain.select(F.explode(F.regexp_extract_all("text", F.lit(TOKEN + "{6,}"), F.lit(0))).alias("t")).filter(F.col("t").rlike("[A-Za-z]"))
    ordinary = _pairs(tokens)

    def log_p(counts: dict[tuple[int, int], int], prior: float) -> list[float]:
        rows = [0] * 128
        for (a, _), n in counts.items():
            rows[a] += n
        return [math.log((counts.get((a, b), 0) + prior / _ALPHABET) / (rows[a] + prior)) for a in range(128) for b in range(128)]

    return [round(r - o, 6) for r, o in zip(log_p(random, _PRIOR_RANDOM), log_p(ordinary, _PRIOR_ORDINARY))]


def ratio(token: Column, model: list[float]) -> Column:
    """The token's log-likelihood ratio under ``model``."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    chars = F.split(token, "")
    steps = F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1),
                       lambda a, b: F.get(table, F.ascii(a) * 128 + F.ascii(b)))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def scan(docs: DataFrame, model: list[float], id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         rate: float = RATE) -> DataFrame:
    """``id, assign, access, hex, random``: arrays of (s, e, v); ``random`` are the spans that the models add."""
    base = _base(docs, id_col, text_col)
    taken = F.concat("assign", "access", "hex")
    candidates = _located(F.col("text"), CANDIDATE, F.col("text").rlike(CANDIDATE))
    added = F.filter("candidates", lambda x: ~F.exists("taken", lambda t: (t["s"] < x["e"]) & (x["s"] < t["e"]))
                     & (ratio(x["v"], model) >= F.greatest(F.lit(threshold), F.lit(rate) * (F.length(x["v"]) - 1))))
    return (base.withColumn("taken", taken).withColumn("candidates", candidates)
            .select("id", "assign", "access", "hex", added.alias("random")))


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of the spans of these kinds, by start, then kind as listed, comma-joined."""
    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e"), F.lit(kind).alias("name")))

    return F.array_join(F.transform(F.array_sort(F.concat(*map(tagged, kinds))),
                                    lambda x: F.concat_ws(":", x["name"], x["s"].cast("string"), x["e"].cast("string"))), ",")
