r"""Personal data: fixed rules plus a semi-Markov conditional random field.

Base rules find e-mail addresses, IP addresses, payment cards and phone numbers (leftmost,
non-overlapping within a kind). The field scores whole candidate spans by features of the
span (shape, digits, separators, checksum, range of parts, length, neighbours) for each
kind; a dynamic program over segments of at most ``MAX_TOKENS`` tokens picks boundaries and
kinds jointly. It runs on the regions around digits and at-signs, since no other span can
start a candidate. Spans that it finds and that overlap no base span are added.

The field's weights maximise the conditional likelihood (forward-backward, AdaGrad) of the
base rules' own spans in a bounded sample: the regions of at most ``SAMPLE`` documents of
least id hash, of at most ``SAMPLE_CHARS`` characters, at most ``REGIONS`` of them. Scanning
reads every whole text in one pass without a shuffle.

Cases: null or empty texts have no span; rows that repeat a doc_id are scanned each for
itself; without base spans in the sample nothing is added; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quench.llm.common import col, least_hashed, text_of

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
CONTEXT_CHARS = 60
SAMPLE, SAMPLE_CHARS, REGIONS = 1500, 20_000, 400
_SPACE = 1 << 15

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9][0-9 ().-]{2,}[0-9]|@")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, sorted."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:  # the local part is the run of its characters before an at-sign, the domain follows it
        s = at
        while s > end and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Token spans around each trigger (digit groups, at-signs), merged where they meet."""
    found: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        s, e = max(0, m.start() - CONTEXT_CHARS), min(len(text), m.end() + CONTEXT_CHARS)
        if found and s <= found[-1][1]:
            found[-1][1] = e
        else:
            found.append([s, e])
    return [[t.span() for t in _TOKEN.finditer(text, s, e)] for s, e in found]


def _hash(*parts) -> int:
    return zlib.crc32(repr(parts).encode()) % _SPACE


def _shape(s: str) -> str:
    return re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", re.sub(r"\s+", " ", s)))


def segments(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, list[int], list[int]]]:
    """Candidate segments (first token, end token, kinds, features) of a region."""
    out = []
    words = [text[s:e] for s, e in tokens]
    for i, first in enumerate(words):
        if not (first[0].isalnum() or first[0] in "+(") or not first[0].isascii():
            continue
        if i and first.isalnum() and words[i - 1].isalnum():
            continue
        digits, has_at, limit = 0, False, min(len(words), i + MAX_TOKENS)
        for j in range(i, limit):
            w = words[j]
            if not w.isascii() or (w.isspace() and w != " "):
                break
            digits += len(w) if w.isdigit() else 0
            has_at = has_at or w == "@"
            if not w.isalnum() or not (digits >= 4 or has_at) or (j + 1 < len(words) and words[j + 1].isalnum() and words[j + 1].isascii()):
                continue
            span = text[tokens[i][0]:tokens[j][1]]
            letters = any(c.isalpha() for c in span)
            kinds = ([0] if has_at and " " not in span else []) + ([] if letters or has_at else [1, 2, 3])
            if not kinds:
                continue
            d, shape = _digits(span), _shape(span)
            before = words[i - 1] if i else ""
            after = words[j + 1] if j + 1 < len(words) else ""
            values = [p for p in re.split("[^0-9]+", span) if p]
            features = [_hash("shape", shape if len(shape) < 24 else "long"), _hash("digits", len(d)), _hash("groups", len(values)),
                        _hash("first", first[0] if not first[0].isalnum() else shape[0]), _hash("signs", "".join(sorted(set(re.sub("[a9]", "", shape))))),
                        _hash("luhn", 12 <= len(d) <= 19 and luhn(d)), _hash("range", len(values) == 4 and all(len(v) < 4 and int(v) < 256 for v in values)),
                        _hash("tokens", min(j - i + 1, 12)), _hash("before", _shape(before)[:1]), _hash("after", _shape(after)[:1]),
                        _hash("left", words[i - 2].lower() if i > 1 and before == " " else ""), _hash("domain", "@" in span and "." in span.split("@")[-1])]
            out.append((i, j + 1, kinds, features))
    return out


def _scores(cands, weights: np.ndarray) -> list[tuple[int, int, int, float]]:
    return [(i, j, k, float(weights[k, f].sum())) for i, j, kinds, f in cands for k in kinds]


def viterbi(n: int, scored: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """The best segmentation: (first token, end token, kind) of its entity segments; other tokens score 0."""
    ending: dict[int, list] = {}
    for i, j, k, s in scored:
        ending.setdefault(j, []).append((i, k, s))
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, k, s in ending.get(j, ()):
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, k)
    out, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, k = back[j]
            out.append((i, j, k))
            j = i
    return out[::-1]


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(n: int, scored: list[tuple[int, int, int, float]]) -> list[float]:
    """Posterior probability of each scored segment (forward-backward)."""
    ending, starting = {}, {}
    for x in scored:
        ending.setdefault(x[1], []).append(x)
        starting.setdefault(x[0], []).append(x)
    a, b = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        a[j] = a[j - 1]
        for i, _, _, s in ending.get(j, ()):
            a[j] = _log_add(a[j], a[i] + s)
    for i in range(n - 1, -1, -1):
        b[i] = b[i + 1]
        for _, j, _, s in starting.get(i, ()):
            b[i] = _log_add(b[i], s + b[j])
    return [math.exp(min(0.0, a[i] + s + b[j] - a[n])) for i, j, _, s in scored]


def fit(texts: list[str], epochs: int = 12, rate: float = 0.5, ridge: float = 1e-4) -> np.ndarray | None:
    """Weights (kind, feature) that maximise the likelihood of the base spans; None without any."""
    data, spans = [], 0
    for text in texts:
        base = {(s, e, k) for s, k, e in base_spans(text)}
        for tokens in regions(text):
            cands = segments(text, tokens)
            gold = {(i, j, k) for i, j, kinds, _ in cands for k in kinds if (tokens[i][0], tokens[j - 1][1], k) in base}
            if cands and len(data) < REGIONS:
                data.append((len(tokens), cands, gold))
                spans += len(gold)
    if not spans:
        return None
    weights = np.full((len(KINDS), _SPACE), -0.05)
    square = np.full_like(weights, 1e-6)
    for _ in range(epochs):
        for n, cands, gold in data:
            scored = _scores(cands, weights)
            posterior, at = marginals(n, scored), 0
            for i, j, kinds, f in cands:
                for k in kinds:
                    step = ((i, j, k) in gold) - posterior[at]
                    at += 1
                    if abs(step) > 1e-4:
                        square[k, f] += step * step
                        weights[k, f] += rate * (step - ridge * weights[k, f]) / np.sqrt(square[k, f] + 1.0)
    return weights


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray | None:
    eligible = (docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
                .filter((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("@|[0-9][0-9 ().-]{2,}[0-9]")))
    return fit([r["text"] for r in least_hashed(eligible, "id", SAMPLE).collect()])


def spans_of(text: str, weights: np.ndarray | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans), each (start, kind, end) in order."""
    if not _TRIGGER.search(text):
        return base_spans(text), []
    base, added = base_spans(text), []
    if weights is None:
        return base, added
    taken = [(s, e) for s, _, e in base]
    for tokens in regions(text):
        for i, j, k in viterbi(len(tokens), _scores(segments(text, tokens), weights)):
            s, e = tokens[i][0], tokens[j - 1][1]
            if not any(a < e and s < b for a, b in taken):
                added.append((s, k, e))
    return base, added


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))


def scan(docs: DataFrame, weights: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, added``: arrays of (s, k, e): start, kind (index into ``KINDS``), end in code points."""
    source = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [spans_of(t.as_py(), weights) for t in b.column("text")]
            sides = [pa.array([[{"s": s, "k": k, "e": e} for s, k, e in f[side]] for f in found], _SPANS) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *sides], ["id", "base", "added"])

    return source.mapInArrow(run, T.StructType([source.schema["id"], *T._parse_datatype_string(
        "base array<struct<s:int,k:int,e:int>>, added array<struct<s:int,k:int,e:int>>")]))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def of_kind(column: str, kind: int) -> Column:
    return F.filter(column, lambda x: x["k"] == kind)
