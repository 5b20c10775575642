"""Plain-Python versions of the operators' contracts, for comparison on small tables."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def token_ids(texts, name):
    return [e.ids for e in tokenizer(name).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def decontaminate(docs, items):
    """(n_words, n_hit, sorted item ids) per text."""
    windows = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        w, hit, found = bench_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                items_of = windows.get(tuple(w[i:i + n]))
                if items_of is not None:
                    hit.update(range(i, i + n))
                    found |= items_of
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def normalise(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_components(ids, fps, radius=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    best = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None and (best.get(r) is None or x < best[r]):
            best[r] = x
        best.setdefault(r, None)
    return [best[find(i)] for i in range(len(ids))]


def held_out(doc_id, parts, remainder):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == remainder


def lm(rows, mu, add=0.1, order=2):
    """(n_tokens, n_known, N, base_score, score) per row, by direct recursion over an n-gram model."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + ["\n"] for _, t in rows]
    train = [["\n\n", *t] for (i, _), t in zip(rows, texts) if not held_out(i, 10, 0)]
    one = Counter(w for t in train for w in t[1:])
    n, v = sum(one.values()), len(one)
    seen = Counter(tuple(t[e - k:e]) for t in train for k in range(1, order + 1) for e in range(k, len(t) + 1))

    def p(h, w):
        if not h:
            return (one[w] + add) / (n + add * (v + 1))
        return (seen[*h, w] + mu * p(h[1:], w)) / (seen[h] + mu)

    out = []
    for t in texts:
        whole = ("\n\n", *t)
        score = sum(math.log10(p(whole[max(0, i + 1 - order):i], whole[i])) for i in range(1, len(whole)))
        out.append((len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(p((), w)) for w in t), score))
    return out


def listed(spans, names):
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def personal(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        d = [int(c) for c in reversed(s)]
        return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def secret(text):
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    return sorted([(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
                  + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
                  + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def article(page):
    body = page[page.index("<article>") + 9:page.index("</article>")].replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def line_dedup(rows, min_chars=20, min_docs=3):
    """(n_lines, n_dropped, kept text) per (doc_id, text) row."""
    space = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[lower(line.strip(space))].add(i)
    out = []
    for i, t in rows:
        lines, kept = (t or "").split("\n"), []
        for line in lines:
            key = lower(line.strip(space))
            ids = holders[key]
            top = max((x for x in ids if x is not None), default=None)
            if len(key) < min_chars or len(ids) < min_docs or i == top:
                kept.append(line)
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def kmeans(rows, k=40, rounds=5, dims=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid digest) per kept vector, in Python integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (sha(f"2:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [v for _, v in start[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, w)), c) for c, w in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (_, c) in zip(kept, assign()):
            members[c].append(v)
        for c, vs in members.items():
            centroids[c] = [sum(x) // len(vs) for x in zip(*vs)]
    found = assign()
    inertia = Counter()
    for d, c in found:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), sha(",".join(map(str, centroids[c])))) for (i, _), (d, c) in zip(kept, found)]


def damage(rows):
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = (" " if r is None else r), (" " if x is None else x)
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            out += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def cheapest_repair(faults, rows):
    """(cost, audit, repaired rows), by trying every edit from the end (memoised); rows are (role, text)."""
    done = {}

    def best(i, q, inserts):
        if (i, q, inserts) in done:
            return done[i, q, inserts]
        options, other = [], "assistant" if q == "u" else "user"
        if i == len(rows):
            options += [(0, "", ())] if q in ("", "a") else []
        else:
            (role, text), fault = rows[i], faults[i]
            cost, audit, kept = best(i + 1, q, 0)
            options.append((cost + 4, "D" + audit, kept))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                cost, audit, kept = best(i + 1, other[0], 0)
                options.append((cost + 3 + extra, "R" + audit, (f"{other}:{text}", *kept)))
                if role[:1] and q + role[:1] in ("s", "u", "su", "ua", "au"):
                    cost, audit, kept = best(i + 1, role[0], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *kept)))
        if inserts < 4:
            cost, audit, kept = best(i, other[0], inserts + 1)
            options.append((cost + 3, "I" + audit, (f"{other}:", *kept)))
        done[i, q, inserts] = min(options, default=(10 ** 9, "~", ()))
        return done[i, q, inserts]

    for i in range(len(rows), -1, -1):  # shallow recursion
        for q in ("", "s", "u", "a"):
            best(i, q, 0)
    return best(0, "", 0)


def conversations(all_ids, rows):
    """The digests of rows (conv, turn, role, text) after damage, one per id."""
    out = []
    for c in set(all_ids):
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in own:
            s = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not s else "duplicate" if (role, text) in seen else "truncated" if s[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, kept = cheapest_repair(faults, [r[2:] for r in own])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, sha("\n".join(kept))))
    return out
