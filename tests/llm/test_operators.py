"""Every operator against a plain version, on the awkward fixture, on given tables and on empty tables."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from quench.llm import decontaminate, exact_dedup, html_extract, lm_score, packing, pii, secrets, simhash_dedup, token_files, toxicity
from quench.llm.queries import QUERIES
from quench.session import scratch_path

from tests.llm import brute
from tests.llm.fixtures import BENCH, EXTRA, ROWS, benchmark, documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def _key(r):
    return tuple((x is None, x) if not isinstance(x, float) else (False, round(x, 6)) for x in r)


def same(got, want):
    assert sorted(map(_key, got)) == sorted(map(_key, want))


def test_packing_given(spark, given):
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    check_packing([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], r["sequence_id"], r["offset"]) for r in rows], given)


def test_packing_awkward(spark):
    packed = packing.pack(documents(spark), capacity=64)
    rows = [tuple(r) for r in packed.select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset").collect()]
    check_packing([(*r[:4], brute.crc(np.frombuffer(r[4], "<u4")), *r[5:]) for r in rows], [r[:2] for r in ROWS], 64)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert sum(len(x) for x in whole.values()) == 4 * sum(r[3] for r in rows)
    assert all(bytes(whole[s])[4 * o:4 * (o + n)] == bytes(ids) for _, _, _, n, ids, s, o in rows)


def check_packing(rows, docs, capacity=2048):
    want = []
    for (i, _), ids in zip(docs, brute.token_ids([t for _, t in docs], "word_bpe_49k.json")):
        ids = [*ids, 0]
        want += [(i, k, s, len(ids[s:s + capacity]), brute.crc(ids[s:s + capacity])) for k, s in enumerate(range(0, len(ids), capacity))]
    same([r[:5] for r in rows], want)
    bins = defaultdict(list)
    for r in rows:
        bins[r[5]].append((r[6], r[3]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r[3] for r in rows)
    assert len(bins) <= max(math.ceil(total / capacity * 1.01) + 1, sum(r[3] > capacity // 2 for r in rows) + 1)


def test_plan_equals_one_bin_at_a_time():
    counts = {7: 5, 6: 3, 5: 9, 3: 4, 1: 2, 10: 2}
    left, bins = dict(counts), []
    while any(left.values()):
        best = packing.fill(left, 12)
        bins.append(sum(n * c for n, c in best.items()))
        for n, c in best.items():
            left[n] -= c
    plan = packing.plan(counts, 12)
    assert [sum(n * c for n, c in combo.items()) for k, combo in plan for _ in range(k)] == bins
    used = Counter()
    for k, combo in plan:
        for n, c in combo.items():
            used[n] += k * c
    assert used == Counter(counts)


@pytest.mark.parametrize("counts", [{3: 1, 5: 2, 9: 1}, {2: 7, 9: 2, 4: 3}, {11: 1, 8: 2, 6: 2}, {1: 1}])
def test_fullest_is_the_best_subset(counts):
    import itertools

    sums = {sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])}
    got = packing.fullest(counts, 20)
    assert sum(n * c for n, c in got.items()) == max(s for s in sums if s <= 20)
    assert all(c <= counts[n] for n, c in got.items())


def test_decontamination_awkward(spark):
    rows = decontaminate.decontaminate(documents(spark), benchmark(spark)).collect()
    items = [("i1", BENCH), ("i2", "short quiz item"), (None, BENCH), ("i9", BENCH + " rho")]
    want = [(r[0], *w) for r, w in zip(ROWS, brute.decontaminate([r[1] for r in ROWS], items))]
    same([(r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows], [(*w[:3], tuple(w[3])) for w in want])


def test_winnowing_guarantee():
    rng = np.random.default_rng(5)
    g = rng.integers(0, 50, 400).astype(np.uint64)  # many ties
    at = decontaminate.winnow(g, 6)
    for i, p in enumerate(at):
        assert i <= p < i + 6 and g[p] == g[i:i + 6].min() and not (g[p + 1:i + 6] == g[p]).any()


def test_decontamination_drop(spark):
    kept = decontaminate.drop_contaminated(documents(spark), benchmark(spark))
    assert kept.columns == ["doc_id", "text", "lang", *EXTRA]
    assert {8, 9, 16, 17}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() == len(ROWS) - 4


def test_toxicity_distances_and_labels():
    """Distances are compressed lengths with either dictionary; equal texts are toxic if one label is; the order of rows is nothing."""
    import zstandard

    clean, bad = [f"some plain words number {i} are here" for i in range(60)], [f"grubba zonkel vexit {i} so it goes" for i in range(60)]
    texts, labels = [*clean, *bad, bad[0]], [0] * 60 + [1] * 60 + [0]
    a = toxicity.fit(texts, labels)
    b = toxicity.fit(texts[::-1], labels[::-1])
    assert a.toxic == b.toxic and a.ordinary == b.ordinary and (a.weights == b.weights).all()
    assert toxicity.fit(["x", "x"], [1, 0]) is None and toxicity.fit(["x", "x"], [0, 1]) is None
    distance = toxicity.Distance(a.ordinary, a.toxic)
    size = []
    for raw in (a.ordinary, a.ordinary + a.toxic):
        dictionary = zstandard.ZstdCompressionDict(raw + toxicity._PAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        size.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=toxicity.PARAMETERS))
    for w in (b"zonkel", b"plain", b"", b"x" * 48):
        data = toxicity._PAD + b" " + w + b" " + toxicity._PAD
        one, two = (len(c.compress(data)) for c in size)
        assert distance.of(w) == one - two
    text = "plain zonkel here"
    d = sorted([0, 0, 0, *(distance.of(w) for w in toxicity.windows(text))])[-3:]
    assert distance.features(text)[:3] == d and distance.features(text)[-1] == pytest.approx(math.log(4))


def test_toxicity_learns_and_scores(spark):
    rng = np.random.default_rng(1)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]

    def prose(n):
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))

    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = prose(60).split(" ")
        if toxic:
            for w in ("zagblot", "quimpfy", "zagblot"):
                words.insert(int(rng.integers(0, len(words))), w)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    docs = documents(spark, rows + [(None, None, None), (5000, "", None)])
    marks = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    scored = {r["id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(scored) == 902 and all(0 <= s <= 1 for s in scored.values()) and scored[5000] < 0.5
    held = [i for i in range(900) if brute.held_out(i, 3, 1)]
    right = sum((scored[i] >= 0.7) == (i % 5 == 0) for i in held)
    assert right / len(held) > 0.97
    kept = toxicity.drop_toxic(docs, docs, marks)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} >= {None, 5000}


def test_toxicity_without_both_classes(spark):
    docs = documents(spark)
    marks = spark.createDataFrame([(1, 0), (5, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs, marks) is None
    assert [r["score"] for r in toxicity.score(docs, None).collect()] == [0.0] * len(ROWS)


def test_toxicity_given_held_out(spark):
    """On the given labels, held-out documents of either class must rank apart."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = [i for i, in labels.select("doc_id").collect() if brute.held_out(i, 3, 1)]
    rows = (toxicity.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), toxicity.train(docs, labels)).withColumnRenamed("id", "doc_id")
            .join(labels, "doc_id").select("doc_id", "score", "toxic").collect())
    rows = [r for r in rows if r["doc_id"] in set(held)]
    predicted = [r["toxic"] for r in rows if r["score"] >= 0.7]
    assert sum(predicted) >= 0.95 * len(predicted) and sum(predicted) >= 0.4 * sum(r["toxic"] for r in rows)


def test_toxicity_every_language():
    """Signals that one language holds, and that ordinary text also has now and then, are learnt."""
    docs, labels = (pq.read_table(f"/root/testdata/sf0.1/{t}.parquet").to_pylist() for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels if r["toxic"] is not None}
    rows = [(r["text"] or "", toxic[r["doc_id"]], r["lang"], brute.held_out(r["doc_id"], 3, 1)) for r in docs if r["doc_id"] in toxic]
    train = [r for r in rows if not r[3] and len(r[0]) <= toxicity.SAMPLE_CHARS]
    model = toxicity.fit([r[0] for r in train], [r[1] for r in train])
    distance = toxicity.Distance(model.ordinary, model.toxic)
    held = [r for r in rows if r[3]]
    found = model.probability(np.array([distance.features(r[0]) for r in held])) >= toxicity.THRESHOLD
    assert np.mean([r[1] for r, hit in zip(held, found) if hit]) >= 0.95
    for lang in ("en", "de", "fr", "es"):
        recall = np.mean([hit for r, hit in zip(held, found) if r[2] == lang and r[1]])
        assert recall >= 0.6, (lang, recall)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))


def check_tokens(rows, docs):
    docs = ordered(docs)
    want, at = [], 0
    for (i, _), ids in zip(docs, brute.token_ids([t for _, t in docs], "byte_bpe_50k.json")):
        ids = [*ids, 2]
        want.append((i, at, len(ids), brute.crc(ids)))
        at += len(ids)
    same(rows, want)


def test_token_files_given(spark, given):
    check_tokens([tuple(r) for r in QUERIES["op4_token_files"](spark, SF).collect()], given)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_awkward(spark, encoding):
    rows = [r for r in ROWS if r[0] != 10] + [ROWS[9]]
    path = scratch_path(spark, "tokens-test")
    token_files.write_tokens(documents(spark, rows), path, encoding=encoding, row_group_bytes=1 << 20, page_bytes=4096)
    check_tokens([tuple(r) for r in token_files.crc32_of_ids(token_files.read_tokens(spark, path)).collect()], [r[:2] for r in rows])
    meta = token_files.read_metadata(spark, path)
    assert "ids" not in meta.columns and meta.count() == len(rows)
    some = token_files.read_tokens(spark, path, "doc_id = 7").collect()
    assert len(some) == 1 and list(some[0]["ids"])[-1] == token_files.END
    import glob

    import pyarrow.parquet as pq

    columns = [pq.ParquetFile(f).metadata.row_group(0).column(4) for f in glob.glob(f"{path}/*.parquet") if pq.ParquetFile(f).metadata.num_row_groups]
    assert columns and all(c.path_in_schema.startswith("ids") and c.has_offset_index for c in columns)
    assert any(("DELTA_BINARY_PACKED" in c.encodings) == (encoding == "delta") for c in columns)


def test_exact_dedup_awkward(spark):
    rows = exact_dedup.exact_groups(documents(spark), digest=True).collect()
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[brute.normalise(t)].append(i)
    want = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), brute.sha(t)) for i in ids]
    same([(r["id"], r["keep_id"], r["group_size"], r["sha256"]) for r in rows], want)
    assert Counter(r["sha256"] for r in rows if r["kept"]) == Counter({brute.sha(t): 1 for t in groups})
    kept = exact_dedup.drop_exact_copies(documents(spark))
    assert kept.columns == ["doc_id", "text", "lang", *EXTRA] and kept.count() == len(groups)


def test_exact_dedup_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", -1)
    assert exact_dedup.drop_exact_copies(documents(spark)).count() == len({brute.normalise(r[1]) for r in ROWS})


@pytest.mark.parametrize("text", [r[1] for r in ROWS] + ["a b", "A  B\tc d", "x" * 5000, ""])
def test_simhash_fingerprint(text):
    assert simhash_dedup.fingerprint(text or "") == brute.simhash(text)


def test_simhash_given(spark, given):
    rows = QUERIES["op10_simhash_near_dedup"](spark, SF).collect()
    fps = [brute.simhash(t) for _, t in given]
    same([tuple(r) for r in rows], [(i, f"{f:016x}", c) for (i, _), f, c in zip(given, fps, brute.near_components([i for i, _ in given], fps))])


def test_simhash_links_are_whole(spark):
    """Chains and dense clusters of planted fingerprints, cut into many small tiles."""
    rng = np.random.default_rng(3)
    fps = {0}
    for _ in range(30):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(12):  # a chain of two-bit steps
            x ^= (1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))
            fps.add(x)
    centre = int(rng.integers(0, 1 << 63))
    fps |= {centre ^ (1 << i) ^ (1 << j) for i in range(16) for j in range(16)}
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    found = {r["node"]: r["root"] for r in simhash_dedup.components(simhash_dedup.links(nodes, tile=16)).collect()}
    want = brute.near_components(signed, fps)
    assert [found.get(f, f) for f in signed] == want


def test_simhash_awkward(spark):
    rows = simhash_dedup.near_groups(documents(spark)).collect()
    fps = [brute.simhash(r[1]) for r in ROWS]
    same([(r["id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in rows],
         [(r[0], f"{f:016x}", c) for r, f, c in zip(ROWS, fps, brute.near_components([r[0] for r in ROWS], fps))])
    kept = simhash_dedup.drop_near_copies(documents(spark))
    assert kept.columns == ["doc_id", "text", "lang", *EXTRA] and kept.count() == sum(r["first"] for r in rows)


def check_spans(rows, docs, find, names, fields):
    want, extra = [], 0
    by_text = {}
    for i, t in docs:
        base = find(t or "")
        by_text[i] = set(brute.listed(base, names).split(",")) - {""}
        want.append((i, *[sum(k == x for _, k, _ in base) for x in range(len(fields))], brute.sha(brute.listed(base, names))))
    same([(r["doc_id"], *[r[f] for f in fields], r["base_sha256"]) for r in rows], want)
    for r in rows:
        spans = set(r["spans"].split(",")) - {""}
        assert by_text[r["doc_id"]] <= spans
        extra += len(spans - by_text[r["doc_id"]])
    return extra


def test_personal_data_given(spark, given):
    rows = QUERIES["op6_personal_data"](spark, SF).collect()
    check_spans(rows, given, brute.personal, pii.KINDS, ["n_email", "n_ip", "n_card", "n_phone"])


def test_personal_data_awkward(spark):
    found = pii.scan(documents(spark), None).collect()
    same([(r["id"], tuple(map(tuple, r["base"]))) for r in found], [(r[0], tuple(brute.personal(r[1] or ""))) for r in ROWS])


def test_personal_rules_fuzz():
    rng = np.random.default_rng(8)
    letters = list("0123456789012345..--@@++ ()ab%_é")
    for _ in range(3000):
        t = "".join(rng.choice(letters, rng.integers(0, 50)))
        assert pii.base_spans(t) == brute.personal(t)


def test_semi_markov_inference_is_exact():
    """Viterbi and marginals against all segmentations of a short region."""
    rng = np.random.default_rng(2)
    n = 6
    scored = [(i, j, k, float(rng.normal())) for i in range(n) for j in range(i + 1, min(n, i + 3) + 1) for k in (0, 1)]

    def paths(at):
        if at == n:
            yield []
            return
        for rest in paths(at + 1):
            yield rest
        for x, (i, j, _, _) in enumerate(scored):
            if i == at:
                for rest in paths(j):
                    yield [x, *rest]

    every = list(paths(0))
    value = [sum(scored[x][3] for x in p) for p in every]
    best = every[int(np.argmax(value))]
    assert pii.viterbi(n, scored) == [scored[x][:3] for x in best]
    z = np.logaddexp.reduce(value)
    for x, m in enumerate(pii.marginals(n, scored)):
        assert math.isclose(m, sum(math.exp(v - z) for v, p in zip(value, every) if x in p), rel_tol=1e-9)


def test_personal_field_finds_what_it_learnt():
    rng = np.random.default_rng(4)

    def phone():
        return f"+1 ({rng.integers(100, 999)}) 555-{rng.integers(1000, 9999)}"

    texts = [f"some words here {phone()} and 17 more or 2019 and {rng.integers(1, 255)}.{rng.integers(1, 255)}.3.4 end" for _ in range(120)]
    weights = pii.fit(texts[:80])
    found = wanted = right = 0
    for t in texts[80:]:
        base = set(pii.base_spans(t))
        got = {(tok[i][0], k, tok[j - 1][1]) for tok in pii.regions(t) for i, j, k in pii.viterbi(len(tok), pii._scores(pii.segments(t, tok), weights))}
        found, wanted, right = found + len(got), wanted + len(base), right + len(got & base)
    assert right >= 0.95 * wanted and right >= 0.95 * found
    _, added = pii.spans_of("ring +1 (555) 555-1234 10.1.2.3 today", weights)  # the rule's match runs on and fails
    assert any(k == 3 for _, k, _ in added)


def test_secrets_given(spark, given):
    rows = QUERIES["op7_secret_scan"](spark, SF).collect()
    check_spans(rows, given, brute.secret, secrets.KINDS, ["n_assign", "n_access", "n_hex"])


def test_secrets_awkward(spark):
    rows = documents(spark).unionByName(documents(spark, [
        (30, "Secret='abc123/+=.x' api_key:zzzzzz APIKEY = \"qqqqqqq\" token=token:abcdefgh xx deadbeefdeadbeefdeadbeefaa", "en"),
        (31, "é " * 50 + "key xK9qL2vB7nM4pR8tW3zY6cF1 thisisalongordinaryword version2name", "en")]))
    docs = [r[:2] for r in ROWS] + [tuple(r)[:2] for r in rows.filter("doc_id >= 30").collect()]
    assert len(secrets.train(rows)) == 128 * 128
    model = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = secrets.scan(rows, model).collect()
    want = [(i, tuple(brute.secret(t or ""))) for i, t in docs]
    same([(r["id"], tuple(sorted((x["s"], k, x["e"]) for k, name in enumerate(secrets.KINDS[:3]) for x in r[name]))) for r in found], want)
    added = {r["id"]: [x["v"] for x in r["random"]] for r in found if r["random"]}
    assert added == {31: ["xK9qL2vB7nM4pR8tW3zY6cF1"]}


def test_secrets_of_letters_alone(spark):
    """Random letters reach the models and are added, ordinary names of many forms are not."""
    random = ["xKqLvBnMpRtWzYcFjHgD", "QxzvKWpJrTbLmGhN", "zqxjvkwpbmtrlnhg"]
    names = ["thisisalongordinaryword", "internationalization", "src/main/java/org/apache", "configuration_manager_factory",
             "HttpServletRequestWrapper", "very-long-hyphenated-name", "================", "2024-11-30-12-45-59"]
    rows = spark.createDataFrame([(i, f"see {v}, end") for i, v in enumerate(random + names)], "doc_id bigint, text string")
    found = secrets.scan(rows, secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).collect()
    assert {x["v"] for r in found for x in r["random"]} == set(random)


@pytest.mark.parametrize("n", [0, 1, 254, 255, 256, 257, 513, 20_000])
def test_secrets_many_matches(spark, n):
    """Places across the chunks of the fold equal the plain rules."""
    text = "é" + "".join(f"x{i} password={i:06x}{'' if i % 3 else ' AKIA' + 'Q' * 16} é " for i in range(n))
    (r,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), [0.0] * 128 * 128).collect()
    assert sorted((x["s"], k, x["e"]) for k, name in enumerate(secrets.KINDS[:3]) for x in r[name]) == brute.secret(text)


def test_html_given(spark):
    rows = QUERIES["op8_html_extraction"](spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == brute.article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_html_awkward():
    page = ("<html><head><title>t</title><style>p{}</style></head><body><header>Top</header><nav><a href=x>Home</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><header><h1>A &amp; B</h1></header><p>One<br>two &nbsp; <b>three</b><p>Four"
            "<script>var t='</p>';</script><aside>side</aside><form>f</form><ul><li>x<li>y</ul><span class=ad>buy</span> tail"
            "<section id=comments><p>nice!</p></section></article><footer>&copy;</footer>")
    assert html_extract.extract_group([page])[0] == "A & B\nOne two three\nFour\nx\ny\ntail"
    assert html_extract.extract_group(["", "no markup < at > all", "<p>a<!-- c --", "<script>x"]) == ["", "no markup < at > all", "a", ""]


def test_html_deep_nesting():
    """No recursion and no quadratic scan, whatever the depth and the unmatched end tags."""
    n = 100_000
    assert html_extract.extract_group(["<article>" + "<div>" * n + "deep text" + "</div>" * n + "</article>"]) == ["deep text"]
    assert html_extract.extract_group(["<nav>" + "<div>" * n + "</span></section>" * n + "menu"]) == [""]


@pytest.mark.parametrize("inner", ['<div class="comment">', '<div id="comments-section">', '<div id="sidebar">', '<div class="cookie-bar">',
                                   '<div class="x post-comments">', '<ul class="social-share">'])
def test_html_furniture_in_articles(inner):
    tag = inner[1:].split()[0]
    assert html_extract.extract_group([f"<article><p>Own text.</p>{inner}<p>not text</p></{tag}><p>More.</p></article>"]) == ["Own text.\nMore."]


@pytest.mark.parametrize("page,want", [
    ('<div class="entry-header"><h1>Title</h1></div><p>Text.</p><div class="site-header">Site</div>', "Title\nText."),
    ('<div class="related-work"><p>Work</p></div><div class="related-posts">Posts</div>', "Work"),
    ('<section class="search-results"><p>Found</p></section><div class="search-box">Find</div>', "Found"),
    ('<div class="no-sidebar"><p>Text.</p><div id="left-sidebar">Side</div><div class="topMenu">Menu</div></div>', "Text."),
])
def test_html_names_without_article(page, want):
    assert html_extract.extract_group([f"<body>{page}</body>"]) == [want]


@pytest.mark.parametrize("page,want", [
    ('<article><h1>T</h1><h2 id="related-work">Related work</h2><p>a</p></article>', "T\nRelated work\na"),
    ('<main><section id="search-engines"><h2 id="comments">Engines</h2><p>a</p></section></main>', "Engines\na"),
    ('<article><div class="article-header"><h1>T</h1></div><p>a <span class="token comment"># b</span></p></article>', "T\na # b"),
    ('<body><div class="no-sidebar"><nav>n</nav><article><h1>T</h1><p>a</p></article></div>', "T\na"),
    ('<div class="sidebar"><article><p>a</p></article></div>', "a"),
    ('<form id="aspnetForm"><div id="header-wrap">x<main><p>a</p><form>f</form></main></div></form>', "a"),
    ('<article><p>a</p><div class="share">s</div><span class="ad">buy</span></article><div class="related"><article>teaser</article></div>', "a"),
])
def test_html_names_inside_articles(page, want):
    assert html_extract.extract_group([page]) == [want]


def test_html_unmarked_boilerplate():
    """Pages without an article element: runs that most pages of the host share go, unique runs stay."""
    top = "<div>Welcome to the best site of all for news and more news every day</div>"
    pages = [f"<body>{top}<div>page {i} says something of its own number {i * i} here</div><div>All rights reserved by the owners of this site since long ago</div>" for i in range(8)]
    assert html_extract.extract_group(pages) == [f"page {i} says something of its own number {i * i} here" for i in range(8)]
    assert html_extract.extract_group(pages[:2]) != [f"page {i} says something of its own number {i * i} here" for i in range(2)]


def test_html_unmarked_boilerplate_in_articles():
    """A line that nearly every article of the host has goes; a passage that a third share, and copies of one article, stay."""
    line = "Sign up now to get all of our stories by mail every single morning"
    passage = "This passage of eight words or more is quoted by some of the articles"
    own = [" ".join(f"word{i}x{k}" for k in range(40)) for i in range(30)]
    pages = [f"<article><h1>Title {i}</h1><p>{own[i]}</p><p>{line}</p>{f'<p>{passage}</p>' if i % 3 == 0 else ''}</article>" for i in range(30)]
    assert html_extract.extract_group(pages) == [f"Title {i}\n{own[i]}" + (f"\n{passage}" if i % 3 == 0 else "") for i in range(30)]
    copies = [f"<article><h1>Title {i}</h1><p>{own[0]}</p></article>" for i in range(30)]
    assert html_extract.extract_group(copies) == [f"Title {i}\n{own[0]}" for i in range(30)]


def test_suffix_ranks():
    rng = np.random.default_rng(6)
    tokens = rng.integers(0, 3, 300)
    for depth in (1, 2, 5, 8):
        rank = html_extract.suffix_ranks(tokens, depth)
        prefix = [tuple(tokens[i:i + depth]) for i in range(len(tokens))]
        order = sorted(set(prefix))
        assert [order.index(p) for p in prefix] == list(rank)


@pytest.mark.parametrize("block_bytes,entries", [(1 << 22, 2_000_000), (300, 40)])
def test_lm_awkward(spark, block_bytes, entries):
    rows = lm_score.lm_scores(documents(spark), mu=3.0, block_bytes=block_bytes, bucket_entries=entries).collect()
    docs = [r[:2] for r in ROWS]
    want = [(i, brute.held_out(i, 10, 0), *x) for (i, _), x in zip(docs, brute.lm(docs, 3.0))]
    same([tuple(r) for r in rows], want)


def test_lm_given(spark, given):
    rows = QUERIES["op9_lm_scores"](spark, SF).collect()
    want = [(i, brute.held_out(i, 10, 0), *x) for (i, _), x in zip(given, brute.lm(given, lm_score.MU))]
    same([tuple(r) for r in rows], want)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("order,lane", [(1, 256), (2, 1), (3, 1), (3, 256), (4, 2), (4, 5)])
def test_lm_orders_and_lanes(spark, order, lane):
    """Every order against brute force, texts longer than a lane included; held-out texts follow failure arcs of every depth."""
    rng = np.random.default_rng(order)
    docs = [(i, " ".join(rng.choice(list("abcd"), rng.integers(0, 30)))) for i in range(60)]
    docs += [(60 + i, "a b c d x" + " a b c a" * i + f" only{i}") for i in range(20)] + [(3, None), (3, "a b")]
    rows = lm_score.lm_scores(documents(spark, [(*d, "x") for d in docs]), order=order, mu=2.0, lane=lane, block_bytes=400, bucket_entries=100).collect()
    same([tuple(r) for r in rows], [(i, brute.held_out(i, 10, 0), *x) for (i, _), x in zip(docs, brute.lm(docs, 2.0, order=order))])


def test_encoder_units():
    """Texts cut into units and a cache that overflows give the library's ids, white space and odd characters anywhere."""
    import random

    import public_tokenizers

    from quench.llm.tokens import Encoder

    rng = random.Random(5)
    bits = ["a", "B", "é", "İ", "ß", " ", " ", " ", "\n", "\t", "\u00a0", "\u3000", "\u0308", "'s", "'", "1", "23", ".", ",", "--", "日", "\U0001f600", "\r", "\x1c",
            "\x85", "\u200b", "foo", "the", "don't", "<|endoftext|>", "\u01c4", "\ufb01", "\x00", "\u212a"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(4000)]
    for kind, name in (("byte", "byte_bpe_50k.json"), ("word", "word_bpe_49k.json")):
        ours = Encoder(public_tokenizers.path(name), kind, units=500)
        for t in texts:
            assert ours.encode(t) == np.array(ours.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_encoder_looks_a_unit_up_once():
    """A new unit is encoded by its lookup, with no pass before it that gathers what is new; a full cache starts anew."""
    import public_tokenizers

    from quench.llm.tokens import Encoder

    ours = Encoder(public_tokenizers.path("byte_bpe_50k.json"), "byte", units=3, pieces=2)

    def ids(text):
        return np.array(ours.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    for part in ["hello", "don't", "\nnaïve", "İx,", "", "a\x00b", "hello", "zweiundzwanzig9"]:
        assert ours.units[part] == ids(part if part[:1] == "\n" else " " + part)
        assert len(ours.units) <= 4 and len(ours.pieces) <= 2


def test_lm_higher_order_is_a_distribution(spark):
    """Order 3: probabilities of every continuation of a context sum to one (unseen words share the rest)."""
    docs = documents(spark, [(i, "a b c a b d a b c b a", "x") for i in range(6)])
    scores = lm_score.lm_scores(docs, order=3, mu=2.0).collect()
    assert len(scores) == 6 and all(r["score"] < 0 for r in scores) and len({round(r["score"], 9) for r in scores}) == 1


def test_empty_tables(spark):
    none, items = documents(spark, []), benchmark(spark, [])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert packing.pack(none).count() == 0
    assert decontaminate.decontaminate(none, items).count() == 0
    assert decontaminate.decontaminate(documents(spark), items).filter("n_hit > 0").count() == 0
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0
    path = scratch_path(spark, "tokens-none")
    token_files.write_tokens(none, path)
    assert token_files.read_tokens(spark, path).count() == 0
    assert exact_dedup.exact_groups(none).count() == 0
    assert pii.scan(none, pii.train(none)).count() == 0
    assert secrets.scan(none, secrets.train(none)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(pages).count() == 0
    assert lm_score.lm_scores(none).count() == 0
    assert simhash_dedup.near_groups(none).count() == 0


def test_pages_awkward(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (2, "http://A.example/x", "", 2), (None, "//b/", "<p>x</p>", 3)],
                                  "page_id long, url string, html string, text int")
    same([tuple(r) for r in html_extract.extract(pages).collect()], [(1, None, ""), (1, None, ""), (2, "http://A.example/x", ""), (None, "//b/", "x")])
