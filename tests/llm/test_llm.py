"""Operators of the document pipeline: brute force, round trips, held-out accuracy, edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF01, SF001
from tests.conftest import spark  # noqa: F401
from tickbook.llm import chat, decontam, dedup, html, lm, packing, quality, queries, rules, toxicity, urls
from tickbook.llm import text as T

ODD = ["", "   \n\t ", "a", None, "Same text here with words " * 8, "Same text here with words " * 8, "é" * 5000,
       ("long words " * 3 + "x" * 50 + " ") * 4000, "ÀB ß\x00\x0b\x85 z", "w" * (T.BLOCK + 10) + " tail"]


def odd_docs(spark):
    rows = [(i, t, "en", "s", 1, "clash", True) for i, t in enumerate(ODD)]
    rows += [(None, "null id text of some words", None, None, None, None, None), rows[4], (4, "same id, other text", None, "s", 2, "", False)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "component_id string, _kept boolean")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    T.prepare(spark)
    return spark.read.parquet(f"{SF001}/documents.parquet")


def words(t):
    return (t or "").encode().lower().split()


def test_word_hashes_do_not_depend_on_blocks():
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choices("ab \n\té", k=rng.randint(0, 40))).encode()
        w = T.word_hashes(t)
        assert len(w) == len(t.split())
        assert [int(x) for x in w] == [int(T.word_hashes(p)[0]) for p in t.split()]
    long = b"ab cd " * (T.BLOCK // 3)
    assert len(T.word_hashes(long)) == len(long.split()) and len(np.unique(T.word_hashes(long))) == 2


# --- packing

def test_tokenizer_cache_is_exact():
    rng = random.Random(2)
    tok = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), cache_words=500)
    alphabet = list("ab'.,sStTΣÉé×÷ß<|> 12²́ \n-ñ") + ["<|endoftext|>", "don't", "naïve"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)] + [x for x in ODD[:8] if x]
    got = tok.encode([t.encode() for t in texts])
    for t, g in zip(texts, got, strict=True):
        assert g.tolist() == tok.tok.encode(t, add_special_tokens=False).ids, t


def check_packed(rows, capacity=2048):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing_round_trip_and_count(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(docs, path).collect()
    tok = packing.WordTokenizer(path).tok
    want = {}
    for r in docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[(r.doc_id, k)] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    n = check_packed(rows)
    lengths = sorted((r.length for r in rows), reverse=True)
    bins = []
    for x in lengths:       # best fit decreasing, document by document
        fit = min((b for b in bins if b >= x), default=None)
        if fit is None:
            bins.append(2048 - x)
        else:
            bins.remove(fit)
            bins.append(fit - x)
    assert n == len(bins)


def test_plan_takes_every_rank_once():
    rng = random.Random(3)
    for _ in range(200):
        cap = rng.choice([1, 7, 30, 100])
        hist = {rng.randint(1, cap): rng.randint(0, 40) for _ in range(rng.randint(0, 12))}
        used, seen = collections.defaultdict(list), collections.Counter()
        for n, r0, ranks, seq0, per, room in packing.plan(hist, cap):
            for k in range(ranks):
                used[seq0 + k // per].append((cap - room + (k % per) * n, n))
                seen[(n, r0 + k)] += 1
        assert seen == collections.Counter({(n, k): 1 for n, c in hist.items() for k in range(c)})
        for parts in used.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= cap


# --- near duplicates

def shingle_set(t, k):
    w = words(t)
    if 0 < len(w) < k:
        return {tuple(w)}
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute_components(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            n = len(x & y)
            if n and 100 * n >= percent * len(x | y):
                p, q = sorted((root(ids[a]), root(ids[b])))
                comp[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _g in range(6):        # drifting copies: many pairs close to the threshold
        base = rng.choices(vocabulary, k=rng.choice([3, 6, 30, 150]))
        for _c in range(45):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 18))):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    rows += [(len(rows), "W1 w2\tw3 w4 w5"), (len(rows) + 1, "w1 W2 w3\nw4 w5"), (len(rows) + 2, ""), (len(rows) + 3, "")]
    for k in (4, 5):
        got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=k).collect()
        want = brute_components(rows, k, 80)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark):
    got = dedup.near_duplicates(odd_docs(spark), words=4).collect()
    assert len(got) == len(ODD) + 3
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[None][0].kept and by[None][0].component_id is None
    assert by[5][0].component_id == 4 and not by[5][0].kept
    assert all(by[i][0].n_shingles == 0 and by[i][0].kept for i in (0, 1, 3))
    assert dedup.near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_densified_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    edges, probes = dedup._tables(512)
    for n in (6, 40, 400, 4000):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2))[:int(n * 1.25)]
        a, b = pool[:n], pool[int(n * 0.25):]
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est = (dedup.signature(np.sort(a), edges, probes) == dedup.signature(np.sort(b), edges, probes)).mean()
        assert abs(est - j) < 0.2


# --- decontamination

def brute_scan(text, items, window=13):
    def spell(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, names = spell(text), set(), set()
    for name, t in items:
        v = spell(t)
        k = min(window, len(v))
        pats = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in pats:
                hit.update(range(i, i + k))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("pass_bytes", [1 << 22, 300])
def test_contamination_against_brute_force(spark, pass_bytes):
    rng = random.Random(6)
    voc = ["ab", "abc", "b", "é1", "xyz", "Q"]
    items = [(i, " ".join(rng.choices(voc, k=rng.choice([1, 2, 5, 13, 14, 30])))) for i in range(25)]
    items += [(98, None), (99, " .!? "), (3, items[3][1])]
    rows = []
    for i in range(120):
        t = rng.choices(voc, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            s = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(t))
            t[at:at] = s[rng.randint(0, 2):]
        rows.append((i, rng.choice([" ", "-", "\n"]).join(t)))
    rows += [(200, None), (201, ""), (5, rows[5][1]), (None, rows[6][1])]
    got = decontam.contamination(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                 spark.createDataFrame(items, "item_id bigint, text string"), pass_bytes=pass_bytes).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        n, hit, names = brute_scan(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, hit, names)
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        assert sum(s.last - s.first + 1 for s in r.spans) >= hit


def test_contamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    got = decontam.contamination(odd_docs(spark), bench).collect()
    assert len(got) == len(ODD) + 3 and any(r.contaminated for r in got if r.doc_id == 2)
    assert decontam.contamination(odd_docs(spark), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(odd_docs(spark).limit(0), bench).count() == 0


# --- quality, rules, toxicity

def test_quality_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op1_quality_classifier(spark, SF01).collect()}
    lab = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    held = [(got[i].predicted, y) for i, y in lab.items() if i in got and got[i].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())


def test_quality_odd_rows(spark):
    lab = labels(spark, [(4, 1, 0), (2, 0, 1), (2, 0, 1), (None, 1, 0), (7, None, None), (999, 1, 1)])
    got = quality.classify(odd_docs(spark), lab)
    assert got.where("_score BETWEEN 0 AND 1").count() == len(ODD) + 3 and "component_id" in got.columns
    assert quality.classify(odd_docs(spark), labels(spark)).where("_score = 0.5").count() == len(ODD) + 3
    assert quality.classify(odd_docs(spark).limit(0), lab).count() == 0


def test_labelled_sample_fills_its_bounds(spark):
    docs = spark.createDataFrame([(i, ("good words of a long text " if i % 2 else "buy now !!! $$$ click ") * 300) for i in range(60)],
                                 "doc_id bigint, text string")
    lab = labels(spark, [(i, i % 2, 0) for i in range(4000)])       # most are not there
    got = T.labelled_sample(docs, lab, "quality", 25).collect()
    assert collections.Counter(r.y for r in got) == {0: 25, 1: 25} and {r.doc_id for r in got} <= set(range(60))
    model = quality.fit(docs, lab, class_bytes=3000)                # every text is longer
    assert 500 < len(model.good) <= 3000 and len(model.bad) > 500 and model.slope != 0
    long = docs.union(spark.createDataFrame([(i, f"one word of {i} " * 40000) for i in range(60, 70)], docs.schema))
    assert quality.classify(long, lab, threshold=0.5).where("doc_id < 60 AND _predicted = doc_id % 2").count() == 60
    for lengths, limit in (([], 5), ([0, 3, 9, 9], 15), ([5, 5], 100), ([7] * 10, 30), ([1 << 40, 2], 1000)):
        c = quality.share(lengths, limit)
        assert sum(min(n, c) for n in lengths) <= limit
        assert c == max(lengths, default=0) or sum(min(n, c + 1) for n in lengths) > limit
    assert len(quality.pieces(b"x" * 10000, 4096)) == 4096 and quality.pieces(b"abc", 2) == b"ab"


def test_rule_counts_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + list(enumerate(x for x in ODD[:7]))
    for _, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        c = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        assert rules.counts(t.encode())[:5] == (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), dup, len(cover))


def test_binomial_bound():
    for k, n, d in ((0, 100, 0.05), (3, 500, 0.01), (0, 1, 0.5)):
        p = rules.upper_bound(k, n, d)
        tail = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - d) < 1e-6
    assert rules.upper_bound(0, 0, 0.05) == 1.0 and rules.upper_bound(5, 5, 0.05) == 1.0


def test_rules_keep_the_promised_share(spark):
    rng = random.Random(7)
    def text(bad):
        return " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 999)) + ("***" if bad else "") for _ in range(40))
    rows = [(i, text(i % 5 == 0), "en" if i % 2 else "fr", "s", 1) for i in range(6000)] + [(7000 + i, text(True), "xx", "s", 1) for i in range(9)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    lab = labels(spark, [(r[0], int(r[0] % 5 != 0), 0) for r in rows])
    got = rules.judge(d, lab).select("doc_id", "lang", "_kept").collect()
    for lang in ("en", "fr"):
        good = [r._kept for r in got if r.lang == lang and r.doc_id % 5]
        assert sum(not k for k in good) <= 0.01 * len(good)
        assert not any(r._kept for r in got if r.lang == lang and r.doc_id % 5 == 0)
    assert all(r._kept for r in got if r.lang == "xx")       # nothing certified there
    assert rules.judge(odd_docs(spark).drop("_kept"), labels(spark)).count() == len(ODD) + 3
    assert rules.judge(d.limit(0), lab).count() == 0


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in queries.op8_toxicity(spark, SF01).collect()}
    lab = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    clean = [got[i].toxic for i, y in lab.items() if not y and i in got]
    assert sum(clean) / len(clean) <= 0.02
    s = [(got[i].severity, y) for i, y in lab.items() if i in got and got[i].held_out]
    pos, neg = [a for a, y in s if y], [a for a, y in s if not y]
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.9      # area under the curve


def test_ordinal_grades_share_weights():
    rng = np.random.default_rng(8)
    xs, ys = [], []
    for _ in range(900):
        g = int(rng.integers(0, 4))
        cells = set(rng.integers(1000, 3000, 20).tolist()) | set(range(10 * g))
        xs.append(np.array(sorted(cells)))
        ys.append(g)
    m = toxicity.fit_ordinal(xs, ys)
    above = m.above(xs)
    assert (np.diff(m.cuts) > 0).all() and (np.diff(above, axis=1) <= 1e-12).all()
    expected = above.sum(axis=1)
    assert np.corrcoef(expected, ys)[0, 1] > 0.95
    assert ((above >= 0.5).sum(axis=1) == ys).mean() > 0.9


def test_toxicity_odd_rows(spark):
    lab = labels(spark, [(4, 1, 0), (2, 0, 1), (None, 1, 1)])
    assert toxicity.severity(odd_docs(spark), lab).where("_severity BETWEEN 0 AND 1").count() == len(ODD) + 3
    assert toxicity.severity(odd_docs(spark), labels(spark)).where("_severity = 0").count() == len(ODD) + 3
    assert toxicity.severity(odd_docs(spark).limit(0), lab).count() == 0


# --- urls

def py_rule(host, path):
    best = None
    for r, v in urls.RULES:
        name, _, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(r) > len(best[0])):
            best = (r, v)
    return best


def test_urls(spark):
    given = ["http://A.Example.COM/en/x?q=http://z.net/es/", "https://www.example.com/en/1#f", "ftp://x.y.net/es/", "http://net/fr/a",
             "no scheme", "", None, "http://host", "http://example.com/en/", "http://a.com?x", "x://y.org/é/ü", "://b.com/", "http://xcom/en/"]
    rows = list(enumerate(given)) + [(0, given[0])]
    got = urls.filter_urls(spark.createDataFrame([(i, u, "h", 1) for i, u in rows], "page_id bigint, url string, html string, host int")).collect()
    assert len(got) == len(rows)
    for r in got:
        rest = r.url.split("://", 1)[1] if r.url and "://" in r.url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        assert (r.host, r.path) == (host, path)
        best = py_rule(host, path)
        assert r.rule == (best and best[0]) and r.verdict == (best[1] if best else "allow" if r.p_allow >= 0.5 else "block")
    assert urls.filter_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_url_model_learns_the_rules(spark):
    got = queries.op2_url_filter(spark, SF01).where("rule IS NOT NULL").collect()
    assert sum((r.p_allow >= 0.5) == (r.verdict == "allow") for r in got) / len(got) > 0.9


def test_url_counts_are_exact_at_every_size(spark, monkeypatch):
    rng = random.Random(12)
    hosts = ("a.com", "example.com/en", "b.net/es", "c.org")
    rows = [(i, f"http://{hosts[i % 4]}/" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=24))) for i in range(6000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    held = F.pmod(F.xxhash64("url", F.lit("held")), F.lit(urls.HELD)) == 0
    trained = {r[0] for r in pages.where(~held).select("page_id").collect()}
    pairs = (collections.Counter(), collections.Counter())

    def places(u):
        raw = b"\0" * urls.ORDER + u.encode() + b"\1"
        for i in range(urls.ORDER, len(raw)):
            yield [(raw[i - k:i], raw[i:i + 1]) for k in range(urls.ORDER + 1)]

    seen = (collections.Counter(), collections.Counter())
    for i, u in rows:
        if i in trained and got[i].rule:
            c = got[i].verdict == "allow"
            for orders in places(u):
                for context, byte in orders:
                    seen[c][context] += 1
                    pairs[c][context, byte] += 1
    for i, u in rows[:200]:
        total = n = 0
        for orders in places(u):
            chance = [1 / 257, 1 / 257]
            for context, byte in orders:
                chance = [(pairs[c][context, byte] + urls.STRENGTH * chance[c]) / (seen[c][context] + urls.STRENGTH) for c in (0, 1)]
            total, n = total + math.log(chance[1]) - math.log(chance[0]), n + 1
        assert math.isclose(got[i].score, total / n, rel_tol=1e-9, abs_tol=1e-12)
    monkeypatch.setattr(urls, "MOST", 2000)         # most keys are joined
    again = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    assert again.keys() == got.keys()
    assert all(math.isclose(again[i].score, r.score, rel_tol=1e-9, abs_tol=1e-12) and again[i].verdict == r.verdict for i, r in got.items())


# --- html

def test_html_articles(spark):
    import html as entities
    got = {r.page_id: r for r in queries.op5_html_extraction(spark, SF01).collect()}
    for p in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        want = "\n\n".join(b for b in blocks if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


def test_html_boilerplate_and_consensus(spark):
    long = "A sentence that is certainly long enough to look like the text of an article. " * 3
    good = f"""<body><header><h1>Site</h1></header><nav>menu</nav><div id="c" class="post-{{n}} entry"><h2>Title &amp; more</h2><p>{long}<p>Second<br>line
      <script>x="<p>no</p>"</script><ul><li>one<li>two</ul><form><p>form</p></form><aside>side</aside><p class="advert">buy</p></div>
      <div class="comments"><p>{long * 4}</p></div><footer>foot</footer></body>"""
    short = '<div class="post-9 entry"><p>tiny</p></div><div class="other"><p>' + long + "</p></div>"
    rows = [(i, "http://h.org/x", good.replace("{n}", str(i))) for i in range(3)] + [(3, "http://h.org/y", short)]
    rows += [(4, None, None), (5, "http://z.org/", ""), (6, "http://z.org/", "plain words"), (7, "u", "<p>unclosed <b>bold"), (7, "u", "<p>unclosed <b>bold"),
             (8, "http://q.org", "<div><!-- no end"), (9, "http://q.org", "a < b <3 &lt;tag&gt;")]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    want = f"Title & more\n\n{long.strip()}\n\nSecond line\n\none\n\ntwo"
    assert [got[i].text for i in range(3)] == [want] * 3
    assert got[3].text == long.strip()      # a teaser on the host's path is not the page's article
    assert got[4].text == got[5].text == got[8].text == ""
    assert got[7].text == "unclosed bold"


def test_html_articles_in_several_containers(spark):
    def p(name, n):
        return f"<p>{name} " + "word " * (n // 5) + "</p>"

    def page(parts, around):
        return f"<body><nav>menu</nav>{around[0]}{''.join(parts)}{around[1]}<footer>foot</footer></body>"
    two = ["<section>" + p("One", 2000) + "</section>", "<section>" + p("Two", 500) + "</section>"]
    even = ["<section>" + p(n, 900) + "</section>" for n in ("One", "Two", "Three")]
    divs = [f'<div class="part-{i}">' + p(n, 1500 - 400 * i) + "</div>" for i, n in enumerate(("One", "Two", "Three"))]
    quote = [p("One", 300), "<blockquote>" + p("Two", 2000) + "</blockquote>", p("Three", 300)]
    cell = [p("One", 300), "<table><tr><td>" + p("Two", 2000) + "</td></tr></table>", p("Three", 300)]
    named = ['<section class="intro">' + p("One", 2000) + "</section>", '<section class="more">' + p("Two", 400) + "</section>"]
    given = [("m.org", two, "main"), ("m.org", even, "main"), ("m.org", two, "main"), ("p.org", divs, ""), ("p.org", divs[:1], ""),
             ("w.org", divs, "div"), ("s.org", two, ""), ("q.org", quote, "article"), ("b.org", quote, ""), ("c.org", cell, "article"),
             ("d.org", cell, 'div class="x"'), ("n.org", named, "main")]
    rows = [(i, f"http://{h}/", page(parts, (f"<{t}>", f"</{t.split()[0]}>") if t else ("", ""))) for i, (h, parts, t) in enumerate(given)]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i, (_, parts, _) in enumerate(given):
        want = "\n\n".join(" ".join(t.split()) for t in re.findall(r"<p>(.*?)</p>", "".join(parts)))
        assert got[i].text == want, i


# --- chat

def test_chat_round_trip():
    rng = random.Random(9)
    parts = ["\\", "### ", "###", "</turn>", ":", "a", "<", "\n", " ", "assistant", "#", "</", "é", "\ue000\ue001"]
    for _ in range(3000):
        turns = [("".join(rng.choices(parts, k=rng.randint(0, 3))), "".join(rng.choices(parts, k=rng.randint(0, 6)))) for _ in range(rng.randint(0, 5))]
        out, spans, rewrites = chat.locate(turns, chat.render)
        assert not rewrites and out == chat.render(turns) and chat.read_back(out) == turns
        assert [chat.unescape(out[s[2]:s[3]]) for s in spans] == [t for _, t in turns]


def test_chat_templates():
    def numbered(turns):
        return "<s>" + "".join(f"[{i}:{r}]{t}[/]" for i, (r, t) in enumerate(turns))
    turns = [("user", "hi"), ("assistant", "[/] ok"), ("user", "")]
    out, spans, rewrites = chat.locate(turns, numbered)
    assert not rewrites and [out[s[2]:s[3]] for s in spans] == ["hi", "[/] ok", ""]
    _, spans, rewrites = chat.locate(turns, lambda ts: f"{len(ts)} turns: " + str(ts))
    assert rewrites and spans == []
    many = [("user" if i % 2 else "assistant", f"turn {i}") for i in range(3 * chat.FULL_TURNS)]
    out, spans, rewrites = chat.locate(many, chat.render)
    assert not rewrites and out == chat.render(many) and len(spans) == len(many)


def test_chat_long_conversations_are_located_by_true_prefixes():
    n = 2 * chat.FULL_TURNS
    many = [("assistant" if i % 2 else "user", f"turn {i}") for i in range(n)]

    def numbered(turns):
        return "<s>" + "".join(f"[{i}:{r}]{t}[/]" for i, (r, t) in enumerate(turns))

    def strict(turns):
        if turns and turns[0][0] != "user":
            raise ValueError("a conversation begins with the user")
        return numbered(turns)

    def declared(turns):
        return numbered(turns)
    declared.additive = True                # wrongly

    for template in (numbered, strict, declared):
        out, spans, rewrites = chat.locate(many, template)
        assert not rewrites and out == numbered(many)
        assert [out[s[2]:s[3]] for s in spans] == [t for _, t in many]
        assert [s[0] for s in spans[1:]] == [s[1] for s in spans[:-1]] and spans[-1][1] == len(out)

    def forgets(turns):
        return chat.render(turns[-(chat.FULL_TURNS + 20):])
    assert chat.locate(many, forgets) == (forgets(many), [], True)
    assert chat.locate(many[:chat.FULL_TURNS + 20], forgets)[2] is False
    out, spans, _ = chat.locate(many, chat.render)
    assert [out[s[2]:s[3]] for s in spans] == [t for _, t in many]


def test_chat_query_digests(spark):
    got = {r.conv_id: r for r in queries.op6_chat_format(spark, SF001).collect()}
    rows = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF001}/conversations.parquet").orderBy("conv_id", "turn").collect():
        rows[r.conv_id].append((r.role, r.text or ""))
    rows[-7] = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]
    assert set(got) == set(rows)
    for c, turns in rows.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_odd_rows(spark):
    s = "conv_id bigint, turn bigint, role string, text string, formatted string"
    rows = [(1, 0, None, None, "x"), (1, None, "user", "first", "x"), (1, 0, None, None, "x"), (None, 1, "user", "n", None)]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, s)).collect()}
    assert chat.read_back(got[1].formatted) == [("user", "first"), ("", ""), ("", "")] and len(got) == 2
    assert chat.format_conversations(spark.createDataFrame([], s)).count() == 0


# --- language model

def test_lm_base_counts_and_normalised_model(spark, docs):
    got = lm.score(docs, T.id_bucket("doc_id", 5) == 1).collect()
    rows = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.collect()}
    c = collections.Counter(w for i, t in rows.items() if T.py_bucket(i, 5) != 1 for w in t)
    n, total = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    for r in got:
        t = rows[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / total) for w in t), rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_rare_tokens_are_joined(spark, docs, monkeypatch):
    whole = {r.doc_id: r for r in lm.score(docs, T.id_bucket("doc_id", 5) == 1).collect()}
    monkeypatch.setattr(lm, "HEAVY", 1e-3)
    for r in lm.score(docs, T.id_bucket("doc_id", 5) == 1).collect():
        w = whole[r.doc_id]
        assert (r.n_known, r.n_tokens) == (w.n_known, w.n_tokens) and math.isclose(r.base_score, w.base_score, rel_tol=1e-9)


def test_lm_odd_rows(spark):
    got = lm.score(odd_docs(spark), T.id_bucket("doc_id", 5) == 1).collect()
    assert len(got) == len(ODD) + 3 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert lm.score(odd_docs(spark).limit(0), F.lit(False)).count() == 0


# --- pipeline and registration

def test_pipeline_stages(spark):
    base = spark.read.parquet(f"{SF01}/documents.parquet")
    kept = base
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept2 = T.stored(stage(spark, kept, SF01), "t")
        assert kept2.columns == base.columns, name
        assert 0 < kept2.count() <= kept.count() and kept2.exceptAll(kept).isEmpty()
        kept = kept2
    bad = {r.doc_id for r in spark.read.parquet(f"{SF01}/labels.parquet").where("quality = 0").collect()}
    left = {r.doc_id for r in kept.collect()}
    assert len(bad & left) <= 0.1 * len(bad)
    rows = corpus_pipeline.run(spark, SF01).collect()
    assert {r.doc_id for r in rows} == left
    check_packed(rows)


def test_pipeline_stages_on_odd_rows(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF001).count() == 0
        assert out.exceptAll(docs).isEmpty()
    kept = corpus_pipeline.near_duplicates(spark, docs, SF001)
    assert kept.where("doc_id = 4").count() == 2 and kept.where("doc_id = 5").count() == 0
    assert kept.where("doc_id IS NULL").count() == 1
    check_packed(corpus_pipeline.best_fit_packing(spark, docs, SF001).collect())


def test_pipeline_decontaminates_row_by_row(spark):
    bad = max((r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect() if r.text), key=len)
    clean = "nothing of any test is said in here at all " * 3
    rows = [(None, bad), (None, clean), (1, bad), (1, clean), (2, clean), (3, bad), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.benchmark_decontamination(spark, docs, SF001).collect()
    assert sorted(map(str, left)) == sorted(str(r) for r in docs.collect() if r.text != bad)


def test_registered():
    names = set(entry.queries())
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
