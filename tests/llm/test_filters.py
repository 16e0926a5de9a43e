"""Quality rules, classifier, URL filter and HTML extraction."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gtfsforge.llm import html_extraction as html, quality_classifier as qc, quality_rules as rules, url_filter as url

from brute import SF_MID, docs_of, prose, speech, words_of

TEXTS = ["", " \n", "one", "a b c a b c d", "x\ny\nx\n\n\nx \nx", "#* $%& |<> ##", "é é\x85é\u00a0z", "same line\n" * 30, "a b " * 60,
         prose(np.random.default_rng(1), 400), "日本語 " * 80, "слово другое третье " * 30 + " ".join("слово%d" % k for k in range(90)), "a\x0bb\x0cc\rd\x1ce"]


def _base(t):
    w = words_of(t)
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) for k in range(3) if windows[w[i], w[i + 1], w[i + 2]] > 1}
    lines, dup = set(), 0
    for x in t.split("\n"):
        if words_of(x):
            dup += x in lines
            lines.add(x)
    return len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)


def test_base_rules_against_counting(docs_of):
    rows = [*enumerate(TEXTS), (50, None), (50, None), (None, TEXTS[-2])]
    got = rules.quality_rules(docs_of(rows))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted((str(i), *_base(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in got.collect()) == want
    assert rules.quality_rules(docs_of([])).count() == 0


def test_fertility_measures():
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(rules.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    f = rules.Fertility()
    for t in TEXTS:
        ids = enc.encode_ordinary(t)
        per, fall, bits = f.measure(t, max(1, _base(t)[1]))
        if ids:
            assert per == pytest.approx(len(t) / len(ids))
            assert bits == pytest.approx(-sum(n / len(ids) * math.log2(n / len(ids)) for n in Counter(ids).values()), abs=1e-9)
    assert f.measure("ab\U00012000", 3)[1] == pytest.approx(1 / 3)
    assert f.measure(" " * 1_100_000, 0)[0] >= 1  # a run too long for the splitting pattern


def test_rules_reject_junk_and_keep_prose(spark):
    d = rules.op9_quality_rules(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in d.where("n_words >= 50").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0
    assert n[0, False] > n.get((0, True), 0)


def test_each_measure_rejects_what_the_others_keep(docs_of):
    """Texts that pass the base rule and leave one band each."""
    import base64

    import public_tokenizers

    rng = np.random.default_rng(31)
    few = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "qr", "st", "uv", "wx"]
    with open(public_tokenizers.path(rules.RANKS), "rb") as f:
        tokens = [base64.b64decode(x.split()[0]) for x in f]
    long = sorted({t[1:].decode() for t in tokens if len(t) > 13 and t[:1] == b" " and t[1:].isalpha() and t.isascii()})[:90]
    known = rules.Fertility()._known
    single = [x for x in (t.decode("utf-8", "ignore") for t in tokens if len(t) > 1) if len(x) == 1 and not x.isascii() and x not in known]
    rows = {
        "entropy": " ".join(few[k] for k in rng.integers(0, 12, 90)),
        "fallback": " ".join(w + single[k % len(single)] for k, w in enumerate(long[:40] + speech(rng, 60).split())),
        "few characters": " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)).upper() + str(rng.integers(10 ** 6, 10 ** 7)) for _ in range(90)),
        "many characters": " ".join(long),
        "none": speech(rng, 120),
    }
    got = {r["doc_id"]: r for r in rules.quality_rules(docs_of(list(enumerate(rows.values())))).collect()}
    band = rules.BANDS["latin"]
    for k, name in enumerate(rows):
        r = got[k]
        left = {"entropy": r["token_entropy"] < band.least_entropy, "fallback": r["fallback_share"] > band.most_fallback,
                "few characters": r["chars_per_token"] < band.least_chars, "many characters": r["chars_per_token"] > band.most_chars}
        assert not r["base_failed"] and {n for n, out in left.items() if out} == ({name} if name != "none" else set()) and r["kept"] == (name == "none"), (name, r)


def test_random_indexing_sums(docs_of):
    rows = [(k, prose(np.random.default_rng(k), 40, 30)) for k in range(20)] + [(21, None), (22, "")]
    pos, sign = qc.index_vectors()
    want, count = np.zeros((qc.ROWS, qc.DIM)), Counter()
    for _, t in rows:
        r = qc.rows_of(t or "").tolist()
        for i, a in enumerate(r):
            count[a] += 1
            for j in range(max(0, i - qc.REACH), min(len(r), i + qc.REACH + 1)):
                if j != i:
                    want[a, pos[r[j]]] += sign[r[j]]
    got = qc.context_sums(docs_of(rows).repartition(4), "text").toPandas()
    assert dict(zip(got.row, got.n)) == dict(count)
    assert all((got.set_index("row").loc[a].to_numpy()[1:] == want[a]).all() for a in count)


def test_pooling_does_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    v, rows = rng.standard_normal((qc.ROWS, qc.DIM)).astype(np.float32), rng.integers(0, qc.ROWS, 1000)
    whole = qc.pooled(v, rows)
    monkeypatch.setattr(qc, "CHUNK", 7)
    assert np.allclose(whole, qc.pooled(v, rows), atol=1e-5)
    x = v[rows].astype(float)
    assert np.allclose(whole, np.concatenate((x.mean(0), x.std(0), (x[1:] * x[:-1]).mean(0), [1000 / (1000 + qc.SHRINK)])), atol=1e-4)
    assert not qc.pooled(v, rows[:0]).any()


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 12))
    p = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))
    y = (rng.random(4000) < p).astype(float)
    x = np.column_stack((x, np.ones(4000)))
    net = qc.train(x[:3000], y[:3000])
    s = net.scores(x[3000:])
    assert abs(s.mean() - y[3000:].mean()) < 0.05
    assert np.abs(s - p[3000:]).mean() < 0.12
    # without weight a document gets the same score, whatever its features
    x[:, -1] = 0
    assert np.ptp(net.scores(x)) == 0
    assert (qc.train(x[:5], np.ones(5)).scores(x) > 0.99).all()
    assert (qc.train(x[:0], y[:0]).scores(x) == 0.5).all()


def test_classifier_on_held_out_rows(spark):
    got = qc.op4_quality_classifier(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    assert np.mean([r.predicted for r in held if r.quality]) > 0.97
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_classifier_edge_rows(spark, docs_of):
    rows = [(k, "GOOD " * 9 if k % 2 else "bad words here") for k in range(40)] + [(50, None), (51, ""), (None, "x"), (1, "again")]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(3, 1, 0), (4, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = qc.fit(docs_of(rows), labels)
    out = qc.score(docs_of(rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert qc.score(docs_of([]), qc.fit(docs_of([]), labels.limit(0))).count() == 0


URLS = ["http://a.example.org/es/x", "https://example.org/en/1", "http://example.org/en/2?x", "HTTP://WWW.Shop.COM/fr/#a", "http://shop.com/de/", "http://notexample.org/es/",
        "ftp://x.net", "http://x.net?y=/de/", "no scheme", "", None, "a://b://c/d", "http://spam.net/", "http://sub.spam.net/a", "http://myspam.net/", "http://", "http:///p"]


def _verdict(u, listed):
    rest = u.split("://", 1)[1] if u and "://" in u else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in url.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    bad = any(host == d or host.endswith("." + d) for d in listed)
    return host, path, None, "block" if bad else "allow"


@pytest.mark.parametrize("max_bits,group", [(1 << 22, 64), (64, 64), (64, 4)])
def test_verdicts(spark, max_bits, group):
    listed = ["spam.net", *(f"d{k}.net" for k in range(0, 200, 3))]
    urls = URLS + [f"http://s{k % 5}.d{k}.net/p" for k in range(200)] + URLS[:3]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    block = spark.createDataFrame([(d,) for d in [*listed, None, "SPAM.net", "elsewhere.net"]], "domain string")
    got = url.verdicts(pages, block, max_bits=max_bits, group=group).collect()
    assert sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted((k, *(str(x) if i == 2 else x for i, x in enumerate(_verdict(u, listed)))) for k, u in enumerate(urls))
    assert url.verdicts(pages.limit(0), block).count() == 0
    assert {r.verdict for r in url.verdicts(pages, block.limit(0), rules=()).collect()} == {"allow"}


@pytest.mark.parametrize("max_bits", [1 << 22, 256])
def test_cascade_is_exact_with_weak_levels(spark, monkeypatch, max_bits):
    monkeypatch.setattr(url, "BITS_PER_KEY", 2)
    universe = spark.createDataFrame([(f"k{k}", k % 4 == 0) for k in range(1500)], "key string, listed boolean")
    cascade = url.Cascade(universe, max_bits)
    assert len(cascade.levels) > 4 and cascade.shards == (1 if max_bits > 256 else 3)
    from pyspark.sql import functions as F
    assert universe.where(cascade.listed(F.col("key"), cascade.tables()) != F.col("listed")).count() == 0


def test_listed_domains_come_from_the_whole_corpus(spark):
    """Keys, listed and not, grow with the hosts; the plan has no join and no Python."""
    pages = spark.createDataFrame([(k, f"http://{'www.' * (k % 2)}{'spam-farm' if k % 10 == 0 else 'site'}.h{k // 10}.example.net/") for k in range(4000)], "page_id long, url string")
    found = {}
    for n in (400, 4000):
        part = pages.where(f"page_id < {n}")
        keys = url.domains(part)
        found[n] = (keys.count(), url.named(keys).count())
        out = url.verdicts(part, url.named(keys), rules=())
        assert out.where("verdict = 'block'").count() == n // 10
    assert found[4000][0] > 9 * found[400][0] and found[4000][1] == 10 * found[400][1] == 400
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


PAGE = "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a='</p>';</script></head><body>%s</body></html>"
P1 = "The first paragraph of the article says quite a few things, and it goes on for a while so that it counts as text."
P2 = "The second one has <b>bold</b>,\n <a href='/x'>a link</a> and   &eacute;ntities &lt;here&gt;."
WANT = ["Head &c", P1, "The second one has bold, a link and éntities <here>.", "Short end."]
BODY = f"<h1>Head &amp;c</h1><p>{P1}<p>{P2}</p><p>Short end.</p>"
MENU = "<ul>" + "".join(f"<li><a href='/{k}'>Menu item {k}</a></li>" for k in range(8)) + "</ul>"


@pytest.mark.parametrize("body", [
    f"<nav>{MENU}</nav><article>{BODY}</article><footer>&copy; someone and a long line of legal text that nobody reads at all</footer>",
    f"<header><h2>Site</h2>{MENU}</header><main>{BODY}</main><aside><p>Side text that is long enough to look like content if one did not look.</p></aside>",
    f"<div id='nav-top'>{MENU}</div><div class='post-body'>{BODY}</div><div class='sidebar'><p>{P1}</p></div><div id='footer'>x</div>",
    f"<div class='cookie-notice'><p>We use cookies, a lot of them, and tell you so in a very long sentence here.</p></div><article>{BODY}</article>",
    f"<article><header>{BODY.split('<p>', 1)[0]}</header><p>{BODY.split('<p>', 1)[1]}<div class='ad'>{P1}</div></article><section id='comments'><p>{P1}</p></section>",
    f"<article>{BODY}<form><p>Subscribe to us</p><input name=x><button>Go</button></form></article><div class='comment-list'><p>{P1}</p></div>",
    f"<!-- ad --><div class='ad'>Buy.</div><article>{BODY.replace('</p><p>Short', '<br><p>Short')}",
    f"<article>{BODY}<div role='complementary'>Other</div><p hidden>Not shown</p><div style='display: none'>nor this</div></article>",
])
def test_article_text(body):
    assert html.blocks_of(PAGE % body) == WANT


LONG = [f"Part {k} says quite a few things, " + "and it goes on for a while so that it counts as text " * n for k, n in enumerate((6, 20, 5))]
ITEMS = "".join(f"<li>{LONG[0].strip()} {k}</li>" for k in range(5))


@pytest.mark.parametrize("body", [
    f"<div id='post'><p>{LONG[0]}</p><ul>{ITEMS}</ul><p>{LONG[2]}</p></div>",
    f"<div id='post'><p>{LONG[0]}</p><ol>{ITEMS}</ol></div>",
    f"<div id='post'><p>{LONG[0]}</p><table><tr><td>{LONG[1]}</td><td>{LONG[1]}</td></tr></table><p>{LONG[2]}</p></div>",
    f"<section><h2>One</h2><p>{LONG[0]}</p></section><section><h2>Two</h2><p>{LONG[1]}</p></section>",
    f"<article><h2>One</h2><p>{LONG[0]}</p></article><article><h2>Two</h2><p>{LONG[1]}</p></article>",
    f"<main><article><p>{LONG[0]}</p></article><h2>Between</h2><article><p>{LONG[1]}</p></article></main>",
    f"<div><p>{LONG[0]}</p></div><article><p>{LONG[1]}</p></article>",
    f"<dl><dt>Term</dt><dd>{LONG[1]}</dd></dl><div><div><p>{LONG[2]}</p></div><p>End.</p></div>",
])
def test_uneven_containers_lose_nothing(body):
    import re

    want = [" ".join(x.split()) for x in re.split(r"<[^>]*>", body) if x.strip()]
    assert html.blocks_of(PAGE % f"<nav>{MENU}</nav>{body}<footer>Legal text that nobody reads at all</footer>") == want
    assert html.blocks_of(body) == want  # without a body around it


SIDE = f"<div class='sidebar'><p>{P1}</p></div>"


@pytest.mark.parametrize("body", [
    f"<div class='content with-sidebar'><article>{BODY}</article>{SIDE}</div>",
    f"<div class='has-sidebar'><main>{BODY}</main></div><div id='footer'>x</div>",
    f"<div id='search-results'><article>{BODY}</article></div>",
    f"<div class='wrapper header-fixed'><article>{BODY}</article></div>",
    f"<div class='header-fixed'><div id='nav-page'><article>{BODY}</article></div><section class='related-posts'><article class='related'>{P1}</article></section></div>",
    f"<div class='has-sidebar'><div class='post'>{BODY}</div></div>{SIDE}",
    f"<div id='header'><div class='post'>{BODY}</div>",
    f"<div class='page-side-by-side'>{BODY}</div>",
    f"<div class='no-sidebar'><article class='has-comments'>{BODY}</article></div><section class='related'><article class='card'>{P1}</article></section>",
    f"<div class='with-comments'><article>{BODY}</article></div><ol class='comment-list'><li><article class='comment-body'>{P1 * 9}</article></li></ol>",
    f"<div class='post'>{BODY}</div><div id='comments'><p>{P1 * 9}</p></div>",
    f"<article>{BODY}</article><div class='ad'>{P1 * 9}</div>{SIDE * 9}",
])
def test_layout_classes_lose_nothing(body):
    assert html.blocks_of(PAGE % body) == WANT


def test_articles_in_several_wrappers():
    body = f"<div class='header-fixed'><article><p>{LONG[1]}</p></article></div><div class='search-results'><article><p>{LONG[0]}</p></article></div>"
    assert html.blocks_of(PAGE % body) == [LONG[1].strip(), LONG[0].strip()]


def test_extraction_columns(spark):
    page = PAGE % f"<article>{BODY}</article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<p"), (4, "u", "plain words only"), (5, "u", "<nav>a</nav>")]
    df = spark.createDataFrame([(*r, "old", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    text = "\n".join(WANT)
    want = [("1", text), ("1", text), ("2", ""), ("3", ""), ("None", ""), ("4", "plain words only"), ("5", "")]
    got = html.extract(df).collect()
    assert sorted((str(r.page_id), r.text) for r in got if r.page_id is not None) == sorted(w for w in want if w[0] != "None")
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(rows)
    assert html.extract(df.limit(0)).count() == 0


def test_smoothing():
    x = np.array([0.0, 0, 10, 0, 0])
    assert html.smooth(x).argmax() == 2 and html.smooth(np.ones(3)).tolist() == pytest.approx([1, 1, 1])


@pytest.mark.parametrize("text", ["<![foo[ x ]]>", "<p>x</p><![%foo;[", "<![CDATA[ a ]]>", "<!", "<![", "<!DOCTYPE", "<!-- never closed", "<p title='never closed", "</", "</>", "<>", "&#x110000;&#xD800;", "<a<b<p>"])
def test_malformed_markup_is_read(text):
    assert "Kept words here" in " ".join(html.blocks_of(f"<div><p>Kept words here</p></div>{text}"))
    html.blocks_of(text)


def test_markup_of_any_kind_does_not_raise():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    bits = st.sampled_from(["<p>", "</p>", "<div class='ad x'>", "</div>", "<![", "]]>", "<!", "<!--", "-->", "<a href=x>", "</a>", "<article>", "</article>", "text here ", "&amp;", "&#0;", "<", ">", "'", '"',
                            "<script>", "</script>", "<li>", "<table><tr><td>", "</main>", "<main>", "<br/>", "<b>", "</i>", "<i>", "%", "[if IE]"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(bits, max_size=40))
    def run(parts):
        assert all(x == " ".join(x.split()) for x in html.blocks_of("".join(parts)))

    run()


def test_a_link_ends_with_its_paragraph():
    assert html.blocks_of(f"<div><p><a href='/x'>left open<p>{P1}<p>{LONG[1]}</div>") == ["left open", P1, LONG[1].strip()]


@pytest.mark.parametrize("make", [lambda n: "".join(f"<div>t{k}" for k in range(n)), lambda n: "<div class='ad'>x" * n, lambda n: "<i><p>" + "<b>" * n + "x" + "</i>" * n,
                                  lambda n: "<section>" * n + "</div>x" * n, lambda n: "<article><p>x" * n])
def test_time_is_linear_in_depth(make):
    import time

    def seconds(n):
        page = make(n)
        t = time.perf_counter()
        html.blocks_of(page)
        return time.perf_counter() - t

    seconds(100)
    assert seconds(40_000) < 25 * max(0.02, seconds(4_000))


def brute_content(ratio):
    """Ratio, smoothing and threshold spelled out: indexes of the content lines."""
    import math

    kernel = {d: math.exp(-d * d / (2 * html.SIGMA ** 2)) for d in range(-html.RADIUS, html.RADIUS + 1)}
    smoothed = []
    for i in range(len(ratio)):
        near = [(kernel[j - i], ratio[j]) for j in range(len(ratio)) if j - i in kernel]
        smoothed.append(sum(k * r for k, r in near) / sum(k for k, _ in near))
    mean = sum(smoothed) / len(smoothed)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in smoothed) / len(smoothed))
    return [i for i, x in enumerate(smoothed) if x >= deviation and ratio[i] > 0]


def test_regions_against_brute_force():
    """Pages of unnamed blocks only: the clustering decides which of them are content."""
    rng = np.random.default_rng(13)
    decided = 0
    for _ in range(60):
        groups = [[(bool(rng.random() < 0.5), int(rng.integers(1, 60))) for _ in range(int(rng.integers(1, 6)))] for _ in range(int(rng.integers(2, 6)))]
        texts = [[f"g{g}l{k} " + "word " * n for k, (_, n) in enumerate(lines)] for g, lines in enumerate(groups)]
        page = "".join("<div>" + "".join(f"<p><a href='/'>{t}</a></p>" if link else f"<p>{t}</p>" for (link, _), t in zip(lines, ts)) + "</div>" for lines, ts in zip(groups, texts))
        flat = [(g, t.strip(), link) for g, (lines, ts) in enumerate(zip(groups, texts)) for (link, _), t in zip(lines, ts)]
        # tags before a line's end: its own, those that close the line before, and the group's
        tags, ratio = [], []
        for i, (g, t, link) in enumerate(flat):
            n = (1 + 2 * link) + (1 if i else 0) + (0 if i and flat[i - 1][0] == g else 1 + (1 if i else 0))
            ratio.append(0 if link else len(t) / n)
        content = brute_content(ratio) or [i for i, r in enumerate(ratio) if r > 0]
        inside = {flat[i][0] for i in content}
        want = [t for g, t, _ in flat if not inside or len(inside) > 1 or g in inside] if inside else []
        assert html.blocks_of(page) == want
        decided += bool(inside) and want != [t for _, t, _ in flat]
    assert decided > 5  # the clustering left lines out on these
