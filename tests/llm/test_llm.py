"""Operators against brute force, round trips and held-out accuracy on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldmark.llm import boosting, components, decontamination, fingerprints, html, mixing, near_duplicates, pii, quality, repeats, token_files, toxicity, words

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], DOCS)


def noise(rng, n):
    return " ".join("".join(rng.choice("aeionrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


# ---- words


def test_words_match_the_pattern_and_hash_by_value():
    texts = ["a b  c\n d", "", None, " x ", "ab cd\x0bef\x0cgh", "é É Ab ab,", "zz yy"]
    w = words.words_of(pa.array(texts))
    seen = {}
    hashes = w.hashes()
    for k, t in enumerate(texts):
        own = [bytes(w.data[a:b]).decode() for a, b in zip(w.starts[w.first[k] : w.first[k + 1]], w.ends[w.first[k] : w.first[k + 1]])]
        assert own == WORD.findall(t or "")
        for x, h in zip(own, hashes[w.first[k] : w.first[k + 1]]):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)
    folded = w.trimmed().hashes(lower=True)
    assert folded[-2] == folded[-3]  # "ab," and "Ab"


@pytest.mark.parametrize("size", [1, 2, 5, 18, 35])
def test_rolling_windows(size):
    rng = random.Random(size)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(8)]
    w = words.words_of(pa.array(texts))
    roll, good, flat = words.rolling(w.hashes(), size), words.valid(w.first, size), [x for t in texts for x in t.split()]
    doc, seen = w.doc(), {}
    for k in range(len(roll)):
        assert good[k] == (doc[k] == doc[k + size - 1])
        assert seen.setdefault(tuple(flat[k : k + size]), roll[k]) == roll[k]
    assert len(set(seen.values())) == len(seen)


# ---- 1 html

PAGE = '<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">Home</a></ul></nav><div class="ad">Buy</div>{}<footer>&copy; me</footer></body></html>'


def test_main_text():
    text = lambda h: html.main_text(_marked(h), set())
    assert text(PAGE.replace("{}", "<article><h1>A &amp; B</h1><p><b>One.<br><p>Two&nbsp;\n x</p><div class='comments'><p>hi</p></div></article>")) == "A & B One. Two x"
    assert text("") == "" and text("plain <i>wor</i>ds") == "plain words"
    assert text("<main><p>a<p>b<aside>c</aside></main><p>d") == "a b"
    assert text("<p>x</p><!-- <p>no</p> --><form>f</form><p hidden>h</p><ul><li>1<li>2</ul>") == "x 1 2"
    assert text("<article>cut <p>off &am") == "cut off &am"
    assert text("<form><nav>n</nav><article><p>a</article></form>") == "a" and text("<body><form><h1>t</h1><p>b</form><form>search</form>") == "t b"
    assert text("<aside><article><p>teaser</article></aside><article><p>the long story</article>") == "the long story"


def test_all_articles_and_main_beside_them():
    text = lambda h: html.main_text(_marked(h), set())
    assert text("<article><p>part one is longer</article><p>x<article><p>part two</article>") == "part one is longer part two"
    assert text("<main><h1>t</h1><p>long prose</p><article><p>teaser</article><p>end</main><article>after</article>") == "t long prose teaser end after"
    assert text("<main><article>a</article><article class=comment>c</article><article>b</article></main>") == "a b"


def _marked(h):
    nodes = html.parse(h)
    html.mark(nodes)
    return nodes


def test_template_is_found_by_counting(spark):
    body = lambda k: f"<div class=x1><p>Site slogan</p></div><div class=x2><p>story number {k}</p></div>"
    rows = [(k, f"http://h.example/{k}", body(k)) for k in range(8)] + [(8, "http://other.example/", body(0)), (9, None, None), (10, "http://h.example/1", body(1)), (11, "http://c.example", "<p>same</p>")]
    rows += [(k, "http://c.example", "<p>same</p>") for k in range(12, 20)]  # copies of one page are one content
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract_text(pages).collect()}
    assert got[3] == ("story number 3", 14) and got[10][0] == "story number 1"
    assert got[8][0] == "Site slogan story number 0" and got[9] == ("", 0) and got[15][0] == "same"
    assert html.extract_text(pages.limit(0)).count() == 0


def test_template_is_a_share_of_its_host(spark):
    """What recurs on 6 of 900 pages is no template; a paragraph must recur on half of them, a heading within an article never is one."""
    box = lambda k: "<div class=x3><p>Method of the survey</p></div>" if k < 6 else ""
    some = lambda k: "<h2>Introduction</h2>" if k % 3 == 0 else ""
    body = lambda k: f"<div class=x1><p>Site slogan</p></div>{some(k)}{box(k)}<p>Since 1901</p><div class=x2>story number {k}</div>"
    rows = [(k, f"http://h.example/{k}", body(k)) for k in range(900)] + [(k, f"http://a.example/{k}", f"<article><h2>Introduction</h2><div>box</div><p>own {k}</article>") for k in range(900, 910)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Introduction Method of the survey story number 3" and got[800] == "story number 800" and got[904] == "Introduction own 904"


def test_names_do_not_take_the_text():
    text = lambda h: html.main_text(_marked(h), set())
    assert text('<article class="post has-comments"><p>one real paragraph</article>') == "one real paragraph"
    assert text('<body class="no-sidebar"><div>one real paragraph</div>') == "one real paragraph"
    assert text('<div class="content follow-up"><p>one real paragraph</div>') == "one real paragraph"
    assert text('<article><section id="legal"><p>one real paragraph</section></article>') == "one real paragraph"
    assert text('<article><p class="related">one real paragraph</article>') == "one real paragraph"
    for name in ("cookie-banner", "ad", "sidebar-left", "comment-list", "adBox", "site_footer", "newsletter-signup"):
        assert text(f'<div><p>text</div><div class="{name}"><p>gone</div>') == "text"
    assert text('<p>text<div class="related"><a href="/1">other story</a></div><div class="related">and prose stays</div>') == "text and prose stays"


def _sites(rng):
    """Pages without ``article`` or telling names: only recurrence tells the site from the text. With what must be left."""
    rows, want = [], {}
    opaque = lambda: "c" + "".join(rng.choice("bcdfgh") for _ in range(5))
    for site in range(6):
        menu = [f"<div class={opaque()}><span>{noise(rng, 3)}</span><div><ul><li>{noise(rng, 1)}<li>{noise(rng, 2)}</ul></div></div>" for _ in range(2)]
        foot = [f"<section class={opaque()}><p>{noise(rng, 6)}</p></section>" for _ in range(3)]
        for k in range(rng.randint(30, 60)):
            paragraphs = [noise(rng, rng.randint(3, 20)) for _ in range(rng.randint(1, 4))]
            if rng.random() < 0.2:
                paragraphs.append("a passage that some pages share")
            main = "".join(f"<p>{p}</p>" for p in paragraphs)
            page = f"<body>{rng.choice(menu)}<div class=b><div>{main}</div></div>{rng.choice(foot)}</body>"
            rows.append((len(rows), f"http://s{site}.example/{k}", page))
            want[len(rows) - 1] = " ".join(paragraphs)
    return rows, want


@pytest.mark.parametrize("broadcast_rows", [html.BROADCAST_ROWS, 0])
def test_templates_by_recurrence_alone(spark, broadcast_rows):
    rows, want = _sites(random.Random(12))
    rows += rows[:5] + [(900, "http://s0.example/new", "<body><div class=b><div><p>" + "long " * 60_000 + "</p></div></div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract_text(pages.withColumn("text", F.lit("clash")).withColumn("salt", F.lit(1)).withColumn("place", F.lit(2)), broadcast_rows=broadcast_rows).collect()
    assert len(got) == len(rows) and all(r.text == want.get(r.page_id, r.text) and r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.n_template > 0 for r in got if r.page_id < 900} == dict.fromkeys(want, True)
    # without the counts no page loses its site
    assert not any(html.main_text(_marked(h), set()) == want.get(k) for k, _, h in rows)


def test_templates_against_brute_counts(spark):
    rows, _ = _sites(random.Random(13))
    rows += [(k, "http://s1.example/copy", rows[20][2]) for k in range(500, 510)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    where, contents, tag = defaultdict(set), defaultdict(set), {}
    for _, url, h in rows:
        host = url.split("/")[2]
        contents[host].add(h)
        for subtree, flow in html.counted(_marked(h)).items():
            where[host, subtree].add(h)
            tag[subtree] = flow
    template = {w for w, own in where.items() if len(own) >= html.MIN_PAGES and len(own) >= (html.FLOW_SHARE if tag[w[1]] else html.SHARE) * len(contents[w[0]])}
    want = {k: html.main_text(_marked(h), {s for host, s in template if host == url.split("/")[2]}) for k, url, h in rows}
    assert {r.page_id: r.text for r in html.extract_text(pages).collect()} == want and len(template) > 20


def test_pages_give_their_article(spark):
    from html import unescape

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    for p, got in zip(pages.orderBy("page_id").collect(), html.op1_html_text(spark, FOLDER).orderBy("page_id").collect(), strict=True):
        article = re.search(r"<article>(.*?)</article>", p.html, re.DOTALL)[1]
        assert got.text == " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))).split()) and got.n_chars == len(got.text)


# ---- 2 near-duplicates


def test_icws_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    wa, wb = rng.random(3000) + 0.1, rng.random(3000) + 0.1
    got = near_duplicates.samples(np.repeat([0, 1], 3000), np.tile(hashes, 2), np.concatenate([wa, wb]), 2)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert (got[0] == got[1]).mean() == pytest.approx(want, abs=4 * math.sqrt(want * (1 - want) / got.shape[1]))


def brute_classes(spark, frame, texts, ids):
    idf = near_duplicates.word_frequencies(frame)
    d, h, w = near_duplicates.shingles(words.words_of(pa.array(texts)), idf)
    own = defaultdict(dict)
    for a, b, c in zip(d.tolist(), h.tolist(), w.tolist()):
        own[a][b] = c
    up = list(range(len(texts)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = sum(min(v, own[b].get(k, 0)) for k, v in own[a].items())
            every = sum(own[a].values()) + sum(own[b].values()) - both
            if texts[a] is not None and texts[a] == texts[b] or every and both / every >= 0.8:
                up[max(top(a), top(b))] = min(top(a), top(b))
    out = defaultdict(list)
    for k in range(len(texts)):
        out[top(k)].append(ids[k])
    return {i: min(v) for v in out.values() for i in v}


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    rows, passage = [], noise(rng, 60)
    for base in range(25):
        text = noise(rng, 150).split()
        rows.append((len(rows), " ".join(text)))
        for _ in range(rng.randint(0, 6)):
            near = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 40])):
                near[rng.randrange(len(near))] = noise(rng, 1)
            rows.append((len(rows), rng.choice(["", "  "]) + " ".join(near)))
    rows += [(len(rows) + k, noise(rng, 100) + " " + passage) for k in range(20)]
    rows += [(900, None), (901, None), (902, ""), (903, ""), (904, "one two"), (905, "one two"), (906, "one  two")]
    frame = docs(spark, rows)
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame.withColumn("key", F.lit(1))).collect()}
    want = brute_classes(spark, frame, [t for _, t in rows], [i for i, _ in rows])
    assert got == want and got[900] == 900 and got[901] == 901 and got[903] == 902 and got[906] == 904
    assert near_duplicates.near_duplicates(frame.limit(0)).count() == 0


def test_near_duplicates_of_a_star(spark):
    """Variants that are near their origin but not near each other are one class through it."""
    rng = random.Random(9)
    base = noise(rng, 400).split()
    rows = []
    for k in range(60):
        near = list(base)
        for at in rng.sample(range(5, 395), 7):
            near[at] = noise(rng, 1) + "x"
        rows.append((k + 1, " ".join(near)))
    rows.append((999, " ".join(base)))
    frame = docs(spark, rows)
    found, links = near_duplicates.classes_and_links(frame)
    rows_ = found.collect()
    got = {r.doc_id: r.class_id for r in rows_}
    want = brute_classes(spark, frame, [t for _, t in rows], [i for i, _ in rows])
    assert got == want and {r.class_id: r.class_size for r in rows_} == Counter(want.values())
    # the links are similar pairs that span the classes
    key = {r.key: r.doc_id for r in rows_}
    links = [(key[r.a], key[r.b], r.similarity) for r in links.collect()]
    assert all(want[a] == want[b] and s >= 0.8 for a, b, s in links) and len({x for a, b, _ in links for x in (a, b)}) == sum(v > 1 for v in map(Counter(want.values()).get, want.values()))


def test_near_duplicates_lose_no_link_near_the_threshold(spark):
    """Families of variants around the threshold, most pairs of which are links of neither star."""
    rng, rows = random.Random(31), []
    for family in range(6):
        base = noise(rng, 220).split()
        for k in range(40):
            near = list(base)
            for at in rng.sample(range(5, 215), rng.randint(2, 9)):
                near[at] = noise(rng, 1) + "q"
            rows.append((len(rows), " ".join(near)))
    frame = docs(spark, rows)
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()}
    want = brute_classes(spark, frame, [t for _, t in rows], [i for i, _ in rows])
    # pairs of one class by brute force that met in no band at all are what banding may miss
    lost = sum(want[a] == want[b] and got[a] != got[b] for a in want for b in range(a))
    assert lost == 0 and all(want[i] <= got[i] for i in want)


def test_idf_is_one_rule_at_every_size():
    for n in (1, 10, 999, 1001, 1999, 2001, 10**6):
        df = np.array([d for d in (1, 2, 5, n // 1000, n // 100, n) if max(2.0, near_duplicates.RARE * n) <= d <= n], np.int64)
        idf = near_duplicates.Idf(np.arange(len(df), dtype=np.uint64), df, n)
        assert idf(np.arange(len(df), dtype=np.uint64)) == pytest.approx([math.log(1 + n / max(d, n / 1000)) for d in df], rel=1e-5)
        assert idf(np.array([999], np.uint64))[0] == pytest.approx(math.log(1 + n / max(1, n / 1000)), rel=1e-5)


def test_near_duplicates_in_a_hot_bucket(spark):
    """Hundreds of texts that share a passage, too little to be near; pairs among them barely are."""
    rng = random.Random(21)
    passage = noise(rng, 260)
    rows = [(k, f"{passage} {noise(rng, 22)}") for k in range(600)]
    rows += [(1000 + k, " ".join(rows[k][1].split()[:267] + noise(rng, 15).split())) for k in range(60)]
    want = {i: i % 1000 for i, _ in rows}
    frame = docs(spark, rows + [(5000 + k, noise(rng, 5)) for k in range(20_000)])  # the passage is rare in the corpus
    idf = near_duplicates.word_frequencies(frame)
    near = near_duplicates.similarity(pa.array([rows[k][1] for k in range(60)]), pa.array([t for _, t in rows[600:]]), idf)
    far = near_duplicates.similarity(pa.array([rows[0][1]] * 599), pa.array([t for _, t in rows[1:600]]), idf)
    assert near.min() >= near_duplicates.SIMILARITY and 0.7 < far.min() and far.max() < near_duplicates.SIMILARITY
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).where("doc_id < 5000").collect()}
    assert got == want


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (20, 20)] + [(k, k + 1) for k in range(100, 140)]
    got = {r.v: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in (1, 2, 3, 4, 5)} == {1} and {got[k] for k in (7, 8, 9)} == {7} and {got[k] for k in range(100, 141)} == {100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_paths_take_few_rounds(spark):
    rng = random.Random(3)
    path = rng.sample(range(10**6), 2048)
    two_ends = [0, *range(1000, 1511), 1]
    links = [*zip(path, path[1:]), *((x + 2 * 10**6, y + 2 * 10**6) for x, y in zip(two_ends, two_ends[1:]))]
    found, n = components.rounds(spark.createDataFrame(links, "a long, b long"))
    got = {r.v: r.label for r in found.collect()}
    assert {got[v] for v in path} == {min(path)} and {got[v + 2 * 10**6] for v in two_ends} == {2 * 10**6} and n <= 16


# ---- 3 quality, 8 toxicity


@pytest.mark.parametrize(("query", "label", "n", "out", "rare"), [(quality.op3_quality, "quality", 4, 2, 0), (toxicity.op8_toxicity, "toxic", 5, 0, 1)])
def test_held_out_rows(spark, query, label, n, out, rare):
    """Precision and recall of the rarer label on rows that nothing was learned from; always the same answer would have neither."""
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = query(spark, folder).collect()
    assert len(got) == 10_000 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == out) for r in got)
    held = [(r.doc_id, truth[r.doc_id] == rare, r.predicted == rare) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    hits = sum(t and p for _, t, p in held)
    assert hits / sum(t for _, t, _ in held) >= 0.88 and hits / sum(p for _, _, p in held) >= 0.93
    # in every language
    for one in ("en", "de", "fr", "es"):
        own = [(t, p) for i, t, p in held if lang[i] == one]
        assert sum(t and p for t, p in own) >= 0.7 * sum(t for t, _ in own) and sum(p and not t for t, p in own) <= 0.03 * len(own)


def test_scores_are_of_whole_texts_alone(spark):
    """Each row's score is that of the fitted net on the row's whole text alone, whatever else is in the batch."""
    frame, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    odd = [(10**6 + k, t) for k, t in enumerate(["", " \n lead and trail \n\n", "x", "\t\t", "  next", "a. b " * 9000])]
    frame = docs(spark, [(r.doc_id, r.text) for r in frame.collect()] + odd)
    net = toxicity.fit_toxicity(quality.with_text(frame), labels)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(frame, net).collect()}
    mil = quality.fit_quality(frame, labels)
    also = {r.doc_id: r.score for r in quality.score_quality(frame, mil).collect()}
    for r in frame.collect():
        one = pa.array([r.text])
        assert got[r.doc_id] == pytest.approx(float(net.score(*toxicity.slots(one))[0]), abs=1e-4)
        assert also[r.doc_id] == pytest.approx(float(mil.score(*quality.passages(one))[0]), abs=1e-6)
    assert all(r.predicted == (r.score >= 0.5) for r in toxicity.op8_toxicity(spark, FOLDER).collect())


def test_attention_pools_passages(spark):
    """The net's score written out passage by passage: gates, weights that sum to one, the weighted code."""
    frame, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    net = quality.fit_quality(frame, labels)
    w = net.w
    for r in frame.orderBy("doc_id").limit(40).collect():
        x, bags = quality.passages(pa.array([r.text]))
        assert len(x) == max(1, -(-len(WORD.findall(r.text)) // quality.PASSAGE)) == bags[-1]
        codes = [np.tanh(((p - net.mean) / net.scale) @ w["a"] + w["a0"]) for p in x]
        raw = [float((np.tanh(c @ w["v"] + w["v0"]) / (1 + np.exp(-(c @ w["u"] + w["u0"])))) @ w["g"]) for c in codes]
        share = np.exp(np.array(raw) - max(raw))
        share /= share.sum()
        pooled = sum(a * c for a, c in zip(share, codes))
        assert float(net.score(x, bags)[0]) == pytest.approx(float(1 / (1 + np.exp(-(pooled @ w["c"] + w["c0"][0])))), rel=1e-6)


def test_clashing_columns_of_labels_and_documents(spark):
    frame, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    clash = lambda x: x.withColumn("label", F.lit("x")).withColumn("score", F.lit("y")).withColumn("encoded", F.lit(1)).withColumn("remainder", F.lit(2))
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        a, b = ({r.doc_id: r.score for r in score(x.select("doc_id", "text"), fit(x, y)).collect()} for x, y in ((frame, labels), (clash(frame), clash(labels))))
        assert a == b


def test_scores_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a" * 300_000), (5, "word " * 50_000), (None, "x"), (1, None)]
    frame = docs(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(1, 5)], "doc_id long, quality int, toxic int")
    for net, score in ((quality.fit_quality(frame, labels), quality.score_quality), (toxicity.fit_toxicity(frame, labels), toxicity.score_toxicity)):
        got = score(frame.select("doc_id", "text"), net).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got) and score(frame.select("doc_id", "text").limit(0), net).count() == 0
    none = labels.limit(0)
    assert {r.score for r in quality.score_quality(frame, quality.fit_quality(frame, none)).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(frame, toxicity.fit_toxicity(frame, none)).collect()} == {0.0}


def test_lang_and_source_do_not_matter(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    other = frame.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        a, b = ({r.doc_id: r.score for r in score(x, fit(x, labels)).collect()} for x in (frame, other))
        assert a == b


# ---- 4 mixing


def test_shares_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("d0", "en", "a", 100), ("d0", "en", "b", 1000), ("d0", "de", "a", 1000), ("d1", "en", "a", 10)], "domain string, lang string, source string, tokens long").withColumn("n_docs", F.lit(1))
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, 1000.0, {"domain": {"d1": 0.5}}, 1).collect()}
    # d1 can use 10 of its 333; d0 gets 990, its languages 495 each; source a can use 100 of its 247
    assert got == {("d0", "en", "a"): 100, ("d0", "en", "b"): 395, ("d0", "de", "a"): 495, ("d1", "en", "a"): 10}
    all_of_it = {r.budget for r in mixing.budgets(leaves, 1e9, {}, 2).where("domain = 'd0' AND lang = 'de'").collect()}
    assert all_of_it == {2000}


def test_mixing_against_its_sql_and_prefixes(spark):
    import duckdb

    rng = random.Random(2)
    rows = [(rng.choice([k, k, None]), rng.choice([None, "", noise(rng, rng.randint(1, 40))]), rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "src4", "odd", None]), 0) for k in range(4000)]
    rows += rows[:50]
    frame = spark.createDataFrame(rows, DOCS)
    keyed = mixing.keyed(frame)
    got = mixing.mixed(keyed, mixing.plan(keyed)).select("doc_id", *mixing.LEVELS, "epoch", "n_tokens").toPandas()
    c = duckdb.connect()
    c.register("documents", frame.toPandas().astype({"doc_id": "Int64"}))
    want = c.execute(mixing.OP4_SQL).df()
    flat = lambda f: sorted(map(repr, f[sorted(f.columns)].astype(object).where(f[sorted(f.columns)].notna(), None).values.tolist()))
    assert [x.replace(".0", "") for x in flat(got)] == [x.replace(".0", "") for x in flat(want)]
    # many slots and groups of them, clashing columns, a very long text: the same rule
    import unittest.mock

    long_rows = frame.unionByName(spark.createDataFrame([(77_777, "w " * 200_000, "en", "src0", 0)], DOCS))
    clash = long_rows.withColumn("domain", F.lit("x")).withColumn("n_tokens", F.lit(1)).withColumn("digest", F.lit("y")).withColumn("key", F.lit(2)).withColumn("slot", F.lit(3)).withColumn("epoch", F.lit(4))
    with unittest.mock.patch.multiple(mixing, SLOT=20, GROUP=7):
        keyed = mixing.keyed(clash)
        fine = mixing.mixed(keyed, mixing.plan(keyed)).select("doc_id", *mixing.LEVELS, "epoch", "n_tokens").toPandas()
    c.register("documents", long_rows.toPandas().astype({"doc_id": "Int64"}))
    assert [x.replace(".0", "") for x in flat(fine)] == [x.replace(".0", "") for x in flat(c.execute(mixing.OP4_SQL).df())]
    empty = mixing.keyed(frame.limit(0))
    assert mixing.mixed(empty, mixing.plan(empty)).count() == 0


# ---- 5 decontamination


def test_tiles_catch_reordered_passages(spark):
    rng = random.Random(4)
    item = noise(rng, 60).split()
    moved = item[40:] + item[:20] + item[20:40]
    rows = [(1, noise(rng, 100) + " " + " ".join(item).upper() + ", " + noise(rng, 50)), (2, noise(rng, 30) + " " + " ".join(moved) + " " + noise(rng, 9)), (3, noise(rng, 200)), (4, " ".join(item[:20]) + " " + noise(rng, 100)), (5, None), (6, ""), (1, " ".join(item))]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, "too short"), (10, noise(rng, 40))], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, round(r.coverage, 2)) for r in decontamination.contaminated(docs(spark, rows), bench).collect())
    assert got == [(1, 7, 1.0), (1, 7, 1.0), (2, 7, 1.0)]
    blocks = decontamination.contaminated(docs(spark, rows), bench, block=64)
    assert sorted((r.doc_id, r.item_id) for r in blocks.collect()) == [(1, 7), (1, 7), (2, 7)]
    assert decontamination.contaminated(docs(spark, rows), bench.limit(0)).count() == 0


def test_short_items_match_whole(spark):
    bench = spark.createDataFrame([(1, "Too short"), (2, "a b c d"), (3, "too short!"), (4, "東京都庁"), (5, ""), (6, None), (7, "b c d e f")], "item_id long, text string")
    rows = [(1, "it is (too SHORT), too short"), (2, "too"), (3, "short"), (4, "x a b c d, e"), (5, "東京都庁"), (6, "a b c"), (7, None), (8, "b c d e f")]
    got = sorted((r.doc_id, r.item_id, r.coverage, r.n_tiles) for r in decontamination.contaminated(docs(spark, rows), bench).collect())
    assert got == [(1, 1, 1.0, 1), (1, 3, 1.0, 1), (4, 2, 1.0, 1), (5, 4, 1.0, 1), (8, 7, 1.0, 1)]


def test_tiles_against_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(5, 40))] for _ in range(2))
        x, y = (np.array([ord(c) for c in v], np.uint64) for v in (a, b))
        pairs = np.array([(i, j) for i in range(len(a) - 4) for j in range(len(b) - 4) if a[i : i + 5] == b[j : j + 5]], np.int64).reshape(-1, 2)
        if not len(pairs):
            continue
        tiles = decontamination.tile(x, y, pairs)
        used_a, used_b = set(), set()
        for i, j, n in tiles:
            assert a[i : i + n] == b[j : j + n] and n >= 5 and not used_a & set(range(i, i + n)) and not used_b & set(range(j, j + n))
            used_a |= set(range(i, i + n))
            used_b |= set(range(j, j + n))
        longest = max(n for i in range(len(a)) for j in range(len(b)) for n in range(1, min(len(a) - i, len(b) - j) + 1) if a[i : i + n] == b[j : j + n])
        assert tiles[0][2] == longest
        assert not any(a[i : i + 5] == b[j : j + 5] and not used_a & set(range(i, i + 5)) and not used_b & set(range(j, j + 5)) for i, j in pairs.tolist())


def brute_tiles(a, b):
    """Greedy string tiling as it is defined: the longest match of unmarked words, again and again."""
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < 5:
            return covered
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False
        covered += n


def test_dense_tiles_are_tiles():
    rng = random.Random(16)
    for _ in range(40):
        a, b = ([rng.choice("aab") for _ in range(rng.randint(5, 30))] for _ in range(2))
        x, y = (np.array([ord(c) for c in v], np.uint64) for v in (a, b))
        assert sum(t[2] for t in decontamination.tile_dense(x, y)) == brute_tiles(a, b)


def test_decontamination_query_against_brute_force(spark, monkeypatch):
    rng = random.Random(14)
    vocabulary = [noise(rng, 1) for _ in range(12)]
    said = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = [(k if k else None, said(rng.randint(5, 14))) for k in range(25)]
    rows = []
    for k in range(60):
        parts = [said(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 2)):
            w = rng.choice(bench)[1].split()
            cut = rng.randint(0, len(w))
            parts += [" ".join(w[cut:] + w[:cut]), said(rng.randint(0, 4))]
        rows.append((rng.choice([k, k, None]), " ".join(parts)))
    items = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("coverage", F.lit(1))
    frame = docs(spark, rows).withColumn("item_id", F.lit("clash")).withColumn("n_tiles", F.lit(0))
    want = sorted(((i, j, round(brute_tiles(b.split(), t.split()) / len(b.split()), 6)) for i, t in rows for j, b in bench if brute_tiles(b.split(), t.split()) >= 0.6 * len(b.split())), key=repr)
    got = decontamination.contaminated(frame, items).collect()
    assert sorted(((r.doc_id, r.item_id, round(r.coverage, 6)) for r in got), key=repr) == want and len(want) > 20 and any(j is None for _, j, _ in want)
    monkeypatch.setattr(decontamination, "PAIRS", 0)
    seeds = decontamination.Seeds.of([i for i, _ in bench], [t for _, t in bench])
    dense = sorted(((rows[k][0], bench[i][0], round(c, 6)) for k, i, c, _ in decontamination.matches(seeds, pa.array([t for _, t in rows]), 0.6)), key=repr)
    assert dense == want


def test_decontamination_of_very_long_repetitive_texts(spark):
    bench = spark.createDataFrame([(1, "na " * 100), (2, "one two three four five six seven")], "item_id long, text string")
    rows = [(1, "na " * 60_000), (2, "x " * 200_000 + "one two three four five six seven"), (3, "na na na")]
    got = sorted((r.doc_id, r.item_id, r.coverage) for r in decontamination.contaminated(docs(spark, rows), bench).collect())
    assert got == [(1, 1, 1.0), (2, 2, 1.0)]


# ---- 6 token files


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.default_vocabulary())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_is_exact():
    rng = random.Random(8)
    bits = ["a", "B", " ", "  ", "\n", " \n", ".", "1", "'s", "é", "<|endoftext|>", "\t", ", ", "²", "\0", "the", "The,"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", "x <|endoftext|", "word " * 200_000 + "end"]
    got = [np.frombuffer(x, np.uint16).tolist() for x in token_files.encoder(token_files.default_vocabulary())(texts)]
    assert got == reference_ids(texts) and got[-5] == [50256]


def test_token_files_round_trip(spark):
    rows = [(3, "c and\nmore"), (1, None), (2, "word " * 3000), (None, "first"), (2, "again"), (3, "c and\nmore"), (-5, "")]
    frame = docs(spark, rows).withColumn("start", F.lit("x")).withColumn("n_tokens", F.lit(1)).withColumn("ids_crc32", F.lit(2)).withColumn("part", F.lit(3))
    manifest = token_files.write_token_files(frame, length=16)
    got = token_files.read_token_files(manifest).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for (i, _), ids in zip(order, reference_ids([t or "" for _, t in order]), strict=True):
        ids = [*ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) + [tuple(r) for r in got if r.doc_id is None] == sorted(w for w in want if w[0] is not None) + [w for w in want if w[0] is None]
    for row in manifest.collect():
        reader = token_files.open_sequences(row.file)
        flat = [int(x) for k in range(row.n_sequences) for x in token_files.sequence(reader, k)]
        mask = [bool(x) for b in range(reader.num_record_batches) for x in reader.get_batch(b).column(1).values.to_pylist()]
        assert len(flat) == 16 * row.n_sequences == len(mask) and sum(mask) == row.n_ids and not any(flat[row.n_ids :])
    assert token_files.read_token_files(token_files.write_token_files(docs(spark, []))).count() == 0


# ---- 7 repeats


def brute_repeats(rows, window=35):
    own = [WORD.findall(t or "") for _, t in rows]
    times = Counter(tuple(w[i : i + window]) for w in own for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, own, strict=True):
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if times[tuple(w[k : k + window])] > 1:
                keep[k : k + window] = [False] * window
        left = [x for x, y in zip(w, keep, strict=True) if y]
        out.append((i, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_against_brute_force(spark):
    rng = random.Random(3)
    base, rows = [f"w{i}" for i in range(40)], []
    for i in range(300):
        x = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                at = rng.randint(0, 3)
                x += base[at : at + rng.randint(30, 40)]
            elif kind < 0.6:
                x += ["r"] * rng.randint(1, 60)
            else:
                x += [f"u{rng.randint(0, 9)}" for _ in range(rng.randint(0, 50))]
        rows.append((rng.choice([i, i, i, 1, None]), rng.choice([" ", "\n ", "\t"]).join(x) if rng.random() < 0.97 else None))
    rows += rows[:3]
    got = repeats.remove_repeats(docs(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows)
    assert repeats.remove_repeats(docs(spark, [])).count() == 0


def test_repeats_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, repeats.op7_repeats(spark, FOLDER).collect()), key=repr) == brute_repeats(rows)


def test_repeats_of_long_texts_and_clashing_columns(spark):
    rng = random.Random(19)
    shared = noise(rng, 50)
    rows = [(1, noise(rng, 30_000) + " " + shared + " " + noise(rng, 9)), (2, shared), (3, "same " * 5000)]
    clash = docs(spark, rows).withColumn("part", F.lit("x")).withColumn("range", F.lit(1)).withColumn("n_words", F.lit(2)).withColumn("kept_sha256", F.lit(3))
    got = repeats.remove_repeats(clash).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows)


def test_clashing_columns_and_long_texts_of_pairs_and_neighbours(spark, tmp_path):
    rng = random.Random(20)
    long = noise(rng, 20_000)
    rows = [(1, long), (2, long + " more"), (3, noise(rng, 40)), (4, None)]
    clash = docs(spark, rows)
    for name in ("key", "label", "rep", "class_id", "bucket", "samples", "tie", "rn", "borrowed", "digests", "fingerprint"):
        clash = clash.withColumn(name, F.lit("x"))
    assert {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(clash).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    clash.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.op9_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == 4 and got[1].near_next > 0.95 and got[1].n_chars == len(long)


def test_a_sample_of_labels_is_bounded_in_rows_and_bytes(spark):
    frame = docs(spark, [(1, f"text {k}") for k in range(500)] + [(2, "w " * 700_000), (3, "short")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    from foldmark.llm import labelled

    got = labelled.sample(frame, labels, "toxic", F.lit(True), {0: 5, 1: 5}, toxicity._encode)
    assert len(got) <= 10 and max(len(b) for _, b in got) <= labelled.MOST_BYTES


# ---- 9 fingerprints


def _xx(spark, *rows):
    """xxhash64 of each row of values, as Spark defines it."""
    kind = "k int, d string" if len(rows[0]) == 2 and isinstance(rows[0][0], int) else None
    frame = spark.createDataFrame(rows, kind) if kind else spark.createDataFrame(rows)
    return [r[0] for r in frame.select(F.xxhash64(*frame.columns)).collect()]


def brute_fingerprint(spark, text):
    lines = [p for p in text.split("\n") if p.strip(" ")]
    wide, lanes = [0] * fingerprints.WIDE, [0] * fingerprints.LANES
    asked = [(k, hashlib.sha256(p.encode()).hexdigest()) for p in lines for k in range(fingerprints.WIDE)]
    for (k, _), h in zip(asked, _xx(spark, *asked) if asked else []):
        wide[k] = (wide[k] + (h & (1 << 60) - 1)) % (1 << 60)
    words = [p.split(" ") for p in lines]
    units = [tuple(w[j : j + 3]) for w in words for j in range(len(w) - 2)]
    hashes = (_xx(spark, *units) if units else []) + (_xx(spark, *[(" ".join(w),) for w in words if len(w) < 3]) if any(len(w) < 3 for w in words) else [])
    if hashes:
        frame = spark.createDataFrame([(h,) for h in hashes], "h long")
        for h, h1 in ((r.h, r.h1) for r in frame.select("h", F.xxhash64("h", F.lit(1).cast("long")).alias("h1")).collect()):
            for j in range(fingerprints.LANES):
                word, place = (h, h1)[j // 60], j % 60
                lanes[j] += 1 if word % (1 << 64) >> (place // 3 + 20 * (place % 3)) & 1 else -1
    return "".join(f"{x:015x}" for x in wide) + "".join(f"{x % (1 << 32):08x}" for x in lanes)


def brute_likeness(a, b):
    if a == b:
        return 1.0
    cut = fingerprints.WIDE * 15
    u, v = ([(int(f[k : k + 8], 16) + (1 << 31)) % (1 << 32) - (1 << 31) for k in range(cut, len(f), 8)] for f in (a, b))
    norm = math.sqrt(sum(x * x for x in u)) * math.sqrt(sum(x * x for x in v))
    return min(1.0, max(0.0, sum(x * y for x, y in zip(u, v, strict=True)) / norm)) if norm else 0.0


def test_ranges_are_even_whatever_the_ids(spark):
    rng = random.Random(4)
    ids = [2**62, -(2**63), 2**63 - 1] + list(range(20_000)) + [10**12 + k for k in range(9000)] + [77] * 15_000 + [None] * 10_000
    rng.shuffle(ids)
    rows = spark.createDataFrame([(i, str(k)) for k, i in enumerate(ids)], "doc_id long, text string").withColumn("tie", F.xxhash64("text"))
    bucket, ranges = fingerprints.range_of(rows, 100)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.tie, r.b) for r in rows.withColumn("b", F.expr(bucket)).collect()))
    assert [g[3] for g in got] == sorted(g[3] for g in got) and got[-1][3] < ranges
    assert max(Counter(g[3] for g in got).values()) < 1000


def test_fingerprint_columns(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = {r.doc_id: r for r in fingerprints.op9_fingerprints(spark, FOLDER).collect()}
    same = defaultdict(set)
    for k, (i, text) in enumerate(rows):
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        same[text].add(r.fingerprint)
        same[edited].add(r.edited_fingerprint)
    assert all(len(v) == 1 for v in same.values()) and len({next(iter(v)) for v in same.values()}) == len(same)
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.95
    # fingerprints and likeness anew, in plain Python, from the text alone
    whole = lambda t: brute_fingerprint(spark, t)
    for k in range(0, len(rows), 40):
        i, text = rows[k]
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        r, (own, edit, other) = got[i], (whole(t) for t in (text, text[: len(text) - half] + nxt[:half], nxt))
        assert r.fingerprint == own and r.edited_fingerprint == edit
        assert r.near_edited == pytest.approx(brute_likeness(own, edit)) and r.near_next == pytest.approx(brute_likeness(own, other))
    # the likeness follows the share of common word triples
    triples = lambda t: Counter(x for p in t.split("\n") if p.strip() for w in [p.split(" ")] for x in ([tuple(w[j : j + 3]) for j in range(len(w) - 2)] or [tuple(w)]))
    dot = lambda a, b: sum(v * b[x] for x, v in a.items())
    off = []
    for k, (i, text) in enumerate(rows[:-1]):
        a, b = triples(text), triples(text[: len(text) - len(text) // 2] + rows[k + 1][1][: len(text) // 2])
        if a and b:
            off.append(got[i].near_edited - dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)))
    assert np.sqrt(np.mean(np.square(off))) < 0.12 and abs(np.mean(off)) < 0.04


def test_fingerprints_add_up(spark):
    x = spark.createDataFrame([(0, "a b c d\ne f g"), (1, "e f g\n\na b c d"), (2, "a b c d"), (3, "e f g"), (4, ""), (5, None)], "k int, t string").withColumn("t", F.coalesce("t", F.lit("")))
    v = {r.k: r for r in fingerprints.vectors(x, "t", ["k"]).collect()}
    add = lambda a, b, m: [(p + q) % m for p, q in zip(a, b, strict=True)]
    assert v[0].strong == v[1].strong == add(v[2].strong, v[3].strong, 1 << 60) and v[0].lanes == [p + q for p, q in zip(v[2].lanes, v[3].lanes, strict=True)]
    assert not any(v[4].strong) and v[4].strong == v[5].strong and not any(v[4].lanes)


def test_neighbours_of_odd_ids(spark, tmp_path):
    rng = random.Random(1)
    ids = [None, 7, 7, -(2**63), 2**63 - 1, -100, 10**15, 5, 6] + [rng.randrange(10**6) for _ in range(1500)]
    rows = [(i, noise(rng, rng.randint(0, 5))) for i in ids] + [(3, None)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprints.op9_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    order = sorted({i: t or "" for i, t in rows if i is not None and [j for j, _ in rows].count(i) == 1}.items())
    sums = {r.doc_id: r.edited_sha256 for r in got}
    every = sorted(i for i in ids + [3] if i is not None)
    text = {i: t or "" for i, t in rows}
    for i, t in order:
        nxt = every[every.index(i) + 1] if every.index(i) + 1 < len(every) else None
        if nxt is not None and every.count(nxt) == 1:
            assert sums[i] == hashlib.sha256((t[: len(t) - len(t) // 2] + text[nxt][: len(t) // 2]).encode()).hexdigest()
    docs(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fingerprints.op9_fingerprints(spark, f"{tmp_path}/none").count() == 0


# ---- 10 personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = {}
    for kind, pattern in BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}
            if good[kind]:
                out[kind].append(m.span())
    return out


def test_base_spans_against_the_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choice("a@@..-12345 +()%x") for _ in range(rng.randint(0, 40)))
        assert brute_spans(text) == pii.base_spans(text)


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "a@" * 100_000, "1." * 150_000, "+1" + " 2" * 100_000, "1 " * 150_000):
        pii.base_spans(text)


def test_pii_adds_spans_and_keeps_base(spark):
    card = "4111 1111 1111 1111"
    rows = [(1, f"mail john [at] site [dot] com, card {card}, 1.2.3.4 and a.b@c.de"), (2, None), (3, ""), (4, "call (415) 555-1234 now"), (5, "é +49 (30) 1234-5678 x"), (5, "plain")]
    frame = docs(spark, rows)
    clash = frame.withColumn("spans", F.lit("x")).withColumn("n_email", F.lit(9)).withColumn("who", F.lit(1)).withColumn("x", F.lit(1))
    got = sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) for r in pii.find_pii(clash).collect())
    text = rows[0][1]
    assert got[0][:5] == (1, 1, 1, 1, 0) and got[0][5].startswith("email:5:29,") and f"card:{text.index(card)}:{text.index(card) + 19}" in got[0][5]
    assert got[1][5] == got[2][5] == "" and got[3][1:5] == (0, 0, 0, 0) and got[3][5] == "phone:5:19" and got[5][5] == "phone:2:20"
    assert pii.redact(text, got[0][5]) == "mail [email], card [card], [ip] and [email]"
    assert pii.find_pii(docs(spark, [])).count() == 0
    # without the trees the spelled-out address and the national number are missed
    assert [len(pii.find(t, None)[1]) for _, t in rows if t] == [3, 0, 1, 0]


def test_pii_query_against_brute_force(spark):
    """Counts and digest from the contract's patterns; all spans from scoring every candidate and taking the best first."""
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    fitted = pii.fit_pii(frame)
    got = {r.doc_id: r for r in pii.op10_pii(spark, FOLDER).collect()}
    assert len(got) == frame.count()
    for r in frame.collect():
        text, mine = r.text or "", got[r.doc_id]
        base = brute_spans(text)
        flat = sorted(((s, e, k) for k in BASE for s, e in base[k]), key=lambda c: (c[0], list(BASE).index(c[2])))
        assert mine.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in flat).encode()).hexdigest()
        assert [mine[f"n_{k}"] for k in BASE] == [len(base[k]) for k in BASE]
        want, left = list(flat), []
        for c in pii.candidates(text):
            left.append((-float(fitted.trees.proba(np.array([pii.features(text, *c)]))[0]), c[1] - c[2], c))
        for p, _, (k, s, e) in sorted(left):
            if -p >= fitted.limits[k] and not any(a < e and s < b for a, b, _ in want):
                want.append((s, e, k))
        want.sort(key=lambda c: (c[0], list(BASE).index(c[2])))
        assert mine.spans == ",".join(f"{k}:{s}:{e}" for s, e, k in want) and mine.n_added == len(want) - len(flat)


def test_pii_precision_and_recall_by_kind(spark):
    found = {r.kind: r for r in pii.quality_by_kind(pii.fit_pii(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")), spark).collect()}
    assert set(found) == set(pii.KINDS)
    assert all(r.precision >= 0.98 and r.recall >= 0.9 and r.n_positive >= 50 and r.n_negative >= 50 for r in found.values())


def test_pii_in_respelled_documents(spark):
    """Base spans of real documents, respelled where they stand, are found again; look-alikes are left."""
    fitted = pii.fit_pii(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rng, hit, n = random.Random(77), 0, 0
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 4 = 1").collect():
        for kind, spans in pii.base_spans(r.text).items():
            for s, e in spans[:1]:
                put = pii.respelled(rng, kind, r.text[s:e])
                near = r.text[max(0, s - 90) : s] + put + r.text[e : e + 90]
                at = min(s, 90)
                if any(a < at + len(put) and at < b for v in pii.base_spans(near).values() for a, b in v):
                    continue
                n += 1
                hit += any(a < at + len(put) and at < b and k == kind for a, b, k in pii.find(near, fitted)[1])
    assert n > 100 and hit / n >= 0.9
    for text in ("isbn 978-3-1614-8410-0", "on 12.03.2021 and 2020-12-24", "version 1.2.3", "see me at home. Then go", "we meet @ noon. Bye", "serial 1234.5678.9012.3456", " ".join(map(str, range(1, 60)))):
        assert pii.find(text, fitted)[1] == []


def test_pii_of_very_long_texts(spark):
    texts = ["12 34 " * 40_000, "1 2 " * 50_000, "a at b dot " * 10_000, "call (415) 555-1234 " * 20_000]
    got = sorted((r.doc_id, r.n_added) for r in pii.find_pii(docs(spark, list(enumerate(texts)))).collect())
    assert got[1] == (1, 0) and got[3] == (3, 20_000)


def test_boosting_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((boosting.fit(x[:600], y[:600]).proba(x[600:]) > 0.5) == y[600:]).mean() > 0.9
