"""Top-k search, near-dedup and page text against brute force; edge cases."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spotlattice.llm import components, html_text, near_dedup, topk
from spotlattice.llm.near_dedup import Settings


def vectors(spark, data):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<float>, rank string, score int")


def best(data, every, k):
    ok = [(i, [math.floor(1024 * np.float32(x).item()) for x in v]) for i, v in data if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i is None or i % every:
            continue
        s = [(-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j) for j, v in ok if j != i and len(v) == len(q)]
        for r, (score, _, j) in enumerate(sorted(s, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((i, r, j, -score))
    return sorted(out, key=str)


def cases():
    r = random.Random(2)
    plain = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(700)]
    return {
        "plain": plain,
        "one common vector": [(i, [1.0, 2.0] if i % 3 else [r.random(), r.random()]) for i in range(300)],
        "odd": [(0, [1.0, float("nan")]), (100, None), (200, [None, 1.0]), (300, []), (400, [1.0, 2.0]), (None, [5.0, 5.0]), (7, [1.0, float("inf")]), (8, [0.0, 0.0]), (9, [1.0])],
        "large": [(i, [r.uniform(-1e6, 1e6) for _ in range(3)]) for i in range(120)],
        "repeated": [(100, [1.0]), (1, [3.0]), (1, [3.0]), (2, [3.0])],
        "few": [(0, [1.0]), (1, [1.0])],
        "empty": [],
    }


@pytest.mark.parametrize("name", cases())
def test_top_k(spark, name):
    data = cases()[name]
    got = topk.top_k(vectors(spark, data), every=20 if name == "plain" else 100, k=5, shard_rows=64, leaf=8, block=10).collect()
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=str) == best(data, 20 if name == "plain" else 100, 5)


def test_ball_tree_leaves_nodes_out():
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(0, 1, (500, 4)), r.normal(50, 1, (500, 4))]) * 1000
    seen = []
    q = topk.Queries(np.array([-1]), np.array([[1000, 1000, 1000, 1000]]), 5)
    offer = q.offer
    q.offer = lambda who, ids, rows: (seen.append(len(ids)), offer(who, ids, rows))
    topk.BallTree.of_bytes(topk.BallTree(np.arange(1000), x.astype(np.int64), 32).to_bytes()).search(q)
    assert sum(seen) < 600
    assert set(q.best_ids[0]) == set(np.argsort(-(x.astype(np.int64) @ np.full(4, 1000)), kind="stable")[:5])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, edges):
    root = list(range(26))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {(r.a, r.b) for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {(i, find(i)) for i in range(26) if find(i) != i}


def near_classes(data, s):
    """Classes over distinct word sequences, by all pairs."""
    texts = [(t or "").encode() for _, t in data]
    names = [near_dedup.digest(t) for t in texts]
    u = sorted(set(names))
    h, begin = near_dedup.shingles(texts, s.words)
    sets = {n: np.unique(h[begin[i] : begin[i + 1]], return_counts=True) for i, n in enumerate(names)}
    df = defaultdict(int)
    for n in names:
        for x in sets[n][0].tolist():
            df[x] += 1
    least = max(2, math.ceil(len(data) * s.common))
    scale = math.log(len(data) / least) if len(data) > least else 1.0
    w = {n: {x: c * (1 + s.idf * (1 - (math.log(max(df[x], least) / least) / scale if len(data) > least else 0))) for x, c in zip(k.tolist(), v.tolist(), strict=True)} for n, (k, v) in sets.items()}
    root = {n: n for n in u}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(u)):
        for b in range(a):
            x, y = w[u[a]], w[u[b]]
            both = sum(min(v, y[k]) for k, v in x.items() if k in y)
            if both and both / (sum(x.values()) + sum(y.values()) - both) >= s.similarity:
                p, q = find(u[a]), find(u[b])
                root[max(p, q)] = min(p, q)
    groups = defaultdict(list)
    for (i, _), n in zip(data, names, strict=True):
        groups[find(n)].append(i)
    return groups


def near_corpus(seed=0):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    out, shared = [], [word() for _ in range(60)]
    for _ in range(60):
        base = [word() for _ in range(r.randint(30, 200))]
        for _ in range(r.choice([1, 1, 2, 4])):
            t = list(base)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = word()
            out.append(" ".join(t))
    hot = [word() for _ in range(120)]
    for _ in range(80):  # one large group
        t = list(hot)
        for _ in range(r.randint(0, 2)):
            t[r.randrange(len(t))] = word()
        out.append(" ".join(t))
    out += [" ".join(shared + [word() for _ in range(60)]) for _ in range(20)]  # a passage in common is no near copy
    out += ["one two", "One\ttwo", "", None, "  ", out[0], out[0].upper()]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [512, 16])
def test_near_groups_match_all_pairs(spark, block):
    data, s = near_corpus(), Settings(block=block)
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in data], "doc_id long, text string, digest string, n int, block string").repartition(3)
    got = {r.doc_id: r for r in near_dedup.near_groups(docs, settings=s).collect()}
    groups = near_classes(data, s)
    for ids in groups.values():
        for i in ids:
            assert (got[i].class_id, got[i].class_size, got[i].kept) == (min(ids), len(ids), i == min(ids)), i
    left = near_dedup.drop_near_copies(docs, settings=s)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {min(ids) for ids in groups.values()}


def test_frequent_shingles_weigh_less(spark):
    texts = [f"all of them say this {i} a{i} b{i} c{i} d{i}" for i in range(40)]
    f = near_dedup.count_shingles(spark.createDataFrame([(t.encode(),) for t in texts], "text binary"), 40, Settings())
    h, begin = near_dedup.shingles([t.encode() for t in texts], 5)
    w = [f.weights(h[a:b], np.full(b - a, 3)) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    assert all(np.isclose(x[0], 3.0) and np.allclose(x[1:], 4.5) for x in w)


def test_classes_follow_the_idf(spark):
    """The pair has similarity above 0.8 by counts alone, and below with what every document has weighing less."""
    shared = " ".join(f"s{i}" for i in range(88))
    pair = [f"{shared} " + " ".join(f"{x}{i}" for i in range(10)) for x in "pq"]
    data = list(enumerate(pair + [f"{shared} " + " ".join(f"o{k}x{i}" for i in range(300)) for k in range(60)]))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    of = lambda s: {r.doc_id: r.class_id for r in near_dedup.near_groups(docs, settings=s).collect()}
    assert of(Settings(idf=0.0))[1] == 0
    assert of(Settings())[1] == 1 and len(near_classes(data, Settings())) == len(data)


def test_near_groups_edge_cases(spark):
    schema = "doc_id long, text string"
    assert near_dedup.near_groups(spark.createDataFrame([], schema)).count() == 0
    data = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (5, None), (None, ""), (6, "w " * 50_000), (7, "w " * 50_000 + "x")]
    got = near_dedup.near_groups(spark.createDataFrame(data, schema)).collect()
    assert sorted((r.class_id, r.class_size, r.kept) for r in got) == sorted([(4, 4, True), *[(4, 4, False)] * 3, (5, 2, True), (5, 2, False), (6, 2, True), (6, 2, False)])
    assert near_dedup.drop_near_copies(spark.createDataFrame(data, schema)).filter("doc_id = 6 or doc_id = 5").count() == 2


def test_near_copies_are_found_and_others_left(spark):
    """Some thousand documents: planted copies with a few words changed, measured against the similarity of each pair."""
    r = random.Random(12)
    word = lambda: "".join(r.choices("abcdefghij", k=6))
    data, pairs = [], []
    for _ in range(700):
        base = [word() for _ in range(r.randint(40, 260))]
        own = []
        for _ in range(r.choice([1, 2, 2, 3])):
            t = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
                t[r.randrange(len(t))] = word()
            own.append(len(data))
            data.append((len(data), " ".join(t)))
        pairs += [(a, b) for a in own for b in own if a < b]
    passage = [word() for _ in range(60)]
    data += [(len(data) + i, " ".join([*passage, *[word() for _ in range(50)]])) for i in range(1500)]
    s = Settings()
    df = defaultdict(int)
    raw = [t.encode() for _, t in data]
    h, begin = near_dedup.shingles(raw, s.words)
    sets = [np.unique(h[a:b], return_counts=True) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    for k, _ in sets:
        for x in k.tolist():
            df[x] += 1
    least, total = max(2, math.ceil(len(data) * s.common)), len(data)
    w = [{x: c * (1 + s.idf * (1 - math.log(max(df[x], least) / least) / math.log(total / least))) for x, c in zip(k.tolist(), v.tolist(), strict=True)} for k, v in sets]

    def similarity(a, b):
        both = sum(min(v, w[b][x]) for x, v in w[a].items() if x in w[b])
        return both / (sum(w[a].values()) + sum(w[b].values()) - both)

    got = {x.doc_id: x.class_id for x in near_dedup.near_groups(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect()}
    near = [(a, b) for a, b in pairs if similarity(a, b) >= s.similarity]
    assert len(near) > 200 and sum(got[a] == got[b] for a, b in near) >= 0.99 * len(near)
    sizes = defaultdict(int)
    for c in got.values():
        sizes[c] += 1
    assert all(sizes[got[i]] == 1 for i, _ in data[-1500:]), "a passage in common makes no copy"
    root = list(range(len(data)))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in near:
        root[find(b)] = find(a)
    assert all((got[a] == got[b]) <= (find(a) == find(b)) for a, b in pairs), "pairs below the threshold are no copies"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav class="x"><ul><li><a href="/a">Home</a><li><a>About us, now.</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies, truly.</div>{before}<article><h1>Title &amp; more</h1><p><b>First   para,
with&nbsp;text.<br>Same.<p>Second &lt;p&gt; para; it goes on, and on.</p><div class="ad">Buy, now.</div>
<form><label>Mail, please</label><input></form><aside>Side, note.</aside></article>{after}
<section id="comments"><p>Reader comment, long and with signs, and more.</p></section><footer>&copy; all</footer></body></html>"""


def test_main_text():
    want = "Title & more\nFirst para, with text. Same.\nSecond <p> para; it goes on, and on."
    assert html_text.main_text(PAGE.replace("{before}", "").replace("{after}", "")) == want
    plain = "<body><div class=menu><a>One</a> <a>Two</a></div>" + "".join(f"<div><p>Paragraph {i}, with words, and signs. It is long enough to count.</p></div>" for i in range(5)) + "<div><span><a>x</a></span></div></body>"
    got = html_text.main_text(plain)
    assert got.count("Paragraph") == 5 and "One" not in got and not got.endswith("x")
    for page in (None, "", "<", "<p", "no tags at all, just text.", "<script>x", "<p>a<p>b", "</div></p>x", "<ul><li>a<li>b</ul>", "<p title='a>b'>c"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("no tags at all, just text.") == "no tags at all, just text."
    assert html_text.main_text("<p>a<p>b") == "a\nb"
    assert len(html_text.main_text("<p>" + "word, " * 200_000 + "</p>")) == 1_199_999


def test_names_leave_out_elements_but_not_layouts():
    words = "<p>Long paragraph, with words, and more of them.</p>"
    assert html_text.main_text(f'<div class="content-with-sidebar">{words}</div>').startswith("Long")
    assert html_text.main_text(f'<div class="sidebar-page"><article>{words}</article></div>').startswith("Long")
    assert html_text.main_text(f'<article>{words}</article><article class="comment"><p>Reader, says.</p></article>').count("\n") == 0
    assert html_text.main_text(f'<main>{words}<div id="userComments"><p>No, thanks.</p></div><div class="adSlot">Buy.</div></main>').endswith("them.")
    assert html_text.main_text(f"<aside><article>{words}</article></aside>") == ""


@pytest.mark.parametrize("said", ["for(var i=0;i<n;i++){f(i);}", 'var s="<!--";', "if(a<b){s='x}", 'u="<a href=\'";', "t='</p><p>no, no.';", "x</scripts>y"])
def test_scripts_end_at_their_own_tag(said):
    for tag in ("script", "SCRIPT", "style", "template><script"):
        end = tag.replace("template><script", "script></template")
        got = html_text.main_text(f"<p>Head of it, here.</p><{tag}>{said}</{end}\n><p>Article text, and more.</p><script>y</script><p>The end, too.</p>")
        assert got == "Head of it, here.\nArticle text, and more.\nThe end, too.", tag
    assert html_text.main_text(f"<p>Head, here.</p><script>{said}") == "Head, here."


@pytest.mark.parametrize("around", ["article", "main", "div", "div class='text'"])
def test_lists_and_tables_stay_with_their_text(around):
    para = "Words of a paragraph, and more of them. " * 10
    items = [f"item number {i}" for i in range(6)]
    rows = [[f"name {i}", f"{i} kg"] for i in range(4)]
    table = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in rows)
    menu = "".join(f"<li><a href=/{i}>Go to {i}</a>" for i in range(5))
    body = f"<p>{para}</p><ul>{''.join(f'<li>{x}</li>' for x in items)}</ul><p>{para}</p><table>{table}</table><dl><dt>term<dd>said of it</dl><p>{para}</p><pre>x = 1</pre><p>{para}"
    got = html_text.main_text(f"<body><ul>{menu}</ul><{around}>{body}</{around.split()[0]}></body>").split("\n")
    p = para.strip()
    assert got == [p, *items, p, *[c for row in rows for c in row], "term", "said of it", p, "x = 1", p]


def test_links_leave_a_marked_article():
    article = "<article><h1>Title</h1><div><p>Text of it, here.</p></div><ul>{}</ul></article>".format("".join(f"<li><a href=/{i}>Other page {i}</a>" for i in range(4)))
    assert html_text.main_text(article) == "Title\nText of it, here."


def test_extract_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x, y</p>", "old"), (None, None, None, None), (1, "u", "<p>x, y</p>", "old")], "page_id long, url string, html string, text string")
    got = html_text.extract_pages(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(((r.page_id or 0), r.text) for r in got.collect()) == [(0, ""), (1, "x, y"), (1, "x, y")]
    assert html_text.extract_pages(pages.limit(0)).count() == 0
    assert html_text.extract_pages(pages).withColumn("n", F.length("text")).agg(F.sum("n")).first()[0] == 8


@pytest.mark.parametrize("name", ["post social-science", "ad-free content", "public-notice-board", "share"])
def test_a_class_word_loses_no_article(name):
    words = "".join(f"<p>Paragraph {i} of it, with words, and more of them. It ends.</p>" for i in range(6))
    assert html_text.main_text(f"<body><div class='{name}'>{words}</div><div>Imprint</div></body>").count("Paragraph") == 6


def test_path_ratios_decide():
    """Neither names nor elements tell the boilerplate of these pages: only its paths do."""
    r = random.Random(3)
    said = lambda n: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) + r.choice(["", "", "", ",", "."]) for _ in range(n)) + "."
    right = lost = more = 0
    for _ in range(60):
        paras = [said(r.randint(25, 120)) for _ in range(r.randint(3, 12))]
        menu = "".join(f"<li><a href=/{i}>{said(2)}</a></li>" for i in range(6))
        short = "".join(f"<section><span>{said(2)}</span></section>" for _ in range(4))
        page = f"<body><ul>{menu}</ul><div><h2>{said(4)}</h2>{''.join(f'<p>{x}</p>' for x in paras)}</div>{short}<table><tr><td><a href=x>{said(3)}</a></td></tr></table></body>"
        p = html_text.blocks_of(page)
        score, _ = html_text.path_scores(p)
        assert min(score[[i for i, t in enumerate(p.text) if t in paras]]) > max(score[[i for i, t in enumerate(p.text) if t not in paras]])
        got = html_text.main_text(page).split("\n")[1:]
        right, lost, more = right + len(set(got) & set(paras)), lost + len(set(paras) - set(got)), more + len(set(got) - set(paras))
    assert lost == 0 and more <= 0.01 * right


def test_comments_longer_than_the_article_stay_out():
    article = "".join(f"<p>Paragraph {i} of it, with words, and more of them. It ends.</p>" for i in range(4))
    talk = "".join(f"<p>Reader {i} says so, at length, and with signs. Then more, and more.</p>" for i in range(40))
    for a, b in (("<article>{}</article>", "<div>{}</div>"), ("<div>{}</div>", "<div id=comments>{}</div>"), ("<main>{}<div class='reader-comments'>{}</div></main>", "")):
        got = html_text.main_text("<body>" + (a.format(article, talk) if not b else a.format(article) + b.format(talk)) + "</body>")
        assert got.count("Paragraph") == 4 and "Reader" not in got


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "<p>Hello, you.", "<ul><li>item, x " * 30_000, "<p><button>" + "<b><i>" * 50_000 + "<div>x, y.", "<p>" + "<a href=x>b</a> and, so " * 50_000])
def test_deep_and_long_pages_take_linear_time(page):
    import time

    began = time.time()
    assert isinstance(html_text.main_text(page), str)
    assert time.time() - began < 20
