"""Page extraction and embedding links on small tables."""

import math
import random

import numpy as np
import pytest

from paytrail.llm import embeddings, pages


def extract(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id bigint, url string, html string, host string, path int")
    return {r.page_id: r for r in pages.extract_pages(df).collect()}


def own_lines(html):
    return [x.text for x in pages.lines_of(html) if x.zone == pages.ARTICLE]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<nav>menu</nav><article><h1>T &amp;amp; x</h1><p>a\n  b</p></article><footer>f</footer>", ["T &amp; x", "a b"]),
        ("<article><p>one<p>two<br>three<ul><li>x<li>y</ul></article>", ["one", "two three", "x", "y"]),
        ("<article><p>a<script>var t='</p>';</script>b</p><style>p{}</style></article>", ["a b".replace(" ", "")]),
        ("<article><p>in</p><aside>side</aside><div class='ad'>buy</div><form>f</form><p>out</p></article>", ["in", "out"]),
        ("<article><p>in</p><div class='cookie-notice'><p>ok?</p></div><section id=comments><p>hi</p></section></article>", ["in"]),
        ("<article><p>1 &lt; 2 &#233;&nbsp;x</p><!-- <p>no</p> --><p>cut &am", ["1 < 2 é x", "cut &am"]),
        ("<div class='has-sidebar'><article><p>stays</p></article></div>", ["stays"]),
        ("<article><p>a<span class='promo'>ad</span></p><p>b</p></article>", ["a", "b"]),
        ("<article><p title='a > b'>x</p><p", ["x"]),
        ("<article><article class='comment'><p>reader</p></article><p>body</p></article>", ["body"]),
        ("", []),
        (None, []),
    ],
)
def test_article_lines(html, want):
    assert own_lines(html) == want


@pytest.mark.parametrize(
    "html, want",
    [
        ("<html><head><title>t</title><meta charset=utf-8><body><article><p>x</p></article>", ["x"]),
        ("<head><title>t</title><style>p{}</style><article><p>x</p></article>", ["x"]),
        ("<head><script>a</script></head><body><article><p>x</p></article></body>", ["x"]),
        ("<article><p>a<svg><path d=''></p><p>b<svg><text>no</text></svg>c</p></article>", ["a", "bc"]),
        ("<article><canvas id=c><p>a</p><object data=o><p>b</p><template><p>c</p></article>", ["a", "b", "c"]),
        ("<article><p>a</p><noscript><p>no</p></noscript><template><template>no</template>no</template><p>b</p></article>", ["a", "b"]),
    ],
)
def test_elements_without_their_end_tag(html, want):
    assert own_lines(html) == want


def test_shared_lines_go_where_no_article_is_marked(spark):
    def page(*lines):
        return "<body>" + "".join(f"<div>{x}</div>" for x in ("Site name", "Home About", *lines, "All rights reserved")) + "</body>"

    rows = [(k, f"https://h.example/{k:03d}", page(f"title {k}", f"words of page {k}")) for k in range(30)]
    rows.append((99, "https://other.example/1", page("alone")))
    got = extract(spark, rows)
    assert all(got[k].text == f"title {k}\nwords of page {k}" for k in range(30))
    assert got[99].text == "Site name\nHome About\nalone\nAll rights reserved"
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_article_lines_stay_though_neighbours_share_them(spark):
    body = "<nav>m</nav><article><p>quoted everywhere</p><p>own {}</p></article>"
    got = extract(spark, [(k, f"http://h/{k}", body.format(k)) for k in range(5)])
    assert all(r.text == f"quoted everywhere\nown {k}" for k, r in got.items())


def test_copies_do_not_delete_each_other(spark):
    html = "<div>head</div><div>text</div>"
    got = extract(spark, [(1, "http://h/a", html), (2, "http://h/a", html), (3, "http://h/a", html)])
    assert {r.text for r in got.values()} == {"head\ntext"}


def _site_page(*lines):
    return "<body>" + "".join(f"<div>{x}</div>" for x in ("Site name", "Home About", *lines, "All rights reserved")) + "</body>"


def test_copies_and_near_copies_lose_the_template_and_keep_their_body(spark):
    body = [f"sentence {k} of the long article that stands on several pages" for k in range(9)]
    rows = [(k, "http://h/a", _site_page("copied title", "copied words")) for k in range(4)]
    rows += [(10 + k, f"http://h/b{k}", _site_page(f"edited {k}", *body)) for k in range(3)]
    rows += [(20 + k, f"http://h/c{k}", _site_page(f"title {k}", f"words of page {k}")) for k in range(6)]
    got = extract(spark, rows)
    assert {got[k].text for k in range(4)} == {"copied title\ncopied words"}
    assert all(got[10 + k].text == "\n".join([f"edited {k}", *body]) for k in range(3))
    assert all(got[20 + k].text == f"title {k}\nwords of page {k}" for k in range(6))


def test_the_template_goes_at_every_border_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(pages, "PAGES_IN_BLOCK", 8)
    rows = [(k, f"http://h{k % 20:02d}/{k:03d}", _site_page(f"title {k}", f"words of page {k}")) for k in range(40)]
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = extract(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all(got[k].text == f"title {k}\nwords of page {k}" for k in range(40))


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "no url", ""), (3, "http://", "plain & simple"), (None, "http://h/", "<p>x"), (4, None, "<p>" + "long " * 50000)]
    got = extract(spark, rows)
    assert [got[i].text for i in (1, 2, 3, None)] == ["", "", "plain & simple", "x"]
    assert got[4].n_chars == 249999
    assert extract(spark, []) == {}


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            above = row
            row = [0]
            for j, y in enumerate(b):
                row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
        return row[-1]

    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in "ab")
        found = sorted(pages.common_lines(a, b))
        picked = iter(b)
        assert len(found) == length(a, b) and all(a[i] in picked for i in found)


@pytest.mark.parametrize("crowd,block", [(256, 1024), (3, 4)])
def test_embeddings_match_brute_force(spark, monkeypatch, crowd, block):
    monkeypatch.setattr(embeddings, "CROWD", crowd)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 64))
    vectors = []
    for _ in range(600):
        v = base[rng.integers(40)]
        kind = rng.integers(4)
        vectors.append(v if kind == 0 else v * 3 if kind == 1 else v + rng.standard_normal(64) * rng.choice([0.05, 0.12, 0.2]))
    rows = [(i, [float(np.float32(x)) for x in v], int(i % 3)) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: r for r in embeddings.near_embeddings(df).collect()}
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(600) % 3
    link = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(600)
    while True:
        new = np.minimum(comp, np.where(link, comp[None, :], 600).min(axis=1))
        if (new == comp).all():
            break
        comp = new
    assert [got[i].n_links for i in range(600)] == link.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(600)] == comp.tolist()
    assert all(got[i].kept == (comp[i] == i) for i in got)


def test_a_large_group_of_near_copies_takes_no_row_per_pair(spark, monkeypatch):
    """3,000 vectors around one, some beyond the threshold of others, beside lone vectors and another label."""
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(64)
    x = centre + rng.standard_normal((3000, 64)) * np.abs(centre).mean() * rng.uniform(0.02, 0.2, (3000, 1))
    x = np.vstack([x, rng.standard_normal((300, 64)), centre[None, :]])
    label = np.array([1] * 3300 + [2])
    df = spark.createDataFrame([(int(i) - 1500, x[i].tolist(), int(label[i])) for i in range(len(x))], "vec_id bigint, embedding array<double>, label int")
    rows = {}

    def counted(df, name="stage"):
        out = keep(df, name)
        rows[name] = out.count()
        return out

    keep = embeddings.materialized
    monkeypatch.setattr(embeddings, "materialized", counted)
    got = {r.vec_id + 1500: r for r in embeddings.near_embeddings(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    for _ in range(20):
        comp = np.minimum(comp, np.where(link, comp[None, :], len(x)).min(axis=1))
    assert [got[i].n_links for i in range(len(x))] == link.sum(axis=1).tolist()
    assert [got[i].component_id + 1500 for i in range(len(x))] == comp.tolist()
    # filters that are not crowded still pair their members, so rows grow with the vectors, not with the pairs
    assert link.sum() > 8_000_000 and rows["pairs"] < 3000 * embeddings.CROWD and rows["links"] + rows["block-links"] < 12_000


def test_repeated_ids_do_not_link_other_labels(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 2), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1), (4, [0.01, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_embeddings(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 1, 1)]


@pytest.mark.parametrize("dimension", [5, 64, 300])
def test_codes_together_miss_no_pair_at_the_threshold(dimension):
    rng = np.random.default_rng(4)
    missed = np.zeros(embeddings.CODES)
    together = []
    for _ in range(250):
        x, y = rng.standard_normal((2, dimension))
        x /= np.linalg.norm(x)
        y -= x * (x @ y)
        y = 0.98 * x + math.sqrt(1 - 0.98**2) * y / np.linalg.norm(y)
        shared = np.intersect1d(embeddings.decode(x), embeddings.decode(y)) // embeddings.WORDS**2
        free = ~np.isin(np.arange(embeddings.CODES), shared)
        missed += free
        together.append(free[::12][:4].all())
    share = missed / 250
    assert np.exp(np.log(np.maximum(share, 1 / 250)).sum()) < 1e-7
    assert np.mean(together) < share.mean() ** 4 + 0.1  # codes of one rotation are independent too


def test_odd_vectors(spark):
    one = [1.0, 2.0]
    rows = [
        (1, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1),
        (8, [math.inf, 1.0], 1), (9, [math.nan, 1.0], 1), (10, [1.0, 2.0, 0.0], 1), (None, one, 1), (11, [2.0, 4.0], 1), (11, [2.0, 4.0], 1),
        (12, [1e30, 2e30], 1),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "vec_id bigint, embedding array<float>, label int, vector string")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_embeddings(df).collect()]
    assert len(got) == len(rows)
    linked = {1: 4, 2: 4, 11: 4, 12: 4}
    for i, n, c, kept in got:
        assert (n, c) == ((linked[i], 1) if i in linked else (0, i))
        assert kept == (i is None or i == c)
    assert embeddings.near_embeddings(df.where("false")).count() == 0


@pytest.mark.parametrize("copies", [20, 200])
def test_runs_of_near_copies_keep_every_body(spark, copies):
    """Variants of one page that differ in a line, at every place of a block, before pages of another kind."""
    body = "".join(f"<p>Paragraph {i} of the description that all variants share word for word.</p>" for i in range(6))
    menu = "<div>Home of the shop</div>"
    variant = [f"<body>{menu}{body}<p>Variant number {n}</p></body>" for n in range(copies)]
    other = [f"<body>{menu}<p>Some entirely different page about topic {n} and its own long story.</p></body>" for n in range(3)]
    before = [f"<body>{menu}<p>Earlier page {n} with a text that is only its own, quite long.</p></body>" for n in range(pages.PAGES_IN_BLOCK - copies // 2)]
    rows = [(i, f"http://shop.example/{kind}/{i:04d}", html) for kind, part in (("a", before), ("b", variant), ("c", other)) for i, html in enumerate(part)]
    table = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in pages.extract_pages(table).collect()}
    for n in range(len(before), len(before) + copies):
        assert got[n].count("of the description that all variants share") == 6 and f"Variant number {n - len(before)}" in got[n]
    for n in range(len(before) + copies, len(rows)):
        assert "entirely different page" in got[n]


def test_names_inside_an_article_drop_nothing_of_it():
    page = (
        '<article><h2 id="cookies">On biscuits</h2><section id="market-share"><p>Shares rose.</p></section><p class="popup-books">Pop-ups.</p>'
        "<p>Let <math><mi>a</mi><mo>=</mo><msup><mi>b</mi><mn>2</mn></msup><annotation>a=b^2</annotation></math> hold.</p>"
        '<div class="comment-list"><p>First!</p></div><div id="comments"><p>Second!</p></div><div class="ad-slot"><p>Buy</p></div>'
        '<p class="ad">Sale</p><div class="share">Share this</div><p hidden>Secret</p><p>The end.</p></article>'
    )
    assert pages.main_text(pages.lines_of(page), set()) == "On biscuits\nShares rose.\nPop-ups.\nLet a=b2 hold.\nThe end."
