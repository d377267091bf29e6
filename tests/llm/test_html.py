from textloom.llm import html


def text(page, gone=()):
    return html.main_text(html.lines(page), list(gone))


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="page">
    <header>Top</header><nav><ul><li>Menu</ul></nav><!-- c > d --><div class="ad">Buy</div><div id="cookie-notice">We use</div>
    <article><h1>Head &amp; tail</h1><p><b>Bold</b>er one<br>two&nbsp;three  <form>Mail</form><p>a &lt; b <script>x</script>c<aside>Side</aside>
    <div class="comments"><p>First!</p></div><p title="a > b">fin</article><footer>&copy;</footer></body></html>"""
    assert text(page) == "Head & tail Bolder one two three a < b c fin"


def test_cut_off_and_empty_pages():
    assert text("") == "" and text("plain") == "plain" and text("<p>a<scr") == "a"
    assert text("<article>kept <b>on</b> &am") == "kept on &am"
    assert text("<script>never closed <p>x") == "" and text("a<!-- open") == "a"
    assert text("<div class='shady-lead'>x</div><p class='adverbs'>y") == "x y"


def test_longest_common_subsequence():
    def brute(a, b):
        if not a or not b:
            return 0
        return 1 + brute(a[1:], b[1:]) if a[0] == b[0] else max(brute(a[1:], b), brute(a, b[1:]))

    for a, b in (([1, 2, 3, 4], [2, 4]), ([1, 1, 2, 1], [1, 2, 1, 1]), ([], [1]), ([5, 6, 7], [7, 6, 5]), ([3, 1, 4, 1, 5, 9], [1, 4, 9, 5, 3])):
        got = html.common(a, b)
        assert len(got) == brute(a, b) and got == sorted(got)


def test_pages_without_article_lose_what_neighbours_share(spark):
    page = "<div>Shop</div><div>All goods</div><p>Own text {0}</p><p>More {0}</p><div>Imprint</div>"
    rows = [(i, f"https://h.example/a/{i}?x=1", page.format(i)) for i in range(6)]
    rows += [(10, "https://other.example/z", page.format("z")), (11, None, None), (12, "x", ""), (13, "https://h.example/art", "<div>Shop</div><article>Same words</article>"), (14, "http://h.example/art2", "<div>Shop</div><article>Same words</article>")]
    rows += [(15, "https://twin.example/1", "<article>Twin</article>")] * 2
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, gone string")
    out = sorted(((r.page_id, r.text, r.n_chars) for r in html.extract(df).collect()), key=lambda r: r[0])
    assert out[:6] == [(i, f"Own text {i} More {i}", len(f"Own text {i} More {i}")) for i in range(6)]
    assert [t for _, t, _ in out[6:]] == ["Shop All goods Own text z More z Imprint", "", "", "Same words", "Same words", "Twin", "Twin"]
    assert html.extract(df.limit(0)).count() == 0


def extracted(spark, rows, name="text"):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r[name] for r in html.extract(df).collect()}


def test_differencing_decides_inside_the_story(spark):
    page = "<main><div>Rate this</div><article><h1>T{0}</h1><p>Body {0}</p><p>Quoted</p><div>Follow us</div></article><article><a>Teaser {1}</a></article><article><h2>Other words</h2></article></main>"
    rows = [(i, f"https://h.example/s/{i}", page.format(i, i + 1)) for i in range(5)]
    # what both nearest pages have goes, but prose of the story stays; other articles lose what is met elsewhere
    assert extracted(spark, rows) == {i: f"T{i} Body {i} Quoted" for i in range(5)}
    # one page alone: nothing to compare with
    assert extracted(spark, rows[:1]) == {0: "Rate this T0 Body 0 Quoted Follow us Other words"}
    # what only one other page has stays
    two = [(0, "https://x.example/1", "<article><p>A</p><div>Only these two</div></article>"), (1, "https://x.example/2", "<article><p>B</p><div>Only these two</div></article>"), (2, "https://x.example/3", "<article><p>C</p></article>")]
    assert extracted(spark, two) == {0: "A Only these two", 1: "B Only these two", 2: "C"}


def test_copies_and_print_views_do_not_empty_a_page(spark):
    page = "<div>Shop</div><p>Own text {0}</p><div>Imprint</div>"
    rows = [(i, f"https://h.example/a/{i // 3}?v={i}", page.format(i // 3)) for i in range(9)]
    assert extracted(spark, rows) == {i: f"Own text {i // 3}" for i in range(9)}
    assert extracted(spark, rows[:3]) == {i: "Shop Own text 0 Imprint" for i in range(3)}


def test_large_host_in_pieces_equals_a_plain_loop(spark, monkeypatch):
    import random

    monkeypatch.setattr(html, "PIECE", 16)
    rng = random.Random(4)
    frames = [f"<div>Menu {k}</div><div>Find</div>" for k in range(3)]
    rows = []
    for i in range(150):
        body = "".join(f"<p>line {rng.randrange(40)}</p>" for _ in range(rng.randrange(6)))
        rows.append((i, f"https://{'big' if i % 5 else 'small'}.example/{rng.choice('ab')}/{rng.randrange(60)}", rng.choice(frames) + (f"<article>{body}<div>Share</div></article>" if i % 3 else body) + "<div>Foot</div>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    keys = {r.page_id: (r.k1, r.k2) for r in df.select("page_id", *html._key()).collect()}
    want = {}
    for host in ("big", "small"):
        own = sorted((html.host_path(u)[1], *keys[i], p, i) for i, u, p in rows if f"//{host}." in u)
        shapes = [(path, html.Shape.of(html.lines(p))) for path, _, _, p, _ in own]
        for at, (_, _, _, p, i) in enumerate(own):
            keep = html.kept(shapes[at][1], html.nearest(at, shapes))
            want[i] = " ".join(x.text for x, k in zip(html.lines(p), keep) if k)
    assert extracted(spark, rows) == want
    plain = {i: html.main_text(html.lines(p)) for i, _, p in rows}
    assert sum(plain[i] != want[i] for i in want) > 50


def test_names_markup_and_what_is_left_open():
    assert text('<article><p class="related">a</p><div id="share-price">b</div><div class="banner-year">c</div><div class="share-buttons">x</div><math>y = z</math><svg><text>t</text></svg></article>') == "a b c y = z t"
    assert text("<article><p>a<object>b</article>") == "a b" and text("<nav>Menu<article><p>Story</p></article>") == "Story"
    assert text("<form><p>Label<main><p>Story</p></main></form>") == "Story"
    assert text('<article data-id="comments"><p>kept</p></article>') == "kept"


def test_long_pages_take_linear_time():
    import time

    began = time.time()
    a, b = [1, 2] * 20_000 + list(range(3, 5000)), [2, 1] * 20_000 + list(range(4999, 2, -1))
    assert len(html.common(a, b)) >= 40_000
    page = "<article>" + "<p>one <b>two</b>" * 30_000 + "</article>"
    assert html.main_text(html.lines(page)).count("one two") == 30_000
    assert time.time() - began < 20
