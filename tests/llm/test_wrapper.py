import random

from pyspark.sql import types as T

from ratecast.llm import wrapper as W

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def page(rng, k, body="article"):
    def say(n):
        return " ".join(rng.choice(["red", "blue", "stone", "river", "cloud", f"n{k}"]) for _ in range(n))

    paragraphs = [say(rng.randint(5, 30)) for _ in range(rng.randint(1, 8))]
    article = f"<h1>{say(4)}</h1>" + "".join(f"<p>{p} &amp; <b>more</b></p>" for p in paragraphs)
    html = (f"<!DOCTYPE html><html><head><title>t {k}</title><style>p{{}}</style><script>if (a<b) '</p>'</script></head><body>"
            f"<header><h2>Site</h2></header><nav><ul><li><a href='/{k}'>{say(1)}</a></li></ul></nav>"
            f"<div class='cookie-notice'>We use {say(2)}</div><div id=\"sidebar\"><p>{say(9)}</p></div>"
            f"<{body}>{article}<p>Read our newsletter today</p></{body}><form><p>{say(3)}</p></form>"
            f"<section class='comments'><p>{say(12)}</p></section><!-- c --><div class='ad'>{say(4)}</div><footer>&copy; {say(3)}</footer></body></html>")
    heading = article[4:article.index("</h1>")]
    return html, "\n".join([heading, *[f"{p} & more" for p in paragraphs]])


def test_template_is_induced_and_slots_are_kept():
    rng = random.Random(1)
    for body in ("article", "div"):
        made = [page(rng, k, body) for k in range(12)]
        assert W.induce([h for h, _ in made]) == [t for _, t in made]


def test_copies_are_no_evidence():
    rng = random.Random(2)
    html, text = page(rng, 1)
    made = [page(rng, k) for k in range(3)]
    got = W.induce([html] * 9 + [h for h, _ in made])
    assert got[-3:] == [t for _, t in made] and got[0] == text


def test_template_longer_than_the_article_goes():
    notice = " ".join(f"boilerplate{i}" for i in range(80))
    for inside in (True, False):
        art = ("<article>", "</article>") if inside else ("", "")
        pages = [f"<html><body>{art[0]}<div>{notice}</div><p>own text {k}</p><div>{notice} end</div>{art[1]}</body></html>" for k in range(6)]
        assert W.induce(pages + pages[:1] * 5) == [f"own text {k}" for k in [*range(6), *[0] * 5]]


def test_markup():
    cases = {
        "<p>a<p>b": "a\nb", "<article><p><b>x<br><p>y</article>tail": "x\ny", "<div>one<div>two</div>three</div>": "one\ntwo\nthree",
        "a &lt;b&gt; &#233; &eacute; &nbsp;c": "a <b> é é c", "<p>un\n  clean \t white</p>": "un clean white", "": "", "no markup < at all": "no markup < at all",
        "<main><p>in</p></main><p>out</p>": "in", "<article><header><h1>T</h1></header><p>b</p></article>": "T\nb",
        "<p>x<script>y</script>z</p>": "xz", "<!-- <p>c</p> --><p>d": "d", "<ul><li>1<li>2</ul>": "1\n2", "</div></p><p>e": "e",
        "<article><p>k</p><div class='comments'>no</div></article>": "k", "<article": "", "<p title='a>b'>q": "q",
        "<table><tr><td>1<td>2<tr><td>3</table>": "1\n2\n3", "<P>UP</P>": "UP", "<article><aside>a</aside><p>b</article>": "b",
    }
    for html, want in cases.items():
        assert W.induce([html]) == [want], html


def test_simple_tree_matching():
    tree = lambda s: W.parse(s)
    a, b = tree("<div><p>1</p><ul><li>a</li><li>b</li></ul><p>2</p></div>"), tree("<div><ul><li>a</li></ul><p>2</p><p>3</p></div>")
    assert W.match(a, b, {}) == 5  # root, div, ul, li, p
    pairs = [(p.tag, q.tag) for p, q in W.align(a, b, {})]
    assert len(pairs) == 5 and all(x == y for x, y in pairs)
    assert W.match(a, a, {}) == a.size == 7


def test_query_edge_cases(spark):
    deep = "<div>" * 3000 + "<p>deep" + "</div>" * 3000
    rng = random.Random(3)
    made = [page(rng, k) for k in range(150)]
    rows = [(k, "http://hot.example/x", h) for k, (h, _) in enumerate(made)]
    rows += [(1000, None, None), (1001, "no scheme", ""), (1002, "http://b/", deep), (1002, "http://b/", deep), (None, "http://c", "<p>z"),
             (1003, "http://d", "<p>" + "long " * 200000)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' as host", "'y' as text", "1 as n_chars")
    got = [(r.page_id, r.text, r.n_chars) for r in W.extract(df).collect()]
    by = dict((i, t) for i, t, _ in got)
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert [by[k] for k in range(150)] == [t for _, t in made]
    assert by[1000] == by[1001] == "" and by[1002] == "deep" and by[None] == "z" and by[1003] == "long " * 199999 + "long"
    assert W.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_template_is_that_of_the_whole_host(spark):
    notice = "<div>A notice on most pages</div>"
    pages = [f"<body>{notice * (k % 8 != 0)}<div>Boilerplate of this host</div><p>own text {k}</p></body>" for k in range(330)]
    pages[0] = "<body><h1>error page</h1></body>"
    rows = [(k, "http://hot.example/x", h) for k, h in enumerate(pages)]
    rows += [(1000 + k, "http://two.example/", f"<body><section><p>{k}</p><ul><li>Terms of the second layout</li></ul></section></body>" if k % 3 == 0
              else f"<body><div><p>{k}</p></div><section><ul><li>list {k}</li></ul></section></body>") for k in range(60)]
    want = {0: "error page", **{k: f"own text {k}" for k in range(1, 330)}}
    want |= {1000 + k: f"{k}" if k % 3 == 0 else f"{k}\nlist {k}" for k in range(60)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.page_id: r.text for r in W.extract(spark.createDataFrame(rows, PAGES).repartition(n)).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    made = W.induce(pages)
    assert made == [want[k] for k in range(330)]


def test_menus_below_any_depth_and_telling_names_inside_an_article():
    for n in (10, 110, 30000):
        page = "<article>" + "<div>" * n + "<p>first</p><nav>menu words</nav><p>a</p><p>b</p>" + "</div>" * n + "</article>"
        assert W.induce([page]) == ["first\na\nb"]
    page = """<body><div class="side">gone</div><article><h1 class="banner title">T</h1><p class="side effects">one</p>
              <section id="discussion"><p>two</p></section><div class="share">gone</div><div class="comments"><p>gone</p></div></article></body>"""
    assert W.induce([page]) == ["T\none\ntwo"]


def recipes(n=40):
    """Pages of one host without telling names: a constant footer line in one slot, and an ingredient that most lists have, anywhere."""
    rng = random.Random(5)
    pages, want = [], []
    for k in range(n):
        items = [f"spice {k} {i}" for i in range(rng.randint(6, 12))]
        if k % 10:
            items.insert(rng.randint(0, len(items)), "a pinch of salt")
        pages.append("<body><div>Recipes of the house</div><div><h1>dish {0}</h1><ul>{1}</ul></div><div>All rights reserved</div></body>".format(
            k, "".join(f"<li>{x}</li>" for x in items)))
        want.append("\n".join([f"dish {k}", *items]))
    return pages, want


def test_words_that_change_their_slot_are_no_template(spark):
    pages, want = recipes()
    assert W.induce(pages) == want
    rows = [(k, "http://kitchen.example/x", h) for k, h in enumerate(pages)]
    got = {r.page_id: r.text for r in W.extract(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    assert [got[k] for k in range(len(pages))] == want


def test_skeletons_are_aligned_like_their_trees():
    html = ["<body><div>a</div><ul><li>1<li>2<li>3</ul><nav><p>x</p></nav><p>end", "<body><div>a</div><div>b</div><ul><li>2<li>3</ul><p>end"]
    a, b = (W.parse(h) for h in html)
    x, y = (W.from_skeleton(*W.skeleton(t)) for t in (a, b))
    assert [t.sig for t in W.preorder(a)] == [t.sig for t in W.preorder(x)]
    assert W.slots_of(a, b) == W.slots_of(x, y) and W.match(a, b, {}) == W.match(x, y, {})
    assert W.slots_of(a, a) == {i: i for i in range(a.size)}
