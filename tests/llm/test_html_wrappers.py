import json
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import html_wrappers as H

PAGES = "page_id bigint, url string, html string"


class Article(HTMLParser):
    """Brute force for the test table's pages: the blocks in <article>."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.held = False, [], ""

    def flush(self):
        if self.inside and self.held.split():
            self.blocks.append(" ".join(self.held.split()))
        self.held = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self.flush()
        if tag == "article":
            self.inside = True

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.flush()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        self.held += data


def brute(page):
    a = Article()
    a.feed(page or "")
    a.close()
    return "\n".join(a.blocks)


def test_equals_brute_force(spark, sf_dir, documents):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = sorted((r["page_id"], r["url"], brute(r["html"]), len(brute(r["html"])))
                  for r in pages.collect())
    got = H.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect())) == want and all(w[3] for w in want)


def text_of(*pages, of=0):
    """Text of one page, by the wrapper of all of them."""
    whole = None
    for p in pages:
        w = H.fold(H.parse(p))
        whole = w if whole is None else H.merge(whole, w)
    return H.main_text(pages[of], H.plan(H.Wrapper.load(json.loads(json.dumps(whole.dump())))))


WORDS = "one two three four five six seven eight nine ten".split()


def words(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def div_page(rng, i):
    """A template without article element, names or roles: only the wrapper tells."""
    paras = [words(rng, 40) for _ in range(rng.randrange(2, 6))]
    extra = f"<h2>{words(rng, 3)}</h2>" if i % 2 else ""
    page = (f"<html><body><div><ul>{''.join(f'<li><a href=/{w}>{w} menu</a></li>' for w in WORDS)}</ul>"
            f"</div><div><div><h1>Title {i}</h1>{extra}"
            + "".join(f"<p>{p}</p>" for p in paras) + "</div></div>"
            "<div>All rights belong to us. Read the terms of use of this place.</div></body></html>")
    return page, "\n".join([f"Title {i}"] + ([extra[4:-5]] if extra else []) + paras)


def test_wrapper_tells_article_from_template():
    rng = random.Random(2)
    made = [div_page(rng, i) for i in range(20)]
    pages = [p for p, _ in made]
    for i in range(20):
        assert text_of(*pages, of=i) == made[i][1]


def test_expression_is_union_free():
    a = "<body><h1>A</h1><p>x</p><p>y</p><hr><h2>same</h2></body>"
    b = "<body><h1>B</h1><p>z</p><ul><li>1</li><li>2</li></ul><p>w</p><h2>same</h2></body>"
    w = H.merge(H.fold(H.parse(a)), H.fold(H.parse(b)))
    assert H.expression(w) == ("<body><h1>#</h1>(<p>#</p>(<ul>(<li>#</li>)+</ul>)?(<hr></hr>)?)+"
                               "<h2>text</h2></body>")
    # another order of the same kinds is one repeated group
    x, y = (H.fold(H.parse(f"<div class=q>{s}</div>")) for s in ("<p>a</p><h2>b</h2>", "<h2>b</h2><p>a</p>"))
    assert "(<h2>text</h2><p>text</p>)+" in H.expression(H.merge(x, y))


def test_merge_is_associative_on_what_decides():
    rng = random.Random(5)
    pages = [div_page(rng, i)[0] for i in range(9)]

    def strip(x):
        return [x[:6], {k: strip(c) for k, c in x[7].items()}]

    def folded():
        return [H.fold(H.parse(p)) for p in pages]

    left = folded()
    one = left[0]
    for w in left[1:]:
        one = H.merge(one, w)
    parts = folded()
    two = H.merge(H.merge(parts[8], H.merge(parts[4], parts[7])), H.merge(H.merge(parts[0], parts[3]), H.merge(
        H.merge(parts[1], parts[6]), H.merge(parts[2], parts[5]))))
    assert strip(one.dump()) == strip(two.dump())


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"),
    ("<article><p>a&amp;b &lt;i&gt; &#228;&nbsp;c &am</p></article>", "a&b <i> ä c &am"),
    ("<article>x<script>var t='</p>';</script>y<style>p{}</style><!-- <p>no</p> -->z</article>", "xyz"),
    ("<article><p><b>Bold<br><p>next <i>it</i>al</article><p>out</p>", "Bold\nnext ital"),
    ("<nav>menu</nav><header>top</header><aside>side</aside><div id='cookie-notice'>ok?</div>"
     "<article><header><h1>T</h1></header><form>f</form><p>body</p><footer>tags</footer></article>"
     "<section class='comments'><article class='comment'><p>first!</p></article></section>", "T\nbody"),
    ("<article><p>a <span class='ad'>buy</span> b</p><div class=\"share-box\">share</div><p hidden>h</p>"
     "</article>", "a b"),
    ("<main><div>text in main</div></main><footer>f</footer>", "text in main"),
    ("<div role='navigation'>n</div><div class='postContent'><p>words of it</p></div><p>.</p>",
     "words of it"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul><dl><dt>f<dd>g</dl>"
     "<pre>h\n i</pre></article>", "a\nb\nc\nd\ne\nf\ng\nh i"),
    ("<article><p>cut off in the <a href='/x", "cut off in the"),
    ("<article><p>a < b and <3</p><!-- open", "a < b and <3"),
    ("<article><p title=it's>Don't <i title='a>b' class=\"x\">go</i></p>", "Don't go"),
    ("<article><p>" + "<" * 200000 + "<b>x</b>" * 50000, "<" * 200000 + "x" * 50000),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p></article>", "deep\nafter"),
    ("<article><p>" + "w " * 300000 + "</p></article>", ("w " * 300000).strip()),
])
def test_pages(page, want):
    assert H.main_text(page) == want


def test_odd_rows(spark):
    from ledgerline.llm.storage import ship
    ship(spark)
    page = "<article><p>It is {}</p></article><p>no</p>"
    rows = [(1, "http://A.example/x", page.format(1)), (1, "http://A.example/x", page.format(1)),
            (2, "https://u@a.example:80/", page.format("ä")), (3, None, page.format(3)),
            (4, "no url", ""), (5, "http://b.example", None), (None, "http://b.example?q", "<p>b")]
    df = spark.createDataFrame(rows, PAGES)
    for c in ("host", "part", "wrapper", "id", "at", "text", "n_chars", "_x"):
        df = df.withColumn(c, F.lit(7))
    got = [tuple(r) for r in H.extract(df).collect()]
    texts = {1: "It is 1", 2: "It is ä", 3: "It is 3", 4: "", 5: "", None: "b"}
    assert sorted(map(repr, got)) == sorted(repr((i, u, texts[i], len(texts[i]))) for i, u, _ in rows)
    assert {r["host"] for r in H.wrappers(df).collect()} == {"a.example", "", "b.example"}
    assert H.extract(df.limit(0)).count() == 0


def test_hot_host_merges_in_steps(spark, monkeypatch):
    """One host in every partition, more partitions than merge in one step."""
    rng = random.Random(8)
    made = [div_page(rng, i) for i in range(60)]
    rows = [(i, "http://hot.example/", p) for i, (p, _) in enumerate(made)]
    df = spark.createDataFrame(rows, PAGES).repartition(40)
    assert H.wrappers(df).count() == 1
    assert {r["page_id"]: r["text"] for r in H.extract(df).collect()} == {
        i: t for i, (_, t) in enumerate(made)}
