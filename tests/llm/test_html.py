import random

from tessera.llm.html_blocks import blocks
from tessera.llm.html_text import common_lines, html_text

SCHEMA = "page_id long, url string, html string, id string, text string, host string, shared string"


def lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def test_common_lines_are_longest(monkeypatch):
    r = random.Random(1)
    for k in range(400):
        a, b = ([r.randrange(6) for _ in range(r.randrange(30))] for _ in range(2))
        x, y = common_lines(a, b)
        assert x.sum() == y.sum() == lcs(a, b)
        assert [v for v, s in zip(a, x, strict=True) if s] == [v for v, s in zip(b, y, strict=True) if s]


def test_long_pages_are_halved():
    r = random.Random(2)
    a, b = ([r.randrange(900) for _ in range(2600)] for _ in range(2))
    x, y = common_lines(a, b)
    assert x.sum() == y.sum() == lcs(a, b)
    assert [v for v, s in zip(a, x, strict=True) if s] == [v for v, s in zip(b, y, strict=True) if s]


def main(page):
    return [t for z, t in blocks(page) if z == "main"]


def test_blocks_and_zones():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body class="has-sidebar">
      <header>Top</header><nav><ul><li>M</ul></nav><div id="cookie-notice">C</div><article><header><h1>H &amp;\n one&nbsp;x</h1></header>
      <p>a <b>b</b>\n c<br>d<p>e &lt;x&gt; &#233;<ul><li>f<li>g</ul><table><tr><td>h<td>i</table><form>q</form><div class="comments"><article>no</article></div>
      <!-- <p>z</p> --><p hidden>no</p><p>k</article><aside>s</aside><footer>&copy; f</footer>tail</body>"""
    assert main(page) == ["H & one x", "a b c d", "e <x> é", "f", "g", "h", "i", "k"]
    assert [t for z, t in blocks(page) if z == ""] == ["tail"]


def test_broken_markup():
    assert main("<article><p><b>x<br><p>y</article>z") == ["x", "y"]
    assert main("<article><p>x <i>y") == ["x y"]
    assert main("<article><p>cut <a href='") == ["cut"]
    assert main("<article>a < b & c &am</article>") == ["a < b & c &am"]
    assert blocks("") == [] and blocks("<!-- open") == [] and blocks("<script>open") == []
    assert main("<main>" + "<p>x</p>" * 20_000 + "</main>") == ["x"] * 20_000


def test_articles_are_not_lost_by_loose_markup():
    assert main('<article title="The hidden cost of x"><h2 data-note="display: none">a</h2><p aria-label="aria-hidden=true">b</p></article>') == ["a", "b"]
    assert main("<article><p hidden>x</p><p style='color:red; display:none'>x</p><p aria-hidden=true>x</p><p>k</article>") == ["k"]
    assert main("<form><div>Login</div><article>a</article><div>Send</div></form>") == ["a"]
    for name in ("page sidebar-left", "share", "related", "legal", "notice"):
        assert main(f"<div class='{name}'>x<main>a<div class='{name}'>y</div></main></div><main class='{name}'>b</main>") == ["a", "b"]
    assert main("<div data-id='ad'><article>a<p data-class='ad'>b</article></div>") == ["a", "b"]
    for wrap in ("nav", "aside", "footer", "div class='comments'"):
        assert main(f"<{wrap}><div class='share'><article>no</article></div><form><article>no</article></form></{wrap.split()[0]}>") == []


def page(main_lines, template=True):
    top = "<div>Our shop</div><div>Menu of things</div>" if template else ""
    return f"<html><body>{top}{''.join(f'<div>{x}</div>' for x in main_lines)}<div>Imprint</div></body></html>"


def test_shared_lines_go_where_markup_says_nothing(spark):
    rows = [(k, f"http://h.com/{k}", page([f"only {k} a", f"only {k} b", "Read this too"])) for k in range(6)]
    rows += [(10, "http://single.com/x", page(["alone"])), (11, None, page(["n1 " * 20])), (12, "nohost", page(["n2 " * 20])), (13, "http://h.com/9", None)]
    rows += [(20, "http://m.com/a", page(["same text of some length", "and more of it, line by line"])),
             (21, "http://m.com/b", page(["same text of some length", "and more of it, line by line"]))]
    rows.append(rows[0])
    got = html_text(spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for k in range(6):
        assert text[k] == f"only {k} a\nonly {k} b"
    assert text[10] == "Our shop\nMenu of things\nalone\nImprint"
    assert text[11] == ("n1 " * 20).strip() and text[12] == ("n2 " * 20).strip() and text[13] == ""
    assert "same text of some length" in text[20] and "same text of some length" in text[21]  # copies leave each other alone


def test_articles_of_mirrors_stay(spark):
    art = lambda t, k: f"<nav>menu {k}</nav><article><h1>{t}</h1><p>body of {t}</p></article><footer>f</footer>"
    rows = [(k, f"http://h.com/{k:02d}", art("same" if k < 4 else f"own{k}", k)) for k in range(9)]
    got = html_text(spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)).collect()
    for r in got:
        t = "same" if r.page_id < 4 else f"own{r.page_id}"
        assert r.text == f"{t}\nbody of {t}"


def test_runs_do_not_matter(spark, monkeypatch):
    import tessera.llm.html_text as m
    rows = [(k, f"http://h{k % 2}.com/{k:03d}", page([f"p{k}", f"c{k // 4}", "x"])) for k in range(40)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    one = sorted(tuple(r) for r in html_text(df).collect())
    monkeypatch.setattr(m, "RUN", 3)
    assert sorted(tuple(r) for r in html_text(df.repartition(7)).collect()) == one


def test_copies_are_compared_with_the_nearest_other_page(spark, monkeypatch):
    import tessera.llm.html_text as m
    own = lambda k: [f"one line of article {k}, {x}" * 3 for x in "abcd"]
    rows = [(k, f"http://h.com/{k:03d}", page(own("copied" if 3 <= k < 33 else k))) for k in range(36)]
    rows += [(40, "http://i.com/a", page(["short"])), (41, "http://i.com/b", page(own("long")))]  # the template is most of the short one
    rows += [(50 + k, f"http://j.com/{k}", page(own("all copies"))) for k in range(7)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    for run in (512, 4, 1):
        monkeypatch.setattr(m, "RUN", run)
        got = {r.page_id: r.text for r in html_text(df).collect()}
        for k in range(36):
            assert got[k] == "\n".join(own("copied" if 3 <= k < 33 else k)), (run, k)
        assert got[40] == "short" and got[41] == "\n".join(own("long"))
        assert all(got[50 + k].startswith("Our shop") for k in range(7))  # nothing else to compare with


def test_empty(spark):
    assert html_text(spark.createDataFrame([], SCHEMA)).count() == 0
