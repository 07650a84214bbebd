import html
import re

import pytest

from cases import CLASH, prose
from quire.llm import queries, wrappers
from quire.llm.htmltree import parse


def page(k, body, extra="", host="a.example.org"):
    return (k, f"https://{host}/p/{k}", f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>if (a<b) x="</p>"</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">We use cookies</div>
<div class=wrap>{body}</div>{extra}<aside>side</aside><form>Name <input></form><footer>&copy; 2024</footer></body></html>""")


def test_planted_templates_go_and_content_stays(llm):
    rows = []
    for k in range(12):
        own = f"<article><h1>Title {k}</h1><p>Read our free letter every day</p><p>{prose(k, 30)}</p><p>Shared &amp; true{'' if k > 1 else '!'}</p><p>A <b>bold</b>\n word {k}<br>next</p></article>"
        rows.append(page(k, own, "<section class=comments><p>first!</p></section>"))
    rows += [page(50, f"<article><p>{prose(60, 20)}</p><p>Read our free letter every day</p></article>", host="b.example.org")]
    rows += [(60 + k, "https://c.example.org/x", page(60, f"<article><p>{prose(70, 40)}</p></article>")[2]) for k in range(5)]      # copies only
    got = {r.page_id: r.text for r in wrappers.extract(llm.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(12):
        want = [f"Title {k}", prose(k, 30), *(["Shared & true!"] if k < 2 else ["Shared & true"]), f"A bold word {k} next"]
        lines = got[k].split("\n\n")
        assert "Read our free letter every day" not in lines and "first!" not in lines
        assert [x for x in lines if not x.startswith("Shared")] == [x for x in want if not x.startswith("Shared")]
    assert "Read our free letter every day" in got[50]
    assert all(got[60 + k] == prose(70, 40) for k in range(5))


def test_table_against_a_plain_reading_of_the_articles(llm, sf):
    raw = {r.page_id: r for r in llm.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.QUERIES["op10_wrappers"](llm, sf).collect()
    assert len(rows) == len(raw)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", raw[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == raw[r.page_id].url


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_hot_host_is_answered_alike_by_both_joins(llm, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(wrappers, "BROADCAST_BYTES", -1)
    rows = [page(k, f"<p>Always the same line</p><p>{prose(k, 25)}</p>") for k in range(80)]
    got = wrappers.extract(llm.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == {k: prose(k, 25) for k in range(80)}


def test_edges(llm):
    bad = "<div><p>one <b>two<p>three</div></article><ul><li>x<li>y</ul>&am &amp &#65; &nbsp; end <a title='a>b'>link</a> <a title=\"open>text"
    rows = [(1, None, bad), (2, "nonsense", None), (3, "http://h.org", ""), (3, "http://h.org", ""), (4, "http://h.org/x", "plain < text > here"), (None, "http://h.org/y", "<p>k</p>"),
            (5, "http://u@H.org:80/z", "<p>" * 3000 + "deep"), (6, "http://h.org/q", "<div>" * 3000 + "deep" + "<table><tr><td>1<td>2<tr><td>3</table>")]
    frame = llm.createDataFrame([(*r, *["z"] * len(CLASH)) for r in rows], ", ".join(["page_id long", "url string", "html string", *[f"{c} string" for c in CLASH]]))
    got = {}
    for r in wrappers.extract(frame).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1][0].startswith("one two\n\nthree\n\nx\n\ny\n\n&am & A end link")
    assert got[2] == [""] and got[3] == ["", ""] and got[4] == ["plain < text > here"] and got[5] == ["deep"] and got[6] == ["deep\n\n1\n\n2\n\n3"]
    assert wrappers.extract(frame.where("false")).count() == 0


def test_tree_match_is_a_largest_alignment():
    a = wrappers.reduced(parse("<div><h2>a</h2><p>1</p><p>2</p><ul><li>x</ul><h3>c</h3></div>"))
    b = wrappers.reduced(parse("<div><p>1</p><h2>z</h2><p>5</p><h3>c</h3><ul><li>x</ul></div>"))
    pairs = {(x.label, y.label) for x, y in wrappers.tree_match(a[0], b[0])}
    assert pairs == {("#root.", "#root."), ("div.", "div."), ("h2.", "h2."), ("p.", "p."), ("ul.", "ul."), ("li.", "li.")}


@pytest.mark.parametrize("body,want", [
    ('<article><header class="entry-header"><h1>The title</h1></header><p>Own text</p></article>', ["The title", "Own text"]),
    (f'<div id="content" class="with-sidebar"><p>{prose(1, 20)}</p></div>', [prose(1, 20)]),
    (f'<article><p>One</p><section id="related-work"><h2>Related work</h2><p>{prose(2, 60)}</p></section><p class="notice">Mind this.</p></article>',
     ["One", "Related work", prose(2, 60), "Mind this."]),
    (f'<article><p>A</p></article><div class="post-body"><p>{prose(3, 40)}</p><p>{prose(4, 20)}</p></div>', [prose(3, 40), prose(4, 20)]),
    ('<article><p>Before <span class="ad">buy <b>now</b></span>after</p><p>x <a id="sponsored-1" href=/b>y</a></p></article>', ["Before after", "x"]),
    (f'<article><p>{prose(5, 30)}</p><div class="related"><ul>' + "".join(f"<li><a href=/{k}>{prose(k, 12)}</a>" for k in range(6)) + "</ul></div></article>", [prose(5, 30)]),
    (f'<article><p>{prose(5, 30)}</p><div class="share">Send to a friend</div><div class="comments"><p>{prose(6, 80)}</p></div></article>', [prose(5, 30)]),
])
def test_names_are_hints(body, want):
    assert wrappers.main_text(f"<html><body><nav>Menu</nav>{body}<footer>end</footer></body></html>") == "\n\n".join(want)


def test_the_template_decides_where_nothing_says_article(llm):
    """Hosts without an article element or telling names: two layouts, an empty
    and an odd page of smallest id, more boilerplate than text."""
    def made(k, host, kind):
        menu = "".join(f"<div>Section {i} of the house and its many rooms</div>" for i in range(12))
        own = f"<div><h2>Head {k}</h2><p>{prose(k, 25)}</p></div>"
        if kind:
            return (k, f"http://{host}/{k}", f"<html><body><div class=a>{menu}</div><table><tr><td>{own}</td><td>Always here</td></tr></table></body></html>")
        return (k, f"http://{host}/{k}", f"<html><body><div class=top>Welcome to {host}</div><div class=mid>{own}</div><div class=end>All rights kept by {host}{menu}</div></body></html>")
    rows = [(0, "http://h.org/0", ""), (1, "http://h.org/1", "<html><body><h1>Error 500</h1></body></html>")]
    rows += [made(k, "h.org", k % 2) for k in range(2, 42)]
    got = {r.page_id: r.text for r in wrappers.extract(llm.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[0] == "" and got[1] == "Error 500"
    assert {k: got[k] for k in range(2, 42)} == {k: f"Head {k}\n\n{prose(k, 25)}" for k in range(2, 42)}
    without = {k: wrappers.main_text(page) for k, _, page in rows[2:]}
    assert all(without[k] != got[k] for k in without)                 # only the template tells


def test_a_page_is_parsed_once_for_its_text(llm):
    """op10's CPU seconds: a page's layout and its text come from one parse where the wrappers are broadcast."""
    rows = [(i, "http://a.b/x", f"<body><article><p>same<p>text {i}</article></body>") for i in range(6)]
    out = wrappers.extract(llm.createDataFrame(rows, "page_id long, url string, html string"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [r.text for r in out.orderBy("page_id").collect()] == [f"text {i}" for i in range(6)]
