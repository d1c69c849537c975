"""Templates, conversations and page extraction."""

from __future__ import annotations

import hashlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from doclake.llm import chat, html_labeller, templates
from doclake.llm.html_blocks import blocks
from tests.conftest import rows

ODD = "\\### Assistant: </turn> ok"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("\\#</turn>: \nab")))
def test_escapes_are_reversible(text):
    assert templates.unescape(templates.escape(text)) == text
    assert not templates.CONTROL.search(templates.unescape("") + "".join(p for p in templates.escape(text).split("\\\\")).replace("\\###", "").replace("\\</turn>", "")) or "\\" in text


def rendered(source, **values):
    return "".join(t or "" for t, _ in templates.compiled(source)(**values))


def test_template_language():
    assert rendered("a{{ 1 + 2 }}b{{ 'x' ~ y }}", y=4) == "a3bx4"
    assert rendered("{% for m in ms %}{% if m.n > 1 and not m.off %}<{{ m.t | upper }}>{% elif m.n == 1 %}one{% else %}-{% endif %}{% endfor %}",
                    ms=[{"n": 2, "t": "a"}, {"n": 1}, {"n": 0}, {"n": 3, "off": True}]) == "<A>one--"
    marks = list(templates.compiled("x{% generation %}y{{ z }}{% endgeneration %}w")(z=1))
    assert marks == [("x", False), ("y", True), ("1", True), ("w", False)]
    folded = templates.folded_body(templates.parse("a{{ 'b' | upper }}{% if 1 > 2 %}no{% else %}c{% endif %}{{ x }}"))
    assert folded == (templates.Output(templates.Const("aBc")), templates.Output(templates.Name("x")))


@pytest.mark.parametrize("source", ["{% for x in %}{% endfor %}", "{{ a. }}", "{% if a %}", "{% endif %}", "{{ a b }}", "{{ a | nothing }}", "{% for x in y %}{% endif %}", "{{ 'a", "{{ f(1) }}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(templates.TemplateError):
        if rendered(source, a=1, f=2) == source:  # not a tag at all
            raise templates.TemplateError


def test_templates_reach_no_python():
    with pytest.raises(templates.TemplateError):
        rendered("{{ a.__class__ }}", a=object())
    assert rendered("{{ a.__class__ }}", a={}) == ""


def test_conversations_are_read_back(spark):
    turns = [(1, 1, "assistant", ODD), (1, 0, "user", ODD), (2, 0, "user", None), (2, 0, "user", ""), (3, None, None, "x"), (None, 5, "assistant", "y\\"),
             (4, 0, "sys:tem\n\\", "a</turn>b"), (4, 1, "assistant", "###" * 400_000), (4, 2, "assistant", "z" * 1_100_000), (4, 3, "user", "end")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, chunk string")
    formatted = chat.format_conversations(df)
    assert formatted.filter("conv_id = 4").count() > 1  # long conversations come in chunks
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        mine = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)
        loss = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(mine), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<header><h1>Site name</h1></header><nav><ul><li><a href='/x>y'>Menu one</a></li><li><a href=/z>Menu two</a></ul></nav><!-- <p>no</p> -->"
    "<div class=\"ad\">Buy this thing now</div><article><h1>The  heading\n of it</h1><p><b>First para &lt;graph&gt; of the text &#8212; here.<br>More of it."
    "<p>Second paragraph, with <a href=x>a link</a> in it and quite some more words to read.</p></article>"
    "<section class='comments'><div class='comment'><p>I liked reading this a lot, thanks.</p></div></section>"
    "<form><label>Your mail</label><p>Get our letters every week.</p></form><footer>&copy; somebody</footer>"
)


def test_blocks():
    found = [b.text for b in blocks(PAGE)]
    assert found[:4] == ["T & t", "Site name", "Menu one", "Menu two"]
    assert "First para <graph> of the text — here. More of it." in found and "The heading of it" in found
    assert not any("no" == t or "var a" in t for t in found)
    assert blocks("") == [] and [b.text for b in blocks("a < b <p>c")] == ["a < b", "c"]


@pytest.mark.parametrize("page,texts", [
    ("<p>a</p><svg-icon name='x'></svg-icon><p>kept</p>", ["a", "kept"]),
    ("<p>a</p><select-box>b</select-box><p>kept</p>", ["a", "b", "kept"]),
    ("<p>a</p><svg class=i/><p>kept</p><svg viewBox='0'/><p>z</p>", ["a", "kept", "z"]),
    ("<p>a</p><svg class=i><path><p>kept</p><svg><text>no</text></svg>", ["a", "kept"]),
    ("<p>a</p><svg><title>no</title><desc><p>no</p></desc><path d='x'/><text>no</text></svg><p>kept</p>", ["a", "kept"]),
    ("<p>a</p><a title=it's>link</a><p>we don't</p><p>z</p>", ["a", "link", "we don't", "z"]),
    ('<p>a</p><img alt="it><p>z</p>', ["a", "z"]),
    ('<p>a</p><img alt=5" src=x><p>he said "no"</p><p>z</p>', ["a", 'he said "no"', "z"]),
    ("<a title='x>y' b=\"p>q\"c=d>t</a><p>z", ["t", "z"]),
    ("<p>when <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds</p><math/><p>z</p>", ["when x=2 holds", "z"]),
    ("<p>a</p><script src=x />no<p>no</script ><p>z</p>", ["a", "z"]),
    ("<p>a <b", ["a <b"]),
    ("<a<a" * 50_000, ["<a<a" * 50_000]),
])
def test_no_text_is_swallowed(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_gradients_are_slopes():
    rng = np.random.default_rng(0)
    model = html_labeller.Labeller({k: v.astype(np.float64) for k, v in html_labeller.Labeller.fresh(1).weights.items()})
    x, mask = html_labeller.padded([rng.random((n, html_labeller.INPUT)) for n in (4, 2)])
    marks = (rng.random(mask.shape) > 0.5).astype(float)
    _, grad = model.gradients(x, mask, marks)
    for name in ("xf", "hf", "bb", "hb", "o"):
        flat, at = model.weights[name].reshape(-1), int(rng.integers(model.weights[name].size))
        old, losses = flat[at], []
        for step in (1e-3, -1e-3):
            flat[at] = old + step
            losses.append(model.gradients(x, mask, marks)[0])
        flat[at] = old
        assert abs((losses[0] - losses[1]) / 2e-3 - grad[name].reshape(-1)[at]) < 2e-3


def test_extraction(spark):
    pages = [(i, f"u{i}", PAGE.replace("Second", f"Number {i}")) for i in range(30)] + [(40, "n", None), (41, "e", ""), (41, "e", ""), (None, None, "<p></p>"), (42, "l", "<article>" + "<p>words in it</p>" * 5000 + "</article>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    model = html_labeller.train(df, sample=20)
    got = html_labeller.extract(df, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(pages)
    by = {r["page_id"]: r for r in got.collect()}
    want = "The heading of it\nFirst para <graph> of the text — here. More of it.\nNumber 7 paragraph, with a link in it and quite some more words to read."
    assert by[7]["text"] == want and by[7]["n_chars"] == len(want)
    assert by[40]["text"] == by[41]["text"] == by[None]["text"] == "" and by[42]["text"].count("words in it") == 5000
    assert html_labeller.extract(df.limit(0), model).count() == 0
    assert rows(got.filter("page_id = 41").select("n_chars")) == [(0,), (0,)]


class _Article(HTMLParser):
    """The text of a page's article by the standard library's parser, block by block."""

    def __init__(self):
        super().__init__()
        self.inside, self.found = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag == "br":
            self.handle_data(" ")
        elif tag not in ("b", "a", "i", "em", "strong", "span"):
            self.found.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag not in ("b", "a", "i", "em", "strong", "span"):
            self.found.append("")

    def handle_data(self, data):
        if self.inside:
            self.found[-1] += data


def article(page):
    parser = _Article()
    parser.feed(page)
    parser.close()
    return [t for t in (" ".join(f.split()) for f in parser.found) if t]


def test_given_pages_with_and_without_names(spark):
    """Every given page as it is against a plain parser, and with all names and telling elements gone, as ``div`` and as table cells."""
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_labeller.train(table)
    want = {r["page_id"]: article(r["html"] or "") for r in table.select("page_id", "html").collect()}
    cells = {"start": "<table><tr><td>", "end": "</td></tr></table>"}
    for start, end, least in ((None, None, 1.0), ("<div>", "</div>", 0.95), (cells["start"], cells["end"], 0.95)):
        html = F.col("html")
        if start:
            html = F.regexp_replace(html, r"(?i)<(?:article|nav|footer|aside|header|main|section|div)\b[^>]*>", start)
            html = F.regexp_replace(html, r"(?i)</(?:article|nav|footer|aside|header|main|section|div)>", end)
        got = {r["page_id"]: r["text"] for r in html_labeller.extract(table.withColumn("html", html), model).collect()}
        right = found = expected = 0
        for k, text in got.items():
            mine, theirs = Counter(text.split("\n") if text else []), Counter(want[k])
            right += sum(len(t) * n for t, n in (mine & theirs).items())
            found += sum(len(t) * n for t, n in mine.items())
            expected += sum(len(t) * n for t, n in theirs.items())
        assert right >= least * found and right >= least * expected, (start, right, found, expected)
    line = "The river walked slowly under seven green houses, and the people of the town were glad of it. It rained for days. "
    plain = spark.createDataFrame([(1, "u", f"<div><h1>A river</h1><p>{line}</p><p>{line * 2}</p></div>")], "page_id long, url string, html string")
    assert html_labeller.extract(plain, model).first()["text"] == "\n".join(["A river", line.strip(), (line * 2).strip()])
