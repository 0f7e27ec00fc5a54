from html import unescape

import pytest

from tabforge.llm.html import extract_text, visible_text

CASES = {
    "<p>one<p>two": "one\n\ntwo",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "a <b>bold</b>  text<br>next": "a bold text\nnext",
    "<ul><li>x<li>y<ul><li>z</ul></ul>end": "- x\n- y\n  - z\n\nend",
    "<ol start=3><li>x<li value=9>y<li>w</ol>": "3. x\n9. y\n10. w",
    "<ol reversed><li>x<li>y</ol>": "2. x\n1. y",
    "<pre>\n a\n  b</pre>": " a\n  b",
    "<style>.x{display:none} #y, b {visibility:hidden}</style>a<i class='q x'>b</i><i id=y>c</i>d": "ad",
    "<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>": "b",
    "a<span hidden>b</span><span style='display: none'>c</span>d": "ad",
    "<head><title>t</title></head><body>x</body>": "x",
    "<script>if (a<b) '</p>'</script>x<!-- <p>no --> y": "x y",
    "<details><summary>s</summary>hidden</details><details open><summary>s</summary>shown</details>": "s\ns\nshown",
    "x &lt;b&gt; &amp; &copy; &#233;": "x <b> & © é",
    "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>": "a     bbb\ncccc  d",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><caption>Cap</caption><tr><th colspan=2>h<tr><td>x<td>y<td>z</table>": "Cap\nh\nx  y  z",
    "<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>": "a        b\n\nin  ner",
    "<dl><dt>t<dd>d</dl>": "t\n  d",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<input type=hidden value=h><input type=submit value=Go><textarea> a <b></textarea>": "Go a <b>",
    "<select><option>a<option>b</select>": "a\nb",
    "<p a='x>y'>t</p></div></p>": "t",
    "<p class=\"unclosed>t": "t",
    "": "",
    "a < b": "a < b",
    "x<": "x<",
    "<hr>a<hr><hr>b": "a\n\nb",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert visible_text(html) == CASES[html]


NOTE = "<p class='note q' id=n>a</p>"
SHEETS = {  # whether the note shows
    ".note{display:none}": False, ".other{display:none}": True, "P.note.q#n{display:none}": False, "p.x{display:none}": True, "*{visibility:hidden}": False,
    "@media print{.note{display:none}}": True, "@media screen{.note{display:none}}": False, "@media only screen and (min-width: 40em){.note{display:none}}": False,
    "@media (max-width:600px){.note{display:none}}": True, "@media (width <= 600px){.note{display:none}}": True, "@media(400px<width){.note{display:none}}": False,
    "@media print, (min-width:1px){.note{display:none}}": False, "@media not print{.note{display:none}}": False, "@media not screen{.note{display:none}}": True,
    "@media (some-new:thing){.note{display:none}}": True, "@media print{a{b:c}} .note{display:none}": False, "@media print{a{b:c}.note{display:none}}": True,
    "@media print{a{b:'}'}.note{display:none}}": True, "@media screen{@media print{.note{display:none}}}": True, "@supports (display:grid){.note{display:none}}": False,
    "@import url(x.css); .note{display:none}": False, "@font-face{a:b}.note{display:none}": False, "/* .note{display:none} */": True, "/*.note{display:none}": True,
    "<!-- .note{display:none} -->": False, ".note{/*x*/display:/**/none}": False, ".note{display:none": False, "@media print{.note{display:none": True,
    ".note{display:none} .note{display:block}": True, ".note{display:block} .note{display:none}": False, ".note{display:none} p{display:block}": False,
    "#n{display:block} .note{display:none}": True, ".note{display:none!important} .note{display:block}": False, ".note{display:none;display:flex}": True,
    ".note{display:none} .note.q{display:block}": True, ".note{display:none} @media print{.note{display:block}}": False, ".x{.note{display:none}}": True,
    ".note{visibility:hidden} .q{visibility:visible}": True, ".note{display:none;display:nonsense}": False, ":is(.x, .note, .y) b{display:none}": True,
}


@pytest.mark.parametrize("css", SHEETS)
def test_rules_of_style_sheets(css):
    assert visible_text(f"<style>{css}</style>{NOTE}") == ("a" if SHEETS[css] else "")


def test_sheets_and_attributes():
    rule = ".note{display:none}"
    assert visible_text(f"<style media=print>{rule}</style>{NOTE}") == "a" and visible_text(f"<style media='screen, print'>{rule}</style>{NOTE}") == ""
    assert visible_text(f"<style>{rule}</style><style>p.note{{display:block}}</style>{NOTE}") == "a"
    assert visible_text(f"<style>p.note{{display:block}}</style><style>{rule}</style>{NOTE}") == "a"
    assert visible_text(f"<style>.note{{display:block}}</style><style>{rule}</style>{NOTE}") == ""
    assert visible_text(f"<style>{rule}</style><p class=note style='display:block'>a<i style='display:none'>b</i>") == "a"
    assert visible_text("<style>.note{display:none!important}</style><p class=note style='display:block'>a") == ""
    assert visible_text("<style>.note{visibility:hidden}</style><p class=note>a<b style='visibility:visible'>b</b><p class=note style='visibility:visible'>c") == "b\n\nc"
    assert visible_text("<style>.on{display:block}</style><p hidden>a<p hidden class=on>b") == "b"
    assert visible_text("<style>" + "@media screen{" * 20_000 + ".x{display:none}</style><p class=x>a<p>b") == "b"


def test_deep_and_long_pages():
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert len(visible_text("<ul><li>a" * 3_000).splitlines()) == 3_000
    assert visible_text("<td>" * 2_000 + "x").strip() == "x"
    assert len(visible_text("<p>" + "word " * 300_000)) == 5 * 300_000 - 1


def test_no_cell_is_lost_and_wide_cells_do_not_pad():
    wide = "w" * 5_000
    rows = "".join(f"<tr><td>r{i}<td>s{i}" for i in range(500))
    out = visible_text(f"<table><tr><td>{wide}<td>end{rows}</table>")
    assert wide in out and len(out) < 5_000 + 500 * 100 and all(f"r{i}" in out and f"s{i}" in out for i in range(500))


def test_pages_with_odd_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a", 5), (1, "<p>a", 5), (2, None, 5), (None, "", 5)], "page_id long, html string, text long")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract_text(pages).collect())
    assert got == [(0, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert extract_text(pages.limit(0)).count() == 0


def test_every_visible_word_of_the_test_pages_is_kept(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    both = extract_text(pages).join(pages, "page_id").select("text", "html").collect()
    for row in both:
        inner = row["html"].split("<article>")[1].split("</article>")[0]
        first = unescape(inner.split("<h1>")[1].split("</h1>")[0])
        assert " ".join(first.split()) in " ".join(row["text"].split()) and "track(" not in row["text"]
