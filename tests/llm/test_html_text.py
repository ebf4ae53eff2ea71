import re
from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from tidemark.llm.common import table
from tidemark.llm.html_text import extract_text, visible_text


def test_blocks_lists_and_entities():
    page = "<title>t</title><body>Hi <b>there</b>&amp; you<p>One<p>Two<br>Three<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>end"
    assert visible_text(page) == "Hi there& you\n\nOne\n\nTwo\nThree\n\n- a\n- b\n  3. x\n  4. y\n\nend"


def test_tables_align_cells_and_imply_end_tags():
    page = "<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td colspan=2>both</table>after"
    assert visible_text(page) == "Name       Qty\nApple pie  3\nboth\n\nafter"


def test_long_cells_stay_whole():
    long = "w " * 100
    assert long.strip() in visible_text(f"<table><tr><td>{long}<td>b</table>")


def test_hidden_text_is_left_out():
    page = ("<style>a</style><script>var x='</p>'</script><p hidden>b<p style='color:red; display: none'>c"
            "<div style=\"visibility:hidden\">d</div><template>e</template><!-- f --><noscript>g</noscript>"
            "<div class='hidden'>shown</div><p data-hidden=1>too")
    assert visible_text(page) == "shown\n\ntoo"


def test_head_ends_without_its_end_tag_or_body():
    assert visible_text("<html><head><title>t</title><p>One<p>Two") == "One\n\nTwo"
    assert visible_text("<head>\n<meta charset=utf-8><link rel=x><style>a</style>\nText <b>bold</b>") == "Text bold"
    assert visible_text("<head><script>a</script><div>One</div></head><body>Two") == "One\nTwo"
    assert visible_text("<head><head><html><noscript><img>x</noscript><template><p>y</template><title>t</title>< z") == "< z"
    assert visible_text("<html><head><title>t</title></head><body>One") == "One"


def test_only_the_hidden_and_style_attributes_hide():
    shown = ["title='a hidden gem'", 'class="hidden md:block"', 'class="x hidden y"', "data-style='display:none'",
             "title='style=display:none'", "style='--x-display:none'", "alt=a/hidden", "data-x='a' title=hidden"]
    for attrs in shown:
        assert visible_text(f"<body {attrs}><p>One") == "One", attrs
    for attrs in ("hidden", "HIDDEN=''", "class='a' hidden", "class=a hidden/", "title='x'hidden", "hidden='until-found'",
                  "STYLE=display:none", 'style="color:red;visibility : collapse"', "style='display&#58;none!important'"):
        assert visible_text(f"<body {attrs}><p>One") == "", attrs


def test_preformatted_text_keeps_its_lines():
    assert visible_text("a<pre>  x\n    y\n\n  z</pre>b") == "a\n\n  x\n    y\n\n  z\n\nb"


def test_attributes_may_hold_angle_brackets():
    assert visible_text("<a title='a > b' href=\"c<d\">link</a> < 5 &lt;b&gt;") == "link < 5 <b>"


def test_stray_and_unclosed_tags():
    assert visible_text("</div></p>a<td>b</table><li>c</ul><b") == "ab\n- c"
    assert visible_text("<!-- never closed <p>x") == ""
    assert visible_text("<script>never closed") == ""
    assert visible_text("<div>" * 20_000 + "deep") == "deep"


block = st.sampled_from(["p", "div", "h1", "section", "blockquote"])
word = st.text("abcdefg", min_size=1, max_size=6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(block, st.lists(word, min_size=1, max_size=5)), max_size=6))
def test_round_trip_of_words_in_order(blocks):
    page = "".join(f"<{b}>{'  '.join(words)}</{b}>" for b, words in blocks)
    lines = [x.strip() for x in visible_text(page).split("\n") if x.strip()]
    assert lines == [" ".join(words) for _, words in blocks]


@settings(max_examples=100, deadline=None)
@given(st.text("<>/!-abpultdr='\" &;", max_size=60))
def test_any_markup_parses(page):
    visible_text(page)


def test_frame(spark):
    rows = [(1, "<p>a", "x"), (2, None, "x"), (3, "", "x"), (1, "<p>a", "x"), (None, "b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted(map(tuple, extract_text(pages).collect()), key=str) == sorted(
        [(1, "a"), (2, None), (3, ""), (1, "a"), (None, "b")], key=str)
    assert extract_text(pages.limit(0)).collect() == []


def test_captions_and_loose_text_stand_before_their_table():
    assert visible_text("<table><caption>Cap</caption><tr><td>a<td>b</table>end") == "Cap\na  b\n\nend"
    assert visible_text("x<table>loose<tr><td>a</table>y") == "x\n\nloose\na\n\ny"


def test_only_the_named_attributes_number_and_span():
    assert visible_text("<table><tr><td title='colspan=9'>a<td>b<tr><td>cc<td data-colspan=3>d</table>") == "a   b\ncc  d"
    assert visible_text("<ol data-start=5><li>a</ol><ol start=-1><li>b<li>c</ol>") == "1. a\n\n-1. b\n0. c"
    assert visible_text("<ol START='3'><li>a<li value=7>b<li>c<li data-value=1 value=x>d</ol>") == "3. a\n7. b\n8. c\n9. d"


def test_rowspan_keeps_later_cells_in_their_column():
    assert visible_text("<table><tr><td rowspan=2>top<td>x<tr><td>y<tr><td>z<td>w</table>") == "top  x\n     y\nz    w"
    page = "<table><tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td colspan=1>f<td>g<tr><td>h<td>i<td>j</table>"
    assert visible_text(page) == "a  b  c\nd     e\nf     g\nh  i  j"


def test_visibility_is_inherited_and_can_come_back():
    assert visible_text("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b> no</div>after") == "yes\nafter"
    assert visible_text("<div style='visibility:hidden'><p style='display:none'><b style='visibility:visible'>x</b></p>y</div>z") == "z"


def test_style_rules_hide():
    css = ("<style>/* .k{display:none} */ .x, p.y { color:red; display : none } #i{visibility:hidden} .late{display:none}"
           ".late{display:block} em.late{display:none} a b{display:none} @media print{.m{display:none} .n{display:none}}</style>")
    shown = ["<p class=k>s", "<p class=z>s", "<div class=y>s", "<p class=late>s", "<p class=m>s", "<p class=n>s",
             "<p class=x style='display:block'>s", "<a><b>s</b></a>", "<p id=j>s", "<p data-class=x>s"]
    gone = ["<p class=x>s", "<p class='a x b'>s", "<p class=y>s", "<i id=i>s</i>", "<em class=late>s</em>"]
    assert [visible_text(css + p) for p in shown] == ["s"] * len(shown)
    assert [visible_text(css + p) for p in gone] == [""] * len(gone)


def test_closed_details_and_dialogs():
    assert visible_text("<details><summary>S</summary>no<p>no</details>") == "S"
    assert visible_text("<details>no</details><details open>yes</details>") == "yes"
    assert visible_text("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"


def test_preformatted_blank_lines_and_no_break_spaces_stay():
    assert visible_text("<pre>a\n\n\nb</pre>c") == "a\n\n\nb\n\nc"
    assert visible_text("x&nbsp;&nbsp;y  z") == "x  y z"
    assert visible_text("<p>&nbsp;</p><p>a</p>") == "a"


class PlainWords(HTMLParser):
    """Words outside of hidden elements, by the standard library's parser."""
    SKIPPED = {"script", "style", "title", "template", "noscript", "iframe", "textarea"}

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        hides = "hidden" in named or "display:none" in (named.get("style") or "").replace(" ", "")
        if self.hidden or tag in self.SKIPPED or hides:
            if tag not in ("br", "hr", "img", "input", "meta", "link", "wbr", "col"):
                self.hidden.append(tag)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.hidden:
            self.words += re.findall(r"\w+", data)


def test_words_of_given_pages_equal_an_independent_parser(spark):
    pages = [r.html for r in table(spark, SF_SMALL, "pages").select("html").collect() if r.html]
    same = 0
    for page in pages:
        plain = PlainWords()
        plain.feed(page)
        plain.close()
        words = re.findall(r"\w+", re.sub(r"(?m)^ *(- |\d+\. )", "", visible_text(page)))
        same += sorted("".join(words)) == sorted("".join(re.sub(r"(?m)^ *(- |\d+\. )", "", " ".join(plain.words)).split()))
    assert same >= 0.9 * len(pages)
