from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import layout
from kerbside.llm.layout import render, visible_text


def test_blocks_and_hidden_parts():
    page = (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><h1>Head &amp; line</h1>"
        "<p>One <b>bold</b>\n text.<p>Two<br>lines<!-- gone --><script>var t='</p>';</script>"
        "<div hidden>no</div><div style='color:red; display : none'>no<p>no</div><div>a</div><div>b</div></body></html>"
    )
    assert render(page) == "Head & line\n\nOne bold text.\n\nTwo\nlines\n\na\nb"


def test_the_word_hidden_in_values_hides_nothing():
    for attributes in (
        'class="hidden md:block"',
        'title="a hidden gem"',
        'aria-label="show hidden items"',
        'data-hidden="x" aria-hidden=true',
        "title='style=display:none'",
        'data-style="display:none"',
        'style="--display:none; x-visibility:hidden"',
        'style="background:url(display:none.png)"',
    ):
        assert render(f"<div {attributes}>seen<p>below</div>after") == "seen\n\nbelow\n\nafter", attributes
    for attributes in (
        "hidden",
        "HIDDEN=''",
        'class="a"hidden',
        "id=x hidden=until-found",
        'style="color:red; display : none !important"',
        "style=visibility:hidden",
        "style='display:none",
        'title="a > b" style="DISPLAY:/* x */NONE"',
    ):
        assert render(f"<div {attributes}>gone<p>below</div>after") == "after", attributes


def test_drawings_formulas_and_objects_are_seen():
    assert render("a<svg width=9><title>no</title><desc>no</desc><path d='x'/><text>one</text><text x=1>two</text></svg>b") == "a\none\ntwo\nb"
    assert render("x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> z") == "x y=2 z"
    assert render("<object data=a.pdf><p>instead</p></object>after") == "instead\n\nafter"
    assert render("<svg><style/><text>kept</text></svg><text>in line</text>") == "kept\nin line"
    assert render("<svg hidden><text>no</text></svg>b") == "b"


def test_lists():
    page = "<ul><li>a<li>b<ol start=3><li>x<li>y</ol></li><li></ul>after"
    assert render(page) == "- a\n- b\n   3. x\n   4. y\n-\n\nafter"


def test_table_is_aligned():
    page = "<table><tr><th>name<th>n<tr><td>a long one<td>1</table>end"
    assert render(page) == "name        n\na long one  1\n\nend"


def test_table_with_span_nested_and_loose_cell():
    page = "<table><td>a</td><td>b</td><tr><td colspan=2>wide</td><td>c</td></tr></table>"
    assert render(page) == "a  b\nwide  c"
    assert "inner" in render("<table><tr><td><table><tr><td>inner</table><td>x</table>")


def test_pre_keeps_space():
    assert render("<p>x</p><pre>a  b\n\n  c</pre>y") == "x\n\na  b\n\n  c\n\ny"


def test_broken_pages():
    assert render("a<!-- never closed") == "a"
    assert render("a<b href=\"x>y") == "ay"
    assert render("1 < 2 & 3") == "1 < 2 & 3"
    assert render("a</div></p>b") == "a\n\nb"
    assert render("x<script>never") == "x"
    assert render("") == ""


def test_deep_and_long_pages_stay_linear():
    assert render("<div>" * 50_000 + "x").strip() == "x"
    assert len(render("<p>" + "word " * 300_000)) == 5 * 300_000 - 1
    assert render("<a " * 20_000) == ""


TAGS = "p div ul ol li table tr td th b br pre dl dt dd script option select h1 caption tbody".split()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS]), st.sampled_from(["alpha", " ", "\n", "beta "])), max_size=40))
def test_any_nesting_keeps_every_visible_word(parts):
    page = "".join(p for p in parts if "script" not in p)
    words = [p.strip() for p in parts if p.strip() in ("alpha", "beta")]
    assert sorted("".join(render(page).split()).count(w) for w in ("alpha", "beta")) == sorted(words.count(w) for w in ("alpha", "beta"))


def test_query_columns(spark):
    rows = [(1, None, "t"), (2, "", "t"), (3, "<p>a", "t"), (3, "<p>a", "t")]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert [r[0] for r in frame.orderBy("page_id").select(visible_text("html")).collect()] == ["", "", "a", "a"]


class Walking(layout.Builder):
    """Finds open elements by walking the stack from its top."""

    def inside(self, tag):
        for name in reversed(self.stack):
            if name in (tag, "table"):
                return name == tag
        return False

    def imply(self, ended, shield):
        lowest = None
        for at in reversed(range(len(self.stack))):
            if self.stack[at] in shield:
                break
            if self.stack[at] in ended:
                lowest = at
        while lowest is not None and len(self.stack) > lowest:
            self.pop()

    def end(self, tag):
        if tag not in self.stack:
            return super().end(tag)
        for at in reversed(range(len(self.stack))):
            if self.stack[at] == tag:
                while len(self.stack) > at:
                    self.pop()
                return
            if self.stack[at] == "table" or self.stack[at] in layout.CELLS and tag not in layout.TABLE_TAGS:
                return


TAGS = "p div ul ol li dl dt dd table tr td th tbody caption pre select option b button svg text dialog".split()
TOKENS = st.one_of(
    st.sampled_from([f"<{tag}>" for tag in TAGS] + [f"</{tag}>" for tag in TAGS]),
    st.sampled_from(["one ", "two words", "\n", "<br>", "<hr>", "<td colspan=3>", "<div hidden>", "<li value=7>"]),
)


@settings(max_examples=500, deadline=None)
@given(st.lists(TOKENS, max_size=60))
def test_places_equal_walking_the_stack(tokens):
    page = "".join(tokens)
    found = render(page)
    plain, layout.Builder = layout.Builder, Walking
    try:
        assert found == render(page)
    finally:
        layout.Builder = plain


def plain_table(rows):
    """Cells of one line, padded one by one."""
    widths = {}
    for row in rows:
        for at, cell in enumerate(row):
            if len(cell) <= layout.ALIGNED:
                widths[at] = max(widths.get(at, 0), len(cell))
    return [line for row in rows if any(row) for line in ["  ".join(cell.ljust(widths.get(at, 0)) for at, cell in enumerate(row)).rstrip()]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "x", "four", "a longer cell", "w" * 50]), min_size=1, max_size=5), max_size=6))
def test_tables_against_padding_one_by_one(rows):
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{cell}</td>" for cell in row) + "</tr>" for row in rows) + "</table>"
    assert render(page) == "\n".join(plain_table(rows))


def test_time_and_output_are_linear():
    import time

    def hostile(n):
        return [
            "<dl><dd>" + "<div>" * n + "<li>" * n,
            "<ul><li>x" * n,
            "<table><tr>" + "<td colspan=1000>x" * n,
            "<table><tr><td>x" * n,
            "<table><tr>" + "".join(f"<td>{'w' * 40}" for _ in range(n // 8)) + "<tr>" + "<td>" * (n // 8) + "x<br>" * n,
            "<p>" * n + "</div>" * n + "<b>" * n,
            "<td>" * n + "</li>" * n,
        ]

    for small, large in zip(hostile(4000), hostile(8000), strict=True):
        took, sizes = [], []
        for page in (small, large):
            runs = []
            for _ in range(3):
                began = time.process_time()
                text = render(page)
                runs.append(time.process_time() - began)
            took.append(min(runs))
            sizes.append(len(text))
            assert text.count("x") == page.count("x")
        assert took[1] <= 3 * took[0] + 0.05, (small[:30], took)
        assert sizes[1] <= 2.1 * sizes[0] + 1000 and sizes[1] <= 300 * len(large), (small[:30], sizes)


def test_closed_dialogs_are_not_seen():
    assert render("a<dialog>no</dialog><dialog open>yes</dialog><dialog class='open'>no</dialog>b") == "a\nyes\nb"
