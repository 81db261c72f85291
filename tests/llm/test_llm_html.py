import pytest

from shelfspark.llm.html_extract import TreeModel, _attribute_words, fit_tree_model, main_texts, parse, training_pages

PAGE = (
    "<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=1>Home</a></li></ul></nav>"
    '<div class="cookie-notice"><p>We use cookies.</p></div>'
    "<article><h1>A  title &amp; more</h1><p>One\n two&nbsp;three.<p>Four &lt;5&gt; <b>six<br>seven</p>"
    '<div class="ad">Buy now.</div><script>var x = "<p>no</p>";</script><p>Ünd Ende.</p></article>'
    '<section class="comments"><p>Nice post.</p></section><form><label>Mail</label><input></form>'
    "<aside><p>Related things.</p></aside><footer>&copy; all</footer></body></html>"
)


@pytest.fixture(scope="module")
def model():
    return fit_tree_model()


def test_page(model):
    assert model.main_text(PAGE) == "A title & more\nOne two three.\nFour <5> six seven\nÜnd Ende."


def test_held_out_pages(model):
    right = total = 0
    for source in training_pages(80, seed=1234):
        page = parse(source)
        labels = [0] * len(page.tags)
        for i in range(1, len(labels)):
            mark = _attribute_words(page.attributes[i])[1]
            labels[i] = labels[page.parents[i]] if mark is None else int(mark)
        marginal = model.marginals(page)
        right += sum((marginal[n] >= 0.5) == labels[n] for n, _ in page.runs)
        total += len(page.runs)
    assert right / total > 0.98


def test_marginals_are_those_of_enumeration():
    import itertools
    import math

    page = parse("<div><p>a</p><section><p>b</p><p>c</p></section></div>")
    model = TreeModel({"edge0:p": 0.7, "edge1:p": 1.1, "edge0:div": -0.2, "edge1:section": 0.4, "edge1:div": 0.3})
    unary = [0.3, -0.5, 1.2, 0.1, -0.9, 0.6]
    edges, n = model._edges(page), len(page.tags)
    z, ones = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n):
        score = sum(u for u, s in zip(unary, states, strict=True) if s)
        for i in range(1, n):
            if states[i] == states[page.parents[i]]:
                score += edges[i][states[i]]
        z += math.exp(score)
        for i, s in enumerate(states):
            ones[i] += s * math.exp(score)
    got, joint = model.messages(page, unary)
    assert got == pytest.approx([o / z for o in ones])


@pytest.mark.parametrize(("source", "texts"), [
    ("<p>One.</><p>Two.</p>", ["One.", "Two."]),
    ("<p>One.</ p>Two.</p><p>Three.", ["One.Two.", "Three."]),
    ("<p>I </3 this>much.</p><p>Two.</p>", ["I much.", "Two."]),
    ("<p title=it's>Text one.</p><p>We don't know.</p>", ["Text one.", "We don't know."]),
    ("<p title='a > b' class=x>One.</p>", ["One."]),
    ('<p title = "a > b">One.</p><p a=b="c>Two.</p><p "d>Three.</p>', ["One.", "Two.", "Three."]),
    ("<p>a <é b</p><p>c", ["a <é b", "c"]),
])
def test_no_text_is_lost(source, texts):
    assert [t for _, t in parse(source).runs] == texts


@pytest.mark.parametrize("source", [None, "", "<", "</p>", "<p", "<!-- x", "<article><p>a<td>b</li></table></article", "<script>", "a < b", "<p class='x>y"])
def test_broken_markup(model, source):
    assert isinstance(model.main_text(source), str)


def test_frame(spark, model):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (2, None, None, None), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_texts(pages, model).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (2, None)] == ["", ""]
    assert main_texts(pages.limit(0), model).count() == 0


@pytest.mark.parametrize(("source", "runs"), [
    ("<p>One.<!-->Two.</p>", ["One.Two."]),
    ("<p>One.<!--->Two.<!-- gone > -->Three.</p>", ["One.Two.Three."]),
    ("<p>One.</p><script src=x />var leak = 1;</script><style />p{}</style><p>Two.</p>", ["One.", "Two."]),
    ("<div>One.<hr>Two.<hr/>Three.</div>", ["One.", "Two.", "Three."]),
    ("<p>One. <svg/>Two.</p>", ["One. Two."]),
])
def test_comments_scripts_and_rules(source, runs):
    assert [text.strip() for _, text in parse(source).runs] == runs


TWO = "<p>The river rose in the night and took the bridge.</p><p>Nobody was hurt, the mayor said on Monday.</p>"
TWO_TEXT = "The river rose in the night and took the bridge.\nNobody was hurt, the mayor said on Monday."
AROUND = (
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></nav>{}'
    '<div class="sidebar"><h3>More</h3><p>Read this too.</p></div><footer>&copy; The paper</footer>'
)


@pytest.mark.parametrize("neighbours", [False, True])
@pytest.mark.parametrize("page", [
    '<body class="right-sidebar"><article>{}</article></body>',
    '<body class="nav-open"><div class="post">{}</div></body>',
    '<body class="home has-header"><article>{}</article></body>',
    '<body><div class="content-area has-sidebar">{}</div></body>',
    '<body><article class="post comments-open">{}</article></body>',
    '<body><article class="post-12 post type-post has-post-thumbnail category-notice tag-ads comments-closed">{}</article></body>',
    '<body><main><div class="social-history">{}</div></main></body>',
    '<body><form method="post" action="./a.aspx" id="aspnetForm"><article>{}</article></form></body>',
    '<body><article><form method="post" id="form1">{}</form></article></body>',
    '<body><div class="layout right-sidebar"><article>{}</article></div></body>',
    "<body>{}</body>",
])
def test_class_words_of_outer_elements(model, page, neighbours):
    body, end = page[: page.index(">") + 1], "</body>"
    inner = page[len(body) : -len(end)].format(TWO)
    source = f"<html><head><title>t</title></head>{body}{AROUND.format(inner) if neighbours else inner}{end}</html>"
    assert model.main_text(source) == TWO_TEXT


def test_long_comments_below_a_short_article(model):
    comments = "".join(f'<li class="comment"><p>I have been there {i} times. What a place it was.</p></li>' for i in range(30))
    source = f'<html><body><article><h1>Bridge</h1>{TWO}</article><section class="comments"><h2>Replies</h2><ol>{comments}</ol></section></body></html>'
    assert model.main_text(source) == "Bridge\n" + TWO_TEXT


def test_formulas_stay_in_their_sentence(model):
    source = f"<article>{TWO}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> hold here.</p></article>"
    assert model.main_text(source) == TWO_TEXT + "\nLet x=2 hold here."


def test_very_long_page(model):
    text = "A long sentence of words. " * 40_000
    assert model.main_text(f"<body><article><p>{text}</p></article></body>") == text.strip()
