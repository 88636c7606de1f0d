import random

import numpy as np

from touchline.llm.html import Page, decode, features, fit, main_text, margins, read_trees

RNG = random.Random(15)


def prose(n):
    return " ".join(RNG.choice("the river runs by old stone houses and quiet people walk there, slowly.".split()) for _ in range(n))


def page(article, comments=True):
    return (
        f"<html><head><title>t</title><style>p{{}}</style><script>x('</p>')</script></head><body><nav><ul>{''.join(f'<li><a href=/{i}>Link {i}</a></li>' for i in range(5))}</ul></nav>"
        f"<div class='ad'>Buy now {prose(4)}</div><article>{article}</article>" + ("<div id='comments'><p>First! " + prose(6) + "</p></div>" if comments else "") + f"<footer>&copy; {prose(3)}</footer></body></html>"
    )


def made(n):
    out = []
    for _ in range(n):
        blocks = [prose(RNG.randint(1, 60)) for _ in range(RNG.randint(1, 6))]
        out.append((page(f"<h1>{blocks[0]}</h1>" + "".join(f"<p><b>{b}<br>" for b in blocks[1:])), "\n".join(blocks)))
    return out


def test_extracts_articles_and_handles_odd_pages(spark):
    pages = made(60)
    odd = [
        (None, ""), ("", ""), ("no markup", None), ("<script>only</script>", ""), ("<div>" * 20_000 + "deep", None), ("<p" * 5000, None),
        (page("<p>a &amp; b&nbsp;&lt;c \n\t d &am"), "a & b <c d &am"), (page("<p>x</p><aside>y</aside><p>z</p>"), "x\nz"), (page("<p>x <script>no</script>y<!-- c --></p>"), "x y"),
    ]
    rows = [(i, "u", h, "old") for i, (h, _) in enumerate(pages + odd)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text(frame)
    assert set(got.columns) == {"page_id", "url", "html", "text"}
    texts = {r.page_id: r.text for r in got.collect()}
    assert [(i, texts[i]) for i, (_, want) in enumerate(pages + odd) if want is not None and texts[i] != want] == []
    assert main_text(frame.limit(0)).count() == 0


def test_optional_end_tags_and_landmarks_that_say_nothing(spark):
    pages = [h for h, _ in made(60)]
    want = {
        "<html><head><title>t</title><body><nav>n</nav><article><p>kept text of the page, all of it.</article>": "kept text of the page, all of it.",
        "<title>t</title><meta charset=x><article><p>kept text, and more of it.</article>": "kept text, and more of it.",
        "<head><title>t</title>Bare text, which ends the head.<p>And more, as text.": None,
        "<body class='has-sidebar left sidebar'><article><p>One plain article, with a few words.</p></article></body>": "One plain article, with a few words.",
        "<article><header><h1>The title of it</h1></header><p>And the text, in full.</p></article>": "The title of it\nAnd the text, in full.",
        "<article><p>Area is <math><mi>x</mi>=3</math> units, <svg><text>drawn</text></svg> here.</p></article>": "Area is x=3 units, drawn here.",
        "<article><table><tr><td>a, b<td>c, d<tr><td>e, f</table><p>Then the text, at last.</article>": "a, b\nc, d\ne, f\nThen the text, at last.",
        "<article><p><ruby>k<rt>r<rp>p</ruby> and text, in order.</article>": "krp and text, in order.",
    }
    frame = spark.createDataFrame([(i, h) for i, h in enumerate([*want, *pages])], "page_id long, html string")
    got = {r.page_id: r.text for r in main_text(frame).where(f"page_id < {len(want)}").collect()}
    for i, (html, text) in enumerate(want.items()):
        assert got[i] == text if text is not None else "Bare text" in got[i], html


def test_many_open_tags_take_linear_time():
    import time

    took = []
    for n in (20_000, 80_000):
        for tag in ("a", "b", "span"):
            start = time.perf_counter()
            page = Page(f"<p>{f'<{tag}>x' * n}")
            assert len(page.blocks) == 1 and len(page.blocks[0][1]) == n
            took.append(time.perf_counter() - start)
    assert max(took) < 20


def test_trees_know_text_without_landmarks(spark):
    pages = made(120)
    trees = fit(spark.createDataFrame(pages[:80], "html string, want string"), "html")
    right = total = 0
    for html, want in pages[80:]:
        for old in ("article", "nav", "footer"):
            html = html.replace(f"<{old}>", "<div>").replace(f"</{old}>", "</div>")
        p = Page(html.replace("class='ad'", "").replace("id='comments'", ""))
        kept = decode(p, margins(trees, features(p)))
        for node, said in p.blocks:
            right += bool(kept[node]) == (said in want.split("\n"))
            total += 1
    assert right / total > 0.85


def test_decoding_never_contradicts_itself():
    p = Page("<div><div><p>" + "word " * 40 + "</p><p>x</p></div><div><p>" + "other " * 40 + "</p></div></div>")
    one, two, three = [n for n, _ in p.blocks]
    m = np.zeros(len(p.tag))
    m[one], m[two], m[three] = 1.0, -0.1, -1.0
    kept = decode(p, m)
    assert kept[one] and not kept[three]


def test_reads_the_description_of_trees():
    text = "Model\n  Tree 0 (weight 0.5):\n    If (feature 2 <= 1.5)\n     Predict: 1.0\n    Else (feature 2 > 1.5)\n     If (feature 0 <= -2.0E-4)\n      Predict: -1.0\n     Else (feature 0 > -2.0E-4)\n      Predict: 3.0\n"
    trees = read_trees(text)
    assert trees == [(0.5, (2, 1.5, (1.0,), (0, -0.0002, (-1.0,), (3.0,))))]
    assert margins(trees, np.array([[0.0, 0, 1], [-1.0, 0, 2], [1.0, 0, 2]])).tolist() == [0.5, -0.5, 1.5]
