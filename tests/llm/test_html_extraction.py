"""Blocks of odd markup, the field against enumeration, and pages held out from training."""

from __future__ import annotations

import time
from itertools import product

import pytest
from pyspark.sql import functions as F

from linkwatch.llm.html_blocks import blocks_of
from linkwatch.llm.html_extraction import (
    Decoder,
    Training,
    extracted,
    fitted,
    labelled_pages,
    path_features,
    text_features,
    train,
)

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        (None, []),
        ("", []),
        ("plain\n text", ["plain text"]),
        ("<p>a&amp;b&nbsp;c<p>d &lt;e", ["a&b c", "d <e"]),
        ("<p><b>x</b>y<br>z</p><script>if (a < b) '</p>'</script>w", ["xy z", "w"]),
        ("<ul><li>one<li>two <i>t</i></ul>three", ["one", "two t", "three"]),
        ("<!-- <p>no</p> --><p>yes</p><!-- open", ["yes"]),
        ("<p title='a>b'>q</p><p clas", ["q"]),
        ("<div><p>a</div>b</p>c &copy &#233; &am", ["a", "b", "c © é &am"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in blocks_of(page)] == texts


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p><p>z", ["if x=2 then", "z"]),
        ("<p>if <math><mi>x</mi> then</p><p>z</p>w", ["if x then", "z", "w"]),
        ("<p>a <svg><path d='M0'/></svg> b</p>c", ["a b", "c"]),
        ("<p>a</p><svg><g><text>one</text><text>two</text></g></svg><p>b</p>", ["a", "one", "two", "b"]),
        ("<p>a <svg><path d='M0'> b</p><p>c</p>d", ["a b", "c", "d"]),
        ("<div><svg><g><p>c</p></div><p>d", ["c", "d"]),
        ("<p>a</p><template><p>b</p></template><iframe>c</iframe><p>d", ["a", "b", "c", "d"]),
        ("<template><p>b<noframes>c<noembed>d<iframe>e", ["b", "c", "d", "e"]),
        ("<p>a</p><textarea>b</textarea><style>c</style><title>d</title><p>e<script>f", ["a", "e"]),
    ],
)
def test_formulas_drawings_and_templates_keep_their_text(page, texts):
    assert [b.text for b in blocks_of(page)] == texts


def test_paths_around_drawings():
    page = "<main>a <svg><text>b</text></svg> c<svg><path d=''><p>d</p></main>e"
    paths = {b.text: [x[0] for x in b.path] for b in blocks_of(page)}
    assert paths == {"a": ["main"], "b": ["main", "svg", "text"], "c": ["main"], "d": ["main", "p"], "e": []}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet")


@pytest.fixture(scope="module")
def sample(pages):
    return [r.html for r in pages.orderBy("page_id").limit(90).collect()]


@pytest.fixture(scope="module")
def field(sample):
    return train(labelled_pages(sample[:60], Training(layouts=3)))


def test_decoding_is_the_best_labelling(field, sample):
    decoder = Decoder(field)
    for page in sample[60:]:
        blocks = blocks_of(page)[:8]
        scores = [decoder.emission(b) for b in blocks]

        def total(labels, scores=scores):
            moves = sum(field.change[a][b] for a, b in zip(labels, labels[1:], strict=False))
            return moves + labels[0] * field.start + sum(
                s for s, y in zip(scores, labels, strict=True) if y
            )

        best = max(product((0, 1), repeat=len(blocks)), key=total)
        assert total(decoder.decode(blocks)) == pytest.approx(total(best))


def test_scores_along_the_tree_are_those_of_whole_paths(field, sample):
    decoder = Decoder(field)
    nested = "<div class='post a'><ul><li>x<li>y<div id=post><p>z</ul></div>w<p>v"
    for page in [*sample[:20], nested, "".join(f"<section class='c{i % 7} nav'>t" for i in range(200))]:
        decoder.restart()
        for b in blocks_of(page):
            whole = path_features(b.path) + text_features(b)
            assert decoder.emission(b) == pytest.approx(sum(field.weights.get(f, 0.0) for f in whole))


HOSTILE = [
    '<a href="x ', "<a ", "<a", "<b '\"", "<", "<div>t", "<div class='c{}'>t", "<i></u>", "<li><section>",
    "<svg><g>x", "<!--", "&#9",
]


@pytest.mark.parametrize("unit", HOSTILE)
def test_time_grows_with_the_page_and_not_with_its_square(field, unit):
    def seconds(size):
        page = "".join(unit.format(i) for i in range(size // len(unit)))
        begun = time.process_time()
        Decoder(field).decode(blocks_of(page))
        return time.process_time() - begun

    small, large = seconds(100_000), seconds(1_600_000)
    assert large < 16 * 4 * small + 1


def test_long_inline_runs_inside_walls():
    begun = time.process_time()
    page = "<p><section>" + "<i>" * 200_000 + "<p>a</p>" * 60_000
    assert len(blocks_of(page)) == 60_000 and time.process_time() - begun < 30


def test_numbers_of_references_have_no_limit():
    page = "<p>a&#" + "9" * 10_000 + ";b&#" + "0" * 10_000 + "65;c"
    assert [b.text for b in blocks_of(page)] == ["a\ufffdbAc"]


def test_held_out_layouts(field, sample):
    decoder, wrong, total = Decoder(field), 0, 0
    for blocks, labels in labelled_pages(sample[60:], Training(layouts=3, seed=23)):
        wrong += sum(a != b for a, b in zip(decoder.decode(blocks), labels, strict=True))
        total += len(blocks)
    assert total > 1500 and wrong < 0.02 * total


def test_pages_of_every_kind(spark, pages, field):
    odd = [
        (1, "u", None),
        (2, None, ""),
        (3, "u", "<html><body><nav><a href='/'>Home</a></nav></body></html>"),
        (4, "u", "<article><h1>Title of it</h1><p>First, a text that says something.</p>"
                 "<aside><p>Read more elsewhere.</p></aside><p>Second text of the page.</p>"
                 "</article><section id='comments'><h3>Comments</h3><p>I like it.</p></section>"),
        (4, "u", "<p>" * 3000 + "x"),
    ]
    docs = spark.createDataFrame(odd, "page_id long, url string, html string")
    got = extracted(docs.withColumn("text", F.lit("own")), field).collect()
    assert len(got) == 5
    texts = {(r.page_id, r.text) for r in got}
    assert {(1, ""), (2, ""), (3, "")} < texts
    article = "Title of it\nFirst, a text that says something.\nSecond text of the page."
    assert (4, article) in texts


def test_without_pages_to_learn_from(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extracted(none, fitted(none)).count() == 0


def test_training_sample_is_a_parameter(pages):
    small = fitted(pages, Training(pages=30, layouts=1, steps=40))
    whole = extracted(pages, small).where("text <> ''").count()
    assert whole > 0.95 * pages.count()
