"""Rendering of markup that browsers show in spite of its errors."""

import pytest

from ferrolith.llm.render import render


@pytest.mark.parametrize(("page", "want"), [
    ("<table><thead><th>Name<th>Age</thead><tbody><td>Ann<td>41</tbody></table>", "Name  Age\nAnn   41"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tbody>lost<div>too</div><tr><td>x</td></tr></tbody></table>", "lost\ntoo\n\nx"),
    ("<table><tbody><form><tr><td>a<td>b</tr><tr><td>c</tr></form></tbody></table>", "a  b\nc"),
    ("<table><colgroup><td>a</colgroup><td>b</table>", "a  b"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\nd"),
    ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c</tbody><tbody><tr><td>d</table>", "a  b\n   c\nd"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>d<td>e<td>f</table>", "ab     c\nd   e  f"),
    ("<table><tr><td><table><tr><td>in</td></tr></table></td><td>out</td></tr></table>after", "in  out\n\nafter"),
])
def test_tables(page, want):
    assert render(page) == want


DEEP = "<div>" * 500


@pytest.mark.parametrize(("page", "want"), [
    ("<p class=it's>Hello</p><p>don't</p>", "Hello\n\ndon't"),
    ('<table><tr><td width="50"">Price</table>', "Price"),
    ("<a title='a > b' href=x>link</a> <i data-a = \"x>y\" hidden>no</i>end", "link end"),
    ('<p title="never closed>kept</p>', "kept"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
    ("<svg><title/><desc>no</desc><style>no</style>no<text x=1>North</text><text>South</text></svg>", "North South"),
    ("<svg><g><p>out of it</p>rest", "out of it\n\nrest"),
    ("<svg><foreignObject><p>inside</p></foreignObject><text>label</text></svg>", "inside\n\nlabel"),
    ("<head><title>no</title>straight after", "straight after"),
    ("<head><title>no</title></head><body>a<head>b", "ab"),
    (f"<section hidden>{DEEP}<section>no</section>no</section>yes", "yes"),
    (f"{DEEP}<p hidden>no<b>no</b></p><p>one</p><div><div>two</div></div>{'</div>' * 500}three", "one\ntwo\nthree"),
    (f"{DEEP}<div style='display:none'><div>no</div>no</div>yes", "yes"),
    (f"{DEEP}<table>first<tr><td>a<td>b</table>last", "first\na\nb\nlast"),
])
def test_lost_text(page, want):
    assert render(page) == want


def test_deep_pages_take_linear_time():
    assert render("<div>" * 100_000 + "x" + "</div>" * 100_000 + "y") == "x\ny"


@pytest.mark.parametrize("depth", range(388, 404))
def test_no_text_is_lost_at_the_depth_of_layout(depth):
    table = "<table><caption>a</caption>b<i>c</i><thead><th>d<tbody><tr>e<td><b>f</b><td><p>g</p><tr><u>h</u><td><div><div>i</div></div></table>j"
    assert sorted(c for c in render("<div>" * depth + table) if c.isalpha()) == list("abcdefghij")
