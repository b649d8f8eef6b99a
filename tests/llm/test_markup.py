import json

import pytest

from folianth.llm import markup as M

KINDS = [
    ("<table><tr><td>a</td></tr></table>", ["html"]), ("&lt;table&gt;&lt;tr&gt;&lt;td&gt;a&lt;/td&gt;&lt;/tr&gt;", ["html"]), ("a &alpha; b", ["html"]), ("| a | b |\n|---|:-:|\n| 1 | 2 |", ["markdown"]), ("**F**(2, 3)", ["markdown"]), ("*t*(29) = 1", ["markdown"]), ("`mean(x)`", ["markdown"]),
    ("{| class=\"w\"\n! a !! b\n|-\n| 1 || 2\n|}", ["wiki"]), ("'''M''' = 4", ["wiki"]), ("[[mean|M]] = 1", ["wiki"]), ("{{math|x}}", ["wiki"]), ("== x ==", ["wiki"]), (r"\begin{tabular}{|l|l|}a & b \\ \hline\end{tabular}", ["latex"]), ("x_{i}^{2}", ["latex"]), (r"\alpha = 1", ["latex"]), ("$x = 3$", ["latex"]), ("72\\%", ["latex"]),
    ("<b>\\beta_{5}</b>", ["html", "latex"]), ("a < b, b > 3", []), ("A & B = 77", []), ("cost $5 to $77", []), ("R&D share, $5.50 each", []), ("C:\\notes\\set9", []), ("*p < .01", []), ("*p < .05, **p < .01", []), ("2*3*33 = 198", []), ("#7 in the list", []), ("f(x) = [4, 1.35]", []), ("|x| = 2", []), ("f''(x) = g''(x)", []), ("[[1,2],[3,4]]", []), ("left | right", []), ("x² + y²", []), ("", []), ("snake_case_name and a_b", []),
]


@pytest.mark.parametrize("value, kinds", KINDS)
def test_kinds(value, kinds):
    assert sorted(M.read(value)[1]) == kinds


def test_text():
    assert M.read("<TABLE><TR><TD>a<TD>b<TR><TD>1<TD>&lt;2</TABLE>")[0] == "a | b\n1 | <2"
    assert M.read("<td>x<ul><li>p</li><li>q</li></ul></td>")[0] == "x\n- p\n- q"
    assert M.read("<p>see <code>f(x)</code> and x<sub>5</sub></p><pre>a\n  b</pre>")[0] == "see `f(x)` and x_5\n```\na\n  b\n```"
    assert M.read(r"\begin{tabular}{ll}\hline \textbf{a} & b \\ 1 & 5\% \\ \end{tabular}")[0] == "a | b\n1 | 5%"
    assert M.read(r"\[ \bar{x} \]")[0] == r"$\bar{x}$"
    assert M.read("{|\n! a !! b\n|-\n| 1\n| 2\n|}")[0] == "a | b\n1 | 2"
    assert M.read("| a | b |\n|---|---|\n| **1** | [x](u/v) |")[0] == "a | b\n1 | x"
    assert M.read("plain  text")[0] == "plain  text"
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert M.read(deep)[0] == "x" and M.read("<b>" + "y" * 200_000)[0] == "y" * 200_000


def test_content_is_the_dense_part():
    page = "<div><a href='#'>home</a> <a href='#'>next</a></div><div><p>" + "Long running text of the chapter. " * 20 + "</p><p>" + "More of it, without links. " * 20 + "</p></div>"
    assert "home" not in M.read(page)[0] and "More of it" in M.read(page)[0]


LONG_ROW = "<tr><td>group</td><td>12.5</td><td>0.04</td></tr>"


@pytest.mark.parametrize("value, kept, gone", [
    ("<ul><li><a href='1'>Chapter one</a></li><li><a href='2'>Chapter two</a></li><li><a href='3'>Chapter three</a></li></ul><p>" + "The text of the chapter goes on for long. " * 12 + "</p><p>Short.</p>", ["goes on", "Short."], ["Chapter two"]),
    ("stray words <p>" + "Running prose without any link at all. " * 12 + "</p><table><tr><td><a href='x'>next</a></td><td><a href='y'>back</a></td></tr></table>", ["stray words", "Running prose"], ["next", "back"]),
    ("<h2>Contents</h2><ol><li><a>One thing</a><li><a>Other thing</a></ol><h2>Results</h2><p>" + "Values were measured twice a day. " * 10 + "</p>", ["## Results", "measured"], ["Contents", "Other thing"]),
    ("<div><p>" + "A note above the table, fairly long. " * 8 + "</p></div><table>" + LONG_ROW * 3 + "</table><ul><li>a</li><li>b</li></ul>", ["group | 12.5 | 0.04", "- a", "A note"], []),
    ("<div>" + "Some prose with <a>one link</a> in a long sentence that says much more than its link. " * 6 + "</div>", ["one link", "says much more"], []),
    ("<table><tr><td><a>only</a></td><td><a>links</a></td></tr></table>", ["only | links"], []),
])
def test_density_decides_for_links(value, kept, gone):
    text = M.read(value)[0]
    assert all(x in text for x in kept) and not any(x in text for x in gone)


def test_escaped_many_times():
    import html

    value = "<b>x</b>"
    for _ in range(7):
        value = html.escape(value)
    assert M.read(value) == ("x", ["html"])


def test_queries(spark):
    item = lambda **x: json.dumps({"type": "table"} | x)
    rows = [(1, item(table_body="<b>x</b>")), (1, item(table_body="<b>x</b>")), (2, item(content={"sub": [{"math_content": "x_{1}"}, {"math_content": "**y**"}]})), (3, item(table_body=None)), (4, item(table_body=["<b>"])), (5, "{\"table_body\": \"<b>"), (6, None), (7, item(table_body=""))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "block_id bigint, item string, markup string")
    assert sorted(map(tuple, M.markup_kinds(df).collect())) == [(1, "table_body", "html"), (2, "math_content", "latex"), (2, "math_content", "markdown")]
    assert sorted((r.block_id, r.text) for r in M.clean_fields(df).collect()) == [(1, "x"), (2, "x_{1}"), (2, "y"), (7, "")]
    assert M.markup_kinds(df.limit(0)).count() == 0
