from collections import Counter
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymark.operators import concat_pages, html_table_rows


def rows(spark, html, **options):
    df = spark.createDataFrame([(html,)], "html string")
    found = html_table_rows(df, **options).orderBy("row_pos").collect()
    assert [r.row_pos for r in found] == list(range(len(found)))
    return [r.cells for r in found]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<table><tbody><tr><td>a</td><td> b </td></tr></tbody></table>", [["a", "b"]]),
        ("<TABLE><TBODY><TR><TD class='x'>a</TD></TR></TBODY></TABLE>", [["a"]]),
        ("<table><tbody><tr><th>h</th></tr><tr><td>a</td></tr></tbody></table>", [[], ["a"]]),
        ("<table><thead><tr><td>h</td></tr></thead><tbody><tr><td>a</td></tr></tbody></table>", [["a"]]),
        # Without a tbody a browser makes one of the rows outside head and foot.
        ("<table><thead><tr><td>h</td></tr></thead><tr><td>a</td></tr></table>", [["a"]]),
        # End tags that HTML lets one leave out.
        ("<table><tbody><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c"]]),
        ("<table><tbody><tr><td>a</td></tr></tbody><tbody><tr><td>a</td></tr></tbody></table>", [["a"], ["a"]]),
        ("<!-- <table><tbody><tr><td>a</td></tr></tbody></table> -->", []),
        ("<script>'<table><tr><td>a</td></tr></table>'</script><table><tr><td>b</td></tr></table>", [["b"]]),
        ("<table><tbody><tr><td><b>1.234</b> &amp; x</td><td></td></tr></tbody></table>", [["1.234 & x", ""]]),
        ("<table><tbody><track><tr><tdx>a</tdx><td>b</td></tr></tbody></table>", [["b"]]),
        ("<table><tr><td>a  \n b<br> c\t</td></tr></table>", [["a b\nc"]]),
        ("<table><tr><td>a</td></tr><script>var t = '<tr>'", [["a"]]),
        (
            "<table><tr><td>1</td></tr><tr><td>n<table><tr><td>in</td></tr></table></td></tr>"
            "<tr><td>3</td></tr></table>",
            [["1"], ["n"], ["in"], ["3"]],
        ),
        # Cells behind a nested table are the outer row's, and so is text around it.
        (
            "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>after</td></tr></table>",
            [["a", "after"], ["in"]],
        ),
        (
            "<table><tr><td>a <table><thead><tr><td>h</td></tr></thead><tr><td>1<td>2<table><tr><td>deep"
            "</table><td>3</table> b</td><th>x<table><tr><td>in th</table></th><td>c</td></tr><tr><td>d</table>",
            [["a b", "c"], ["1", "2", "3"], ["deep"], ["in th"], ["d"]],
        ),
        (
            "<table><tr><td>1<TABLE class='x'><TBODY><TR><TD>2</TD></TR></TBODY></TABLE></td></tr></table>"
            "<p>between</p><table><tfoot><tr><td>f<table><tr><td>4</table></tfoot><tr><td>5 &amp; 6</td></tr></table>",
            [["1"], ["2"], ["4"], ["5 & 6"]],
        ),
        # A head that is not closed ends where the body begins.
        ("<table><thead><tr><td>h</td></tr><tbody><tr><td>a</td></tr></table>", [["a"]]),
        ("<table><thead><tr><td>h</td></tr></table><table><tr><td>a</td></tr></table>", [["a"]]),
        ("<tr><td>outside</td></tr>", []),
        ("", []),
        (None, []),
    ],
)
def test_table_rows(spark, html, expected):
    assert rows(spark, html) == expected


class Slow(HTMLParser):
    """Rows of nested tables by a stack of open tables."""

    def __init__(self, html):
        super().__init__()
        self.rows, self.open = [], []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.open and not self.open[-1]["cell"]:
                self.open.pop()
            self.open.append({"row": None, "cell": None, "counts": True})
        elif self.open:
            table = self.open[-1]
            if tag in ("tr", "thead", "tbody", "tfoot"):
                table["row"] = table["cell"] = None
                if tag != "tr":
                    table["counts"] = tag == "tbody"
                elif table["counts"]:
                    table["row"] = []
                    self.rows.append(table["row"])
            elif tag in ("td", "th"):
                table["cell"] = [""]
                if tag == "td" and table["row"] is not None:
                    table["row"].append(table["cell"])

    def handle_endtag(self, tag):
        if not self.open:
            return
        table = self.open[-1]
        if tag == "table":
            self.open.pop()
            if self.open and self.open[-1]["cell"]:
                self.open[-1]["cell"][0] += " "
        elif tag in ("td", "th"):
            table["cell"] = None
        elif tag in ("tr", "thead", "tbody", "tfoot"):
            table["row"] = table["cell"] = None
            if tag != "tr":
                table["counts"] = True

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][0] += data

    def result(self):
        return [[" ".join(cell[0].split()) for cell in row] for row in self.rows]


def nested_table(depth):
    inner = nested_table(depth - 1) if depth else st.just("")
    text = st.sampled_from(["", "x", " y ", "1.234"])
    cell = st.tuples(st.sampled_from(["<td>", "<td class=c>", "<th>"]), text, inner, text, st.sampled_from(["</td>", ""]))
    cell = cell.map(lambda c: "".join(c[:4]) + (c[4] if c[0] != "<th>" else "</th>"))
    row = st.lists(cell, max_size=3).map(lambda cells: "<tr>" + "".join(cells) + "</tr>")
    section = st.tuples(st.sampled_from(["", "tbody", "thead", "tfoot"]), st.lists(row, max_size=3)).map(
        lambda s: f"<{s[0]}>{''.join(s[1])}</{s[0]}>" if s[0] else "".join(s[1])
    )
    return st.lists(section, max_size=2).map(lambda s: "<table>" + "".join(s) + "</table>")


def test_nested_tables_against_a_stack(spark):
    found = []

    @settings(max_examples=150, deadline=None, database=None)
    @given(st.lists(nested_table(2), min_size=1, max_size=2).map("<p>t</p>".join))
    def gather(html):
        found.append(html)

    gather()
    pages = spark.createDataFrame(list(enumerate(found)), "page int, html string").repartition(8)
    rows = html_table_rows(pages).orderBy("page", "row_pos").collect()
    got = {k: [] for k in range(len(found))}
    for r in rows:
        got[r.page].append(r.cells)
    assert sum("table><tr" in h or "<table>" in h[7:] for h in found) > 20
    for k, html in enumerate(found):
        assert got[k] == Slow(html).result(), html


def test_long_nested_pages(spark):
    n = 5_000
    row = "<tr><td>{0}<table><tr><td>in {0}</td></tr></table></td><td>after</td></tr>"
    html = "<table>" + "".join(row.format(i) for i in range(n)) + "</table>"
    expected = [cells for i in range(n) for cells in ([str(i), "after"], [f"in {i}"])]
    assert rows(spark, html) == expected


def test_rows_of_other_tags(spark):
    html = '<ul><li><a href="/x">x</a></li><link><li class="b">none</li></ul>'
    assert rows(spark, html, row_tag="li", cell_tag="a", bodies_only=False) == [["x"], []]


def test_long_pages_are_read_to_the_end(spark):
    n = 20_000
    html = "<table><tbody>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(n)) + "</tbody></table>"
    assert rows(spark, html) == [[str(i)] for i in range(n)]


def test_long_cells_with_many_tags(spark):
    html = f"<table><tr><td>{'<b>x</b> ' * 200_000}</td><td>y<!-- - -- --></td></tr></table>"
    assert rows(spark, html) == [[("x " * 200_000).strip(), "y"]]


def test_unclosed_comments_are_not_slow(spark):
    assert rows(spark, "<table><tr><td>a</td></tr></table>" + "<!-- x " * 200_000) == [["a"]]


pages = st.lists(
    st.tuples(st.sampled_from(["c1", "c2", None]), st.integers(0, 12), st.integers(0, 4)),
    unique_by=lambda p: p[:2],
)


@settings(max_examples=6, deadline=None)
@given(pages, st.sampled_from([1, 3, 10_000]))
def test_pages_are_numbered_through(spark, pages, pages_per_block):
    given_rows = [(c, p, i) for c, p, n in pages for i in range(n)]
    df = spark.createDataFrame(given_rows, "c string, p int, row_pos int")
    got = concat_pages(df, "c", "p", pages_per_block=pages_per_block).collect()
    expected, seen = Counter(), Counter()
    for c, p, i in sorted(given_rows, key=lambda r: (r[0] or "", r[1], r[2])):
        seen[c] += 1
        expected[(c, p, i, seen[c])] += 1
    assert Counter(map(tuple, got)) == expected


def test_row_numbers_stay_unique_after_a_filter(spark):
    df = spark.createDataFrame([("c", p, i) for p in (1, 2) for i in range(3)], "c string, p int, row_pos int")
    got = concat_pages(df.where("not (p = 1 and row_pos = 0)"), "c", "p")
    assert sorted((r.row_no, r.p, r.row_pos) for r in got.collect()) == [
        (2, 1, 1), (3, 1, 2), (4, 2, 0), (5, 2, 1), (6, 2, 2)
    ]


def test_counting_rows_does_not_cut_cells(spark):
    df = spark.createDataFrame([(1, "<table></table>")], "p int, html string")
    plan = html_table_rows(df).groupBy("p").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "<td" not in plan and "<tr" in plan


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("c", 1, "<table></table>")], "c string, p int, html string").select("*")
    out = concat_pages(html_table_rows(df), "c", "p").select(F.size("cells"), "row_no")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEval" not in plan and "ArrowEval" not in plan
