"""Quality rules, mixing, HTML layout."""

import html.parser
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from bancalyt.llm import html_layout, mixing, quality, queries

SF = "/root/testdata/sf0.001"


def from_sql(sql, docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    return con.execute(sql).fetchall()


def by(rows):
    return sorted((tuple(r) for r in rows), key=repr)


LINE = "the same line of words stands here\n"
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "one two three four five six seven eight nine ten"),
         (6, LINE * 6), (6, LINE * 6), (None, "a b c d e f g h i j k l m n o p " + LINE * 2), (7, "Éé ñ <|#*$%&> " * 30),
         (8, "\n\nx y z\n\nx y z\n" + " ".join(f"w{i}" for i in range(200))), (9, "w " * 5000)]


def docs(spark, rows=TEXTS):
    out = spark.createDataFrame([(i, t, "en" if i != 4 else None) for i, t in rows], "doc_id long, text string, source string")
    return out.withColumn("n_words", F.lit("x")).withColumn("_q_kept", F.lit(1)).withColumn("_size", F.lit(2))


def test_quality_matches_sql(spark):
    table = docs(spark)
    assert by(quality.report(table).collect()) == by(from_sql(quality.oracle("documents"), table.select("doc_id", "text")))


def test_quality_on_the_test_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert by(quality.report(table).collect()) == by(from_sql(quality.oracle("documents"), table))


def test_quality_verdicts(spark):
    kept = {r.doc_id: r.kept for r in quality.report(docs(spark)).collect()}
    assert kept == {1: False, 2: False, 3: False, 4: False, 5: True, 6: False, None: False, 7: False, 8: True, 9: False}


def test_accepted_rows_keep_their_columns(spark):
    table = docs(spark)
    out = quality.accepted(table)
    assert out.columns == table.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["5", "8"]


def test_quality_of_an_empty_table(spark):
    assert quality.report(docs(spark, [])).collect() == []


SIZES = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{i % 4}" if i % 9 else None) for i in range(300)]
SIZES += [(1000, None, "s0"), (1001, "", "empty"), (None, "a b c", "s1"), (5, SIZES[5][1], "s1"), (5, SIZES[5][1], "s1"), (1002, "x " * 400, "tiny")]


def sources(spark, rows=SIZES):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("t")).withColumn("s", F.lit(1))


def test_mixing_matches_sql(spark):
    table = sources(spark)
    assert by(mixing.mix_report(table).collect()) == by(from_sql(mixing.ORACLE.format(documents="documents"), table.select("doc_id", "text", "source")))


def water_fill(sizes, weights, cap):
    """Shares by weight; what is above a cap is shared anew among the others."""
    goal, closed = dict.fromkeys(sizes, 0.0), set()
    while len(closed) < len(sizes):
        left = sum(sizes.values()) - sum(goal[s] for s in closed)
        total = sum(weights[s] for s in sizes if s not in closed)
        goal |= {s: left * weights[s] / total for s in sizes if s not in closed}
        over = {s for s in sizes if s not in closed and goal[s] >= cap * sizes[s]}
        if not over:
            break
        goal |= {s: float(cap * sizes[s]) for s in over}
        closed |= over
    return goal


def test_mixing_meets_its_targets(spark):
    rows = mixing.mix_report(sources(spark)).join(spark.createDataFrame([], "x int"), F.lit(False), "left").collect()
    where = {(r.doc_id, len((r.text or "").split())): r.source for r in sources(spark).collect()}
    size, taken, goal, largest = {}, {}, {}, {}
    for r in rows:
        s = where[r.doc_id, r["size"]]
        size[s] = size.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        goal[s] = r.target
        largest[s] = max(largest.get(s, 0), r["size"])
        assert r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    want = water_fill(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 3)
    assert all(abs(goal[s] - want[s]) < 1e-6 for s in names)
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 for s in names)


def test_mixed_rows_are_repeated_as_reported(spark):
    table = sources(spark)
    out = mixing.mixed(table)
    assert out.columns == table.columns
    want = mixing.mix_report(table).where("size > 0").groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0")
    got = out.withColumn("n", F.size(F.split("text", " "))).where("text <> ''")
    got = got.withColumn("n", F.expr("regexp_count(text, '[^ ]+')")).where("n > 0").groupBy("doc_id").agg(F.sum("n").alias("n"))
    assert by(got.collect()) == by(want.collect())


def test_mixing_of_equal_ids_and_sizes_agrees_on_reruns(spark):
    rows = [(None, "s", f"w{i} x y") for i in range(60)] + [(None, "t", f"v{i} x y") for i in range(60)] + [(7, "u", f"{i} x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    runs = [sorted(map(repr, mixing.mixed(docs.orderBy(F.rand(seed)).repartition(1 + seed)).collect())) for seed in range(3)]
    assert runs[0] == runs[1] == runs[2] and 0 < len(set(runs[0])) < len(rows)


def test_mixing_of_nothing(spark):
    assert mixing.mix_report(sources(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix_report(sources(spark, [(1, None, None)])).collect()] == [0]


def test_mixing_is_native(spark, tmp_path):
    plan = queries.op9_mixing(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


PAGES = {
    "": "", "plain": "plain", "<": "<", "<p": "", "</p>": "", "&amp;&lt;x&copy": "&<x©",
    "<p>a<p>b<br>c": "a\n\nb\nc",
    "<div>a</div><div>b <b>c</b>d</div>": "a\nb cd",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "- a\n- b\n  - c\n- d\n\ne",
    "<ol start=9><li>a<li>b</ol>": "9. a\n10. b",
    "x<script>if (a < b) document.write('<p>no</p>')</script>y<style>p{}</style><!-- <p>no --> z": "xy z",
    "<head><title>no</title><body>yes": "yes",
    "<p hidden>no</p><p style='Display : none'>no<p style=\"visibility:hidden\">no<p>yes<span hidden>no</span>": "yes",
    "<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>b<td>22</table>": "name       n\nlong name  1\nb          22",
    "<table><td>a<td>b</table>": "a  b", "<table>x<tr>y<td>z</table>": "x\ny  z",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "<pre>a  b\n  c</pre>d": "a  b\n  c\n\nd",
    "<blockquote>q</blockquote><dl><dt>t<dd>d</dl>": "  q\n\nt\n  d",
    "a\n\n  b\tc": "a b c", "<p>a</i></b></p>b": "a\n\nb", "<a href='x>y'>l</a>": "l", "é日本<hr>x": "é日本\n\n---\n\nx",
    "<select><option>a<option>b</select>": "a\nb", "<script>never closed <p>x": "", "<textarea><b>t</b></textarea>": "<b>t</b>",
    "<div title=it's>Hello all</div><p>we don't know</p><p>end</p>": "Hello all\n\nwe don't know\n\nend",
    '<a href="x"">one</a><p>two</p><b class="y"">three</b><p>four</p>': "one\n\ntwo\n\nthree\n\nfour",
    """<a b' c = "d>'" e=f"g'>one</a> <i title=a"hidden>two</i> it's <a x='>'y=">">three</a '>""": "one two it's three",
    '<p>a<p title="never closed>b</p><p>it\'s': "a\n\nb\n\nit's", '<a href= >a</a><a =">">b</a>': 'a">b',
    "so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn> 2 </mn></mfrac></math>, then": "so x = 1 2 , then",
    "<math><semantics><mrow><mi>a</mi><mspace/><mtext>is <b>b</b></mtext></mrow><annotation>no</annotation></semantics></math>": "a is b",
    "a<svg><title/><style/><defs><text>no</text></defs><rect/><g><text x=1>b<tspan>c</tspan><tspan x=2>d</tspan></text><path d='M'/></g>no</svg>e": "a bc d e",
    "<svg><foreignObject><div>a</div></foreignObject><text>b<![CDATA[ < c]]></text><text display=none>no</text></svg>": "a\nb < c",
    "<svg><circle/>no<p>shown": "shown", "<svg/>a<math/>b": "ab", "x<svg><title>no</title><path/></svg>y": "xy",
    "<table><tr><td rowspan=2>A<td>B<td>C<tr><td>D<td>E<tr><td>F<td>G</table>": "A  B  C\n   D  E\nF  G",
    "<table><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td>E</table>": "A  B\n   C\nD  E",
    "<table><tr><td>a<td rowspan=2>bb<td>c<tr><td>d<td>e</table>": "a  bb  c\nd      e",
    "<table><tr><td colspan=2>wide cell<td>c<tr><td>a<td>b<td>d</table>": "wide cell  c\na  b       d",
    f"<table><tr><td>{'w' * 70}<td>x<tr><td>a<td>b</table>": f"{'w' * 70}  x\na{' ' * 71}b",
    "<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p>no</div>": "yes",
    "<ul style='visibility:hidden'><li>no<li style='visibility: visible'>b<ul><li>c</ul></ul>": "- b\n  - c",
    "<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>": "yes",
    "<svg style='visibility:hidden'><text>no<tspan style='visibility:visible'>yes</tspan></text></svg>": "yes",
    "a<input type=submit value='Send it'>b<input type=text value=no><input type=button value=Go>": "a Send it b Go",
    "<style>.x, #i {display:none} p.y{visibility:hidden} b { color:red }</style><p class='z x'>no<p id=i>no<p class=y>no<i style='visibility:visible'>yes</i><div class=y>and</div>": "yes\n\nand",
    "<style>/* p{display:none} */ @media print { p {display:none} } .x{display:none} div.x{display:block}</style><p>a<div class=x>b</div><p class=x style='display:block'>c<p class=x>no": "a\n\nb\n\nc",
}


@pytest.mark.parametrize("page", PAGES)
def test_layout(page):
    assert html_layout.visible_text(page) == PAGES[page]


def test_layout_of_deep_and_of_unclosed_pages():
    assert html_layout.visible_text("<div>" * 20_000 + "deep") == "deep"
    assert html_layout.visible_text("<b" * 2_000) == "" and html_layout.visible_text("<table>" * 300 + "x").strip() == "x"


def test_long_cells_of_many_rows_stay_short():
    """Nothing is lost and rows keep their order where full alignment would be too long."""
    page = "<table>" + f"<tr><td>{'w' * 50_000}<td>x" + "<tr><td>a<td>b" * 5_000 + "</table>"
    text = html_layout.visible_text(page)
    assert text.split() == ["w" * 50_000, "x", *["a", "b"] * 5_000] and len(text) < 20 * len(page)


class PlainLayout(html.parser.HTMLParser):
    """Lines of pages without tables, by events in order; a block ends the paragraph before it."""

    def __init__(self, page):
        super().__init__()
        self.lines, self.line, self.gap, self.unseen, self.lists, self.marker, self.in_p = [], "", False, 0, 0, "", False
        self.feed(page)
        self.close()
        self.put()

    def put(self, forced=False):
        text = " ".join(self.line.split(" ")).strip()
        self.line = ""
        if text or forced:
            if self.gap and self.lines:
                self.lines.append("")
            margin = "  " * max(self.lists - bool(self.marker), 0)
            self.gap, self.lines = False, [*self.lines, (margin + self.marker + text).rstrip()]
            self.marker = ""

    def edge(self, tag):
        if tag in ("p", "h1", "ul", "li", "div", "nav", "article", "footer", "body"):
            self.put()
            self.gap = self.gap or tag in ("p", "h1", "ul") or self.in_p
            self.in_p = False

    def handle_starttag(self, tag, attrs):
        self.unseen += tag in ("head", "script", "style", "title")
        self.edge(tag)
        self.in_p = self.in_p or tag == "p"
        if tag == "br":
            self.put(forced=True)
        if tag == "li":
            self.marker, self.lists = "- ", self.lists + 1

    def handle_endtag(self, tag):
        self.unseen -= tag in ("head", "script", "style", "title")
        self.edge(tag)
        self.lists -= tag == "li"

    def handle_data(self, data):
        if not self.unseen:
            self.line += re.sub(r"[ \t\n\r\f]+", " ", data)
            self.line = re.sub(" +", " ", self.line)


def test_layout_of_the_test_table_against_plain_events(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.op5_html_layout(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(pages) > 100
    for r in pages:
        assert got[r.page_id].split("\n") == (PlainLayout(r.html or "").lines or [""])


def test_layout_rows(spark):
    pages = spark.createDataFrame([(1, None), (1, "<p>a"), (1, "<p>a"), (None, "b"), (2, "")], "page_id long, html string").withColumn("text", F.lit(7))
    assert by(html_layout.extract(pages).collect()) == by([(1, 0, ""), (1, 1, "a"), (1, 1, "a"), (None, 1, "b"), (2, 0, "")])
    assert html_layout.extract(pages.where("page_id > 9")).collect() == []


def test_layout_of_the_test_table_loses_no_visible_word(spark):
    for r in queries.op5_html_layout(spark, SF).join(spark.read.parquet(os.path.join(SF, "pages.parquet")), "page_id").limit(60).collect():
        body = re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1>|<head\b.*?</head>", " ", r.html)
        import html as entities

        want = entities.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        got = [w for w in r.text.split()]
        assert [w for w in got if w != "-"] == [w for w in want if w != "-"]
