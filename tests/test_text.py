import time

import pytest
from lawloom.functions import text as X
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def run(spark):
    def one(column, *docs):
        df = spark.createDataFrame(list(enumerate(docs)), "i int, x string")
        return [r["v"] for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]

    return one


def test_all_text(run):
    docs = [
        "<a>x<b>y</b> z</a>", "<a><b/><c>1</c><d>2</d></a>", "<a>p<!-- no <b> -->q</a>",
        "<a>&lt;tag&gt; &amp;amp; &#8212;&#x2014;&#0;</a>", "<a>x<![CDATA[<raw> &amp;]]>y</a>", "", "plain",
    ]
    assert run(X.all_text, *docs) == ["x y  z", "1 2", "p q", "<tag> &amp; ——&#0;", "x<raw> &amp;y", "", "plain"]


def test_children_and_bill_text(run):
    doc = (
        '<!DOCTYPE bill PUBLIC "-//X" "bill.dtd">\n<?pi x?><bill a="1"><metadata>m</metadata><form>F <x>y</x></form>'
        "  <blank> \n</blank><empty/><u:body>one\t\ttwo \n  three<i>!</i></u:body>tail</bill>"
    )
    names = run(lambda x: F.transform(X.children(x), lambda c: c["name"]), doc)[0]
    assert names == ["metadata", "form", "blank", "empty", "body"]
    assert run(X.bill_text, doc) == ["F y\n\nonetwo three !"]


def test_odd_documents_do_not_fail(run):
    docs = ["", "no markup", "<a>", "<a><b>x</b>", "<a></a></a>", "<", "<a><b>x</b></a>"]
    assert run(X.bill_text, *docs) == ["", "", "", "x", "", "", "x"]
    assert run(X.is_balanced, *docs) == [True, True, False, False, False, False, True]


def test_sections_in_given_order(run):
    doc = "<r><b>two  words</b><a x='1'>one</a><b>again</b></r>"
    assert run(lambda x: X.section_text(x, ("a", "zz", "b")), doc) == ["one\n\ntwo words"]
    assert run(lambda x: X.element_text(x, "zz"), doc) == [None]


def test_spaces(run):
    assert run(X.singular_spaces, " a\t\n b c ") == ["a b c"]
    assert run(X.strip_spaces, " \n x y\t") == ["x y"]
    assert run(X.tidy_spaces, " a\tb  c\nd ") == ["ab c d"]


def test_depth_two_names(run):
    doc = "<s><v>1</v><bill><n>1</n><t/><n>2</n></bill></s>"
    assert run(lambda x: X.child_names(x, 2), doc) == [["n", "t", "n"]]


def test_many_children_stay_linear(spark):
    """Four times the children must not take anything like sixteen times as long."""
    def seconds(n):
        df = spark.range(1).select(F.concat(F.lit("<r>"), F.repeat(F.lit("<p>some text</p>"), n), F.lit("</r>")).alias("x"))
        start = time.perf_counter()
        assert df.select(F.size(X.children(F.col("x")))).first()[0] == n
        return time.perf_counter() - start

    seconds(1000)
    small, large = seconds(10_000), seconds(40_000)
    assert large < 9 * small + 2


def test_broken_documents_are_named(spark):
    texts = {
        "cut": "<bill><form>keep</form><legis-body><section>lost text",
        "mistagged": "<bill><form>keep</form><legis-body>b</legis-boody></bill>",
        "good": '<?xml version="1.0"?>\n<!DOCTYPE bill PUBLIC "x" "bill.dtd">\n<bill a="1"><form>k &amp; l</form><x/></bill>',
    }
    df = spark.createDataFrame(list(texts.items()), "name string, xml string")
    got = {r["name"]: r["bad"] for r in df.select("name", X.is_malformed(F.col("xml")).alias("bad")).collect()}
    assert got == {"cut": True, "mistagged": True, "good": False}


def test_one_scan_gives_children_and_balance(spark):
    docs = ["<a><b>x</b><c/></a>", "<a><b>x</b>", "", None, "plain", "<?xml version='1.0'?><!DOCTYPE a><a>t<b/></a>"]
    df = spark.createDataFrame([(d,) for d in docs], "xml string")
    xml = F.col("xml")
    rows = df.select(X.scanned(xml).alias("s"), X.children(xml).alias("c"), X.is_balanced(xml).alias("b")).collect()
    assert all(r["s"]["children"] == r["c"] and r["s"]["is_balanced"] == r["b"] for r in rows)
    one = df.select(F.inline(F.array(X.scanned(xml)))).select(X.text_of_children(F.col("children")), "is_balanced")
    assert one._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(xml") == 1


def test_tags_of_several_parents(spark):
    from lawloom.operators.profile import tag_counts

    df = spark.createDataFrame([("<r><bill><a/><b>x</b></bill><other><z/></other><bill x='1'><a>y</a></bill></r>",), ("<r/>",)], "xml string")
    assert {r["tag"]: r["n"] for r in tag_counts(df, "xml", "bill").collect()} == {"a": 2, "b": 1}
