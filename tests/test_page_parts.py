"""Parts of the element index, and patterns whose search tests one character per place."""

from pyspark.sql import functions as F

from pagetables.functions import elements as E
from pagetables.functions import markup as M
from pagetables.operators import records as R

PAGE = (
    '<div id=a><p>one<span class="x y">two</span></p><div data-k = "v">three</div></div>'
    "<span hidden>four</span><p data-k=v>five</p><a href='/u?x=1'>six</a>"
)


def test_rules_find_the_same_among_parts(spark):
    pages = E.with_index(spark.createDataFrame([(PAGE,), ("",), (None,)], "html string"), "html", "page")
    parts = E.Page("page").parts(("div", "span", "p"))
    held = pages.withColumns({f"part_{i}": part for i, part in enumerate(parts.values())})
    whole, among = E.Page("page"), E.Page("page", {n: F.col(f"part_{i}") for i, n in enumerate(parts)})
    rules = [
        ("div",), ("span",), ("p",), ("a",), (None, "data-k", "v"), ("p", "data-k", "v"), (None, "hidden"),
        ("span", "class", "y", "~="), ("a", "href", "/u", "^="), (None, "id", "a"), (),
    ]
    read = held.select(*[F.struct(whole.find(*r).alias("a"), among.find(*r).alias("b")).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = read.collect()
    assert all(cell["a"] == cell["b"] for row in rows for cell in row)
    assert [len(cell["a"]) for cell in rows[0]] == [2, 2, 2, 1, 2, 1, 0, 1, 1, 1, 7]


def test_dom_record_looks_through_parts(spark):
    plan = R.dom_record(spark.createDataFrame([("u", PAGE)], "url string, html string"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"__part_{i}" in text for i in range(4))


def test_hidden_parts_and_state(spark):
    from pagetables.functions import state as S

    html = (
        '<!-- <script id="__NEXT_DATA__">{"a":0}</script> --><SCRIPT>var x = "<b>"</SCRIPT>'
        '<script type=x id="__NEXT_DATA__">{"a":1}</script><style>p</style>t<!-->u'
    )
    df = spark.createDataFrame([(html,)], "html string")
    row = df.select(S.state_json(F.col("html")), M.hide(F.col("html"))).first()
    assert row[0] == '{"a":1}'
    assert row[1] == "<x><x><x><x>t<x>"
    assert M._HIDDEN.startswith("(?i)<(?:")
