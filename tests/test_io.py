"""HTML extraction, fetching, files, the pipeline and streams."""

import json

import pytest
from pyspark.sql import functions as F

from gleaner.html import extract as x
from gleaner.html.dom import Selector, parse
from gleaner.plans.pipeline import Pipeline
from gleaner.sources import fetch, files
from gleaner.streaming.snapshots import new_pages, window_counts


def pages(spark, *docs):
    return spark.createDataFrame([(i, d, "clash") for i, d in enumerate(docs)], "id int, html string, pos string")


MENU = """<section id=lunch class='menu open'><h1>  Thali&nbsp;of the <i>day</i> </h1><p>from ₹180 / plate</p><p>rice & dal
</p><img src="/thali.png" alt=""><a name=top>top</a><a href="menu?day=2">next</a></section>"""


def test_rules(spark):
    mapping = {
        "dish": {"selector": "section.menu h1"}, "price": {"selector": "p", "regex": r"₹(\d+)"}, "unit": {"selector": "p", "regex": r"/ \w+"}, "link": {"selector": "a[href^=menu]", "type": "attribute"}, "alt": {"selector": "img", "type": "attribute", "attribute": "alt"},
        "wine": {"selector": "li.wine", "default": "none"}, "open": {"selector": "#lunch.open", "type": "exists"}, "closed": {"selector": ".closed", "type": "exists"}, "lines": {"selector": "p", "type": "list"}, "targets": {"selector": "a", "type": "attr_list"}, "no rule": 7,
    }
    r = x.extract(pages(spark, MENU, None, ""), "html", ["id", "pos"], mapping).orderBy("id").collect()
    assert tuple(r[0]) == (0, "clash", "Thali of the day", "180", "/ plate", "menu?day=2", "", "none", True, False, ["from ₹180 / plate", "rice & dal"], ["menu?day=2"])
    assert tuple(r[1])[2:] == (None, None, None, None, None, "none", False, False, None, None) == tuple(r[2])[2:]


def test_blocks(spark):
    doc = "<ol><li class='stop late'>Agra <em>07:10</em><li class=stop>Bhopal <em>14:25</em><script>'<li class=stop>'</script></ol><li>Kota"
    r = x.extract_all(pages(spark, doc, None), "html", ["id"], "ol li.stop", {"at": {"selector": "em", "regex": r"^\d+"}}).collect()
    assert [(q["pos"], q["at"], q["_root_classes"]) for q in r] == [(0, "07", ["stop", "late"]), (1, "14", ["stop"])]
    first = x.extract_first_root(pages(spark, doc, "<dl><dt>only</dl>", ""), "html", ["id"], ["table tr", "li.late", "dt"], {"at": {"selector": "em", "default": "?"}}).orderBy("id").collect()
    assert [(q["id"], q["root"], q["at"]) for q in first] == [(0, "li.late", "07:10"), (1, "dt", "?")]


def test_tables(spark):
    t = """<table><caption>Fares<br>2025</caption><tr><th>Route</th><th></th><th>Route</th></tr><tr><td> </td><td>\u00a0</td></tr><tr><td>Pune</td><td>410</td><td>Goa</td><td>x</td></tr><tr><td>Leh</td></tr></table><table><tr><td>one row</td></tr></table><table></table>"""
    r = x.tables(pages(spark, t, None), "html", ["id"]).collect()
    assert len(r) == 1 and r[0]["pos"] == 0 and r[0]["headers"] == ["Route", "", "Route"]
    assert r[0]["caption"].startswith("Fares") and [[(c["name"], c["value"]) for c in row] for row in r[0]["records"]] == [[("Route", "Goa"), ("col_1", "410"), ("col_3", "x")], [("Route", "Leh")]]


def test_jsonld(spark):
    block = lambda v: f'<script type="application/ld+json">{v}</script>'
    doc = block(json.dumps([{"@graph": [{"@type": ["Trip", "Event"], "no": 1}, 5, {"no": 2}]}, {"@type": "EVENT", "no": 3}])) + block("{,}") + block('"text"') + "<script>{}</script>"
    numbers = lambda types: [json.loads(r["body"])["no"] for r in x.jsonld(pages(spark, doc, None), "html", ["id"], types).orderBy("pos").collect()]
    assert numbers(["event"]) == [1, 3] and numbers([]) == [1, 2, 3] and numbers(["trip"]) == [1] and numbers(["Recipe"]) == []


def test_embedded(spark):
    doc = """<script>let seats = 5, plan = 1; const plan = {"rows": [[1, 2], ["]}", 'x']]};
    var plan = {"rows": [[1, 2], ["]}", "it's"]], "free": null};</script><script id='state' type=json>[{"user": {"id": 9}}]</script>"""
    spec = {"cell": {"variable": "plan", "path": "rows[1][0]"}, "quote": {"variable": "plan", "path": "rows[1][1]"}, "free": {"variable": "plan", "path": "free"}, "seats": {"variable": "seats"}, "user": {"script_id": "state", "path": "[0].user.id"}}
    r = x.embedded(pages(spark, doc, None), "html", ["id"], spec).orderBy("id").collect()
    assert tuple(r[0]) == (0, '"]}"', '"it\'s"', None, None, "9") and tuple(r[1]) == (1, None, None, None, None, None)
    assert x.balanced("f([1, {'a': '}'}]) ]", 2) == "[1, {'a': '}'}]" and x.balanced("[[", 0) is None


def test_dom():
    root = parse("<div id=a><p>x <b>y</b><br>z</p><!-- c --><script>s</script></div><div data-k='v w'></div>")
    assert root.text() == "x y z"
    assert [e.name for e in Selector("#a b, div[data-k~=w]").select(root)] == ["b", "div"]
    assert Selector("p").select(root)[0].inner_html() == "x <b>y</b><br/>z"
    assert parse("<b>" * 5000 + "deep").text() == "deep"
    with pytest.raises(ValueError):
        Selector("p:hover")


def test_fetch(spark):
    def transport(url, headers, timeout):
        if url.endswith("robots.txt"):
            return fetch.Response(200, url, "text/plain", b"User-agent: *\nDisallow: /private\n")
        if "broken" in url:
            raise OSError("no route")
        if "latin" in url:
            return fetch.Response(200, url, "text/html; charset=iso-8859-1", "₹".encode())
        return fetch.Response(404 if "absent" in url else 200, url, "text/html", b"page")

    s = fetch.Settings(transport=transport, sleep=lambda t: None, attempts=2)
    urls = ["https://a/1", "https://a/private/x", "https://b/broken", "https://b/absent", "https://c/latin", "nonsense", None, "https://a/1"]
    rows = {r["url"]: r for r in fetch.fetch(spark.createDataFrame([(u,) for u in urls], "url string"), s).collect()}
    assert len(rows) == 6 and rows["https://a/1"]["text"] == "page" and rows["https://c/latin"]["text"] == "₹"
    assert rows["https://a/private/x"]["from_robots_block"] and rows["https://b/broken"]["error"] == "OSError: no route"
    assert rows["https://b/absent"]["error"] == "http-404" and rows["nonsense"]["error"].startswith("ValueError")
    kept = spark.createDataFrame([("https://a/1", "old")], "url string, text string")
    both = {tuple(r) for r in fetch.with_snapshots(spark.createDataFrame([("https://a/1",), ("https://a/2",)], "url string"), kept, s).collect()}
    assert both == {("https://a/1", "old", "cache"), ("https://a/2", "page", "static")}


def test_render_where_extraction_finds_nothing(spark):
    def renderer(url, timeout):
        if "bad" in url:
            raise TimeoutError("slow")
        return "<li>late</li>"

    given = spark.createDataFrame([("u1", "<li>a</li><li>b</li>", "static"), ("u2", "<p>", "cache"), ("bad", "", "static")], "url string, text string, method string")
    read = lambda d: x.extract_all(d, "text", ["url"], "li", {"t": {}}).select("url", "t")
    got = {tuple(r) for r in fetch.extract_or_render(given, read, fetch.Settings(renderer=renderer)).select("url", "t", "method").collect()}
    assert got == {("u1", "a", "static"), ("u1", "b", "static"), ("u2", "late", "dynamic")}
    errors = {r["url"]: r["error"] for r in fetch.render(given.select("url"), fetch.Settings(renderer=renderer)).collect()}
    assert errors == {"u1": None, "u2": None, "bad": "TimeoutError: slow"}
    assert "RendererUnavailable" in fetch.render(given.select("url"), fetch.Settings()).first()["error"]
    assert fetch.extract_or_render(given, read, fetch.Settings()).count() == 2


def test_document_texts(spark):
    docs = spark.createDataFrame([("a", b"x" * 50), ("b", b"scan"), ("c", b"!"), ("d", None)], "path string, content binary")

    def reader(content, pages):
        if content == b"!":
            raise ValueError("damaged")
        return content.decode()

    got = {r["path"]: (r["text"], r["error"]) for r in files.document_texts(docs, reader).collect()}
    assert got == {"a": ("x" * 50, None), "b": (None, None), "c": (None, "ValueError: damaged"), "d": (None, None)}
    with pytest.raises(files.ReaderUnavailable):
        files.document_texts(docs, None)


def test_ledger_and_workbook(spark, tmp_path):
    df = spark.createDataFrame([(1, "</script><b>&"), (2, None)], "a int, t string")
    assert files.write_ledger(df, str(tmp_path / "l.html"), "a<b") == 2
    page = (tmp_path / "l.html").read_text()
    body = page.split('type="application/json">')[1].split("</script>")[0]
    assert [r["t"] for r in json.loads(body)] == ["</script><b>&", None] and "<title>a&lt;b</title>" in page
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        with pytest.raises(files.ExcelUnavailable):
            files.write_excel(df, str(tmp_path / "x.xlsx"))


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert fetch.retry(flaky, 3, 1, 2, 0.25, lambda t: None) == "ok" and len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        fetch.retry(lambda: 1 / 0, 2, 1, 2, 0.25, lambda t: None)


def test_api_and_files(spark, tmp_path):
    bodies = spark.createDataFrame([(1, '{"page": {"hits": [{"q": "a"}, null, 3]}}'), (2, "<xml/>"), (3, None), (4, '{"page": {"hits": {}}}'), (5, '[7]')], "id int, body string")
    assert [(r["id"], r["pos"]) for r in files.api_items(bodies, "body", "page.hits", ["id"]).collect()] == [(1, 0), (1, 1), (1, 2)]
    assert [(r["id"], r["pos"]) for r in files.api_items(bodies, "body", "", ["id"]).collect()] == [(5, 0)]
    (tmp_path / "cards.json").write_text('{"metadata": {}, "data": [{"a": 1}, {"a": 2}]}')
    assert files.json_records(spark, str(tmp_path / "cards.json"), "data").count() == 2
    (tmp_path / "s1.html").write_text("<p>x</p>\n<p>y</p>")
    assert [tuple(r) for r in files.snapshot_pages(spark, str(tmp_path)).collect()] == [("s1", "<p>x</p>\n<p>y</p>")]
    (tmp_path / "r.yaml").write_text("defaults: {tier: B}\nsources: [{key: k, adapter: a}, {key: l, adapter: a, tier: S}]")
    assert [r["tier"] for r in files.registry(spark, str(tmp_path / "r.yaml"), ["a"]).orderBy("key").collect()] == ["B", "S"]
    with pytest.raises(ValueError):
        files.registry(spark, str(tmp_path / "r.yaml"), ["b"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([((1, ["x"]), None), ((2, None), "é")], "a struct<b:int,l:array<string>>, c string")
    assert files.write_json(df, str(tmp_path / "d/x.json")) == 2 and [r["c"] for r in json.loads((tmp_path / "d/x.json").read_text())] == [None, "é"]
    assert files.write_json(df, str(tmp_path / "x.ndjson"), lines=True) == 2 and len((tmp_path / "x.ndjson").read_text().splitlines()) == 2
    files.write_csv(df, str(tmp_path / "x.csv"))
    assert (tmp_path / "x.csv").read_bytes().startswith(b"\xef\xbb\xbfa.b,a.l,c") and not list(tmp_path.glob(".*"))
    files.write_table(df, str(tmp_path / "t"), "csv")
    assert spark.read.option("header", "true").csv(str(tmp_path / "t")).columns == ["a.b", "a.l", "c"]
    assert files.write_json(df.limit(0), str(tmp_path / "e.json")) == 0 and json.loads((tmp_path / "e.json").read_text()) == []


def test_pipeline(spark):
    df = spark.range(3)
    r = Pipeline().add("double", lambda d: d.selectExpr("id * 2 as id")).add("pass", lambda d: None).run(df, materialise=True)
    assert r.ok and sorted(x[0] for x in r.data.collect()) == [0, 2, 4] and [s.rows for s in r.stages] == [3, 3]
    r = Pipeline().add("ok", lambda d: d).add("bad", lambda d: d.select("nope")).add("never", lambda d: d).run(df)
    assert not r.ok and [s.name for s in r.stages] == ["ok", "bad"] and r.data.count() == 3


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("k", "a", 1), ("k", "a", 2), ("k", "b", 3), ("l", "a", 4)], "source_key string, text string, n int")
    rows = rows.withColumn("fetched_at", F.timestamp_seconds(F.col("n") * 60))
    rows.write.parquet(str(tmp_path / "in"))
    for name, df, want in (("pages", lambda s: new_pages(s), 3), ("counts", lambda s: window_counts(s, "fetched_at", "source_key"), 2)):
        s = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        q = df(s).writeStream.format("memory").queryName(name).outputMode("append" if name == "pages" else "complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(120)
        assert spark.table(name).count() == want
