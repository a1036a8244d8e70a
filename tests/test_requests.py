from pyspark.sql import functions as F

from doclattice.functions import text as T
from doclattice.operators import requests as R
from doclattice.operators import rules, validate


def blocks(spark, n=6, size=5):
    rows = [("d", f"b{i}", i, f"s{i // 2}", "x" * size + str(i), 1, "excluded" if i == 5 else "context" if i == 0 else "target") for i in range(n)]
    return spark.createDataFrame(rows, "document_id string, block_id string, seq long, section_id string, text string, units long, class string")


def test_requests(spark):
    whole = R.block_requests(blocks(spark), limit=2).orderBy("chunk").collect()
    assert [[t.block_id for t in r.targets] for r in whole] == [["b1"], ["b2", "b3"], ["b4"]]
    assert {r.context_kind for r in whole} == {"document"} and "[b0] xxxxx0" in whole[0].context and "b5" not in whole[0].context
    local = R.block_requests(blocks(spark), limit=2, full=10).orderBy("chunk").collect()
    assert {r.context_kind for r in local} == {"local"} and "b1" not in local[0].context and "[b0]" in local[0].context
    assert len({r.request_id for r in whole + local}) == 6
    again = R.block_requests(blocks(spark), limit=2).orderBy("chunk").collect()
    assert [r.request_id for r in again] == [r.request_id for r in whole]
    assert R.document_requests(blocks(spark)).count() == 1
    texts = spark.createDataFrame([("d", "everything")], "document_id string, document_text string")
    assert {r.context for r in R.widened(R.block_requests(blocks(spark), 2, 10), texts).collect()} == {"everything"}


def test_spans_and_assembly(spark):
    ann = spark.createDataFrame([("d", "b1", "x", None), ("d", "b2", "zz", None)], "document_id string, block_id string, quote string, occurrence int")
    got = {r.block_id: r for r in R.resolved_spans(ann, spark.createDataFrame([("d", "b1", "axb"), ("d", "b2", "zzz")], "document_id string, block_id string, text string")).collect()}
    assert (got["b1"].start, got["b1"].end, got["b2"].reason) == (1, 2, "ambiguous")
    assert spark.range(1).select(R.occurrence_number(F.lit("zzz"), F.lit("zz"), F.lit(1)), R.occurrence_number(F.lit("zzz"), F.lit("zz"), F.lit(2))).first()[:] == (2, None)
    ddl = "document_id string, block_id string, seq long, label string"
    failed = spark.createDataFrame([("d", "b2", ["V09"])], "document_id string, block_id string, codes array<string>")
    out = R.assembled(spark.createDataFrame([("d",), ("e",)], "document_id string"), spark.createDataFrame([("d", "b3", 3, "m"), ("d", "b2", 2, "n")], ddl), failed, spark.createDataFrame([("d", "b1", 1, "table")], ddl)).orderBy("document_id").collect()
    assert [b.block_id for b in out[0].blocks] == ["b1", "b3"] and out[0].failed_units[0].codes == ["V09"] and out[1].blocks == []


def test_regions_and_warnings(spark):
    ddl = "page int, block_id string, seq long, kind string, x0 double, y0 double, x1 double, y1 double"
    b = spark.createDataFrame([(1, "a", 1, "para", 0.0, 0.0, 10.0, 10.0), (1, "b", 2, "para", 0.0, 12.0, 10.0, 20.0), (1, "c", 3, "para", 0.0, 60.0, 10.0, 70.0)], ddl)
    r = spark.createDataFrame([(1, 7, -1.0, -1.0, 20.0, 25.0), (1, 8, -1.0, 68.0, 20.0, 90.0)], "page int, region int, x0 double, y0 double, x1 double, y1 double")
    assert sorted((x.block_id, x.kind) for x in R.replace_contained(b, r, ["page"]).collect()) == [("c", "para"), ("region-7", "approval")]
    w = spark.createDataFrame([(1, "table_grid_sparse", 0.5, 0.0, 10.0, 10.0), (1, "table_geometry_ambiguous", 0.0, 0.0, 10.0, 10.0), (1, "table_grid_sparse", 5.0, 0.0, 10.0, 10.0)], "page int, code string, x0 double, y0 double, x1 double, y1 double")
    assert [tuple(x) for x in R.structure_warnings(b, w, ["page"]).collect()] == [(1, "a", ["table_geometry_ambiguous", "table_grid_sparse"])]


def test_source_scope(spark):
    rows = [("https://h.example/p/a.pdf?x=1", None), ("http://h.example/p/a.pdf", "scheme"), ("https://other/p/a.pdf", "host"), ("https://u:p@h.example/p/a.pdf", "userinfo"), ("https://h.example/p/a.pdf#f", "fragment"), ("https://h.example/p/../a.pdf", "traversal"), ("https://h.example/p/b.pdf", "path"), (None, "scheme")]
    df = spark.createDataFrame(rows, "url string, want string")
    assert [r[0] for r in df.select(R.source_scope(F.col("url"), "h.example", "p/", F.lit("p/a.pdf"))).collect()] == [w for _, w in rows]


def test_cells(spark):
    rows = [([("2021. 10. 1.~", 0.0), ("10. 2.", 0.0)],), ([("2021. 10. 1.~", 0.0), ("1. 개요", 0.0)],), ([("가", 0.0), ("나", 1.0)],), ([("one ", 0.0), ("two", 0.0)],)]
    df = spark.createDataFrame(rows, "lines array<struct<text:string,x0:double>>")
    assert [r[0] for r in df.select(T.cell_join(F.col("lines"))["text"]).collect()] == ["2021. 10. 1.~10. 2.", "2021. 10. 1.~ 1. 개요", "가나", "one two"]
    grids = spark.createDataFrame([([["Ⅰ", ""], ["", "추진 배경"]],), ([["1", "a"]],), ([["x", "title"]],)], "rows array<array<string>>")
    assert [r[0] for r in grids.select(T.heading_from_grid(F.col("rows"))["text"]).collect()] == ["추진 배경", None, None]


def test_more_rules(spark):
    text = lambda *x: spark.createDataFrame(list(enumerate(x)), "k int, text string")
    keys = lambda df: sorted(r.k for r in df.collect())
    assert keys(rules.period_hits(text("2026. 1. 1. ~ 2026. 2. 1.", "2026. 1. 1.~2026. 2. 1."), ["k"])) == [0]
    assert keys(rules.clock_hits(text("오후 3시", "15:00", "3시 30분"), ["k"])) == [0, 2]
    assert keys(rules.weekday_hits(text("2026. 11. 26.(목)", "2026. 11. 26.(금)", "2026. 2. 30.(월)"), ["k"])) == [1]
    assert keys(rules.vague_words(text("적극 추진", "적극 3회"), spark.createDataFrame([("적극",)], "word string"), ["k"])) == [0]
    kinds = spark.createDataFrame([(1, 0, "table"), (1, 1, "table"), (1, 2, "para"), (1, 3, "table")], "k int, seq int, kind string")
    assert [(r.k, r.seq) for r in rules.bare_tables(kinds, ["k"], "seq").collect()] == [(1, 0)]
    parts = spark.createDataFrame([(1, "s", "SEC_OVERVIEW", 1, p) for p in (1, 1, 1, 2, 3, 3)] + [(2, "s", "SEC_ANNEX", 1, p) for p in (1, 2, 3)], "k int, section string, tag string, line_count int, page int")
    assert keys(rules.long_overviews(parts, ["k"])) == [1] and keys(rules.long_bodies(parts, ["k"])) == [1]
    assert keys(rules.count_mismatches(text("총 3건", "2개", "none"), spark.createDataFrame([(0,), (0,), (1,), (1,)], "k int"), ["k"])) == [0]
    assert keys(rules.long_titles(spark.createDataFrame([(1, "가" * 21), (2, "가" * 20)], "k int, title string"), ["k"])) == [1]


def test_more_codes(spark):
    codes = lambda df: sorted((r.code, r.message) for r in df.collect())
    answers = [("r1", "{"), ("r2", '{"schema_version":"1.0"}'), ("r3", '{"schema_version":"1.2.0","request_id":"x"}'), ("r4", '{"schema_version":"1.2.0","request_id":"r4"}')]
    assert codes(validate.response_gate(spark.createDataFrame(answers, "request_id string, response string"))) == [("V00", "not JSON"), ("V01", "another request"), ("V01", "version")]
    cells = spark.createDataFrame([(1, 0, 0, None), (1, 1, 0, None), (1, 2, 0, 1)], "t int, row int, col int, from_row int")
    spans = spark.createDataFrame([(1, 1, 0, 0), (1, 1, 1, 0), (1, 1, 2, 0), (1, 1, 9, 9)], "t int, unit_row int, row int, col int")
    assert codes(validate.cell_issues(spans, cells, spark.createDataFrame([(1, 0)], "t int, row int"), ["t"])) == [("V10", "cell inherited"), ("V10", "cell of another row"), ("V10", "cell out of range")]
    rows = spark.createDataFrame([(1, 0, "header", 0), (1, 1, "body", 0), (2, 0, "odd", 1), (2, 0, "body", 1)], "t int, row int, role string, n_annotations int")
    assert codes(validate.table_issues(rows, spark.createDataFrame([(1, 2), (2, 2), (3, 0)], "t int, n_rows int"), ["t"])) == [("V11", "body row without annotation"), ("V11", "role"), ("V11", "rows"), ("V11", "rows")]
    ctx = spark.createDataFrame([(1, "d", "b1"), (1, "d", "b9")], "q int, document_id string, context_id string")
    assert codes(validate.context_issues(ctx, spark.createDataFrame([("d", "b1")], "document_id string, block_id string"), ["q"])) == [("V13", "context")]
    labels = spark.createDataFrame([("d", "plan", ["t"], "why", "b1", "x", None), ("e", "odd", ["u"], " ", "b1", "q", None)], "document_id string, type string, topics array<string>, outline_reason string, block_id string, quote string, occurrence int")
    texts = spark.createDataFrame([("d", "b1", "axb"), ("e", "b1", "none")], "document_id string, block_id string, text string")
    assert codes(validate.document_issues(labels, texts, ("plan",), ("t",))) == [("D01", "evidence"), ("D01", "reason"), ("D01", "topics"), ("D01", "type")]
