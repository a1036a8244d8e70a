from datetime import date

from doclattice.operators import contract as C
from doclattice.operators import rules

BLOCK = "document_id string, id string, seq long, page int, kind string, text string, source_text string, bbox array<double>, parent_id string, section_id string, marker string, excluded boolean"


def codes(df):
    return sorted((r.code, r.path) for r in df.collect())


def block(i, seq, **over):
    row = {"document_id": "d", "id": i, "seq": seq, "page": 1, "kind": "para", "text": "abc", "source_text": "a b c", "bbox": [0.0, 0.0, 1.0, 1.0], "parent_id": None, "section_id": None, "marker": None, "excluded": False}
    return tuple((row | over).values())


def test_blocks(spark):
    rows = [
        block("a", 0), block("a", 1), block(None, 2), block("p", 3, parent_id="p"), block("q", 4, parent_id="x"), block("l", 5, parent_id="m"), block("m", 6, parent_id="l"), block("n", 7, parent_id="l"),
        block("h", 8, kind="header"), block("b", 9, bbox=[0.0, 0.0, 1.0]), block("c", 10, bbox=[0.0, float("nan"), 1.0, 1.0]), block("e", 11, bbox=[2.0, 0.0, 1.0, 1.0]), block("f", 12, page=3), block("g", 13, kind="?"),
        block("t", 14, text=" 　"), block("u", 15, parent_id="a"),
    ]
    docs = spark.createDataFrame([("d", 2)], "document_id string, page_count int")
    frame = spark.createDataFrame(rows, BLOCK)
    assert codes(C.block_contract(docs, frame)) == sorted([("C04", "?"), ("C04", "a"), ("C05", "p"), ("C05", "q"), ("C05", "p"), ("C05", "l"), ("C05", "m"), ("C05", "n"), ("C10", "h"), ("C11", "b"), ("C11", "c"), ("C11", "e"), ("C12", "f"), ("C13", "g"), ("C16", "t")])
    assert C.block_contract(docs, frame.limit(0)).collect() == []


def test_sections(spark):
    frame = spark.createDataFrame([block("a", 0, section_id="s"), block("b", 1, page=2, section_id="s"), block("c", 2, section_id="z")], BLOCK)
    sections = spark.createDataFrame([("d", "s", "a", ["a", "b"], [1, 2]), ("d", "t", "q", ["b", "y"], [1, 2]), ("d", "u", "c", ["c"], [1, 1]), ("d", "u", "c", ["c"], [1, 1])], "document_id string, section_id string, head_block_id string, block_ids array<string>, page_range array<int>")
    assert codes(C.section_contract(frame, sections)) == [("C06", "c"), ("C06", "u"), ("C07", "t"), ("C07", "t/y"), ("C08", "b"), ("C08", "c"), ("C09", "t")]


def test_texts(spark):
    rows = [block("a", 0), block("b", 1, text="acb"), block("c", 2, text="a\nb"), block("d", 3, text="a\nb", kind="table"), block("e", 4, text="a\x07", source_text="a\x07"), block("f", 5, source_text="a b c\n  ■ d"), block("g", 6, marker="1)", source_text="(1) abc"), block("h", 7, marker="2)"), block("i", 8, text=None), block("j", 9, text="aab", source_text="ab")]
    assert codes(C.text_contract(spark.createDataFrame(rows, BLOCK))) == [("P02", "b"), ("P02", "j"), ("P03", "c"), ("P05", "h"), ("P07", "e"), ("P08", "f")]
    row = [block("a", 0, bbox=[50.0, 0.0, 90.0, 10.0]), block("b", 1, bbox=[0.0, 0.5, 40.0, 10.0]), block("c", 2, bbox=[50.0, 0.0, 90.0, 10.0]), block("e", 3, bbox=[0.0, 20.0, 9.0, 30.0])]
    assert codes(C.order_contract(spark.createDataFrame(row, BLOCK))) == [("P06", "a")]
    assert C.stable_view(spark.createDataFrame([(1, "x")], "a int, path string")).columns == ["a"]


def details(df):
    return sorted((r.rule, r.detail) for r in df.collect())


def test_written_form(spark):
    rows = spark.createDataFrame([
        (1, "para", "총사업비 113,560,000원을 편성함"), (2, "para", "총사업비 금113,560,000원(금일억일천삼백오십육만원)을 편성함"), (3, "table", "5,000원"),
        (4, "para", "지방재정법 제33조에 따라 『지방자치법』 제13조"), (5, "para", "「지방재정법」 제33조에 따라 가격, 품질, 납기를 종합함"), (6, "para", "가격·품질·납기"), (7, "para", None),
    ], "i int, kind string, text string")
    assert details(rules.amount_hits(rows, ["i"])) == [("FMT-04", "113,560,000원")]
    assert details(rules.law_name_hits(rows, ["i"])) == [("FMT-05", "『지방자치법』 제13조"), ("FMT-05", "지방재정법 제33조")]
    assert [r.i for r in rules.enumeration_hits(rows, ["i"]).collect()] == [5]


def test_endings_spare_exempt_spans(spark):
    items = spark.createDataFrame([(1, "관계 부서와 협의하여 추진한다"), (2, "교부할 예정입니다. 추진한다"), (3, "협의 후 추진"), (4, "있다는 점")], "i int, text string")
    exempt = spark.createDataFrame([(2, 0, 10)], "i int, start int, end int")
    assert [(r.i, r.at, r.detail) for r in rules.ending_hits(items, exempt, ["i"]).orderBy("i").collect()] == [(1, 16, "한다"), (2, 15, "한다")]


def test_citations(spark):
    rows = spark.createDataFrame([(1, "「가법」 제3조와 「나법」, 「다법」 제9조", date(2026, 1, 1)), (2, "「가법」 제4조", date(2019, 1, 1))], "i int, text string, written date")
    cited = rules.citations(rows, ["i", "written"])
    register = spark.createDataFrame([("가법", 3, date(2020, 1, 1), date(2025, 1, 1)), ("가법", 4, date(2020, 1, 1), None), ("나법", 1, date(2020, 1, 1), None), ("다법", 1, date(2020, 1, 1), None)], "law string, article long, since date, until date")
    assert details(rules.citation_faults(cited, register.where("law <> '나법'"), ["i", "written"])) == [("LAW-01", "나법"), ("LAW-02", "다법 9"), ("LAW-03", "가법 3"), ("LAW-03", "가법 4")]


def test_no_register_is_broadcast(spark):
    """An exploded register is larger than its estimate, so no join may depend on that."""
    cited = spark.createDataFrame([(1, 10, 1, date(2026, 1, 1)), (2, 20, 9, date(2026, 1, 1)), (3, 30, 1, date(2026, 1, 1)), (4, 10, 2, date(2019, 1, 1))], "i int, law long, article long, written date")
    register = spark.range(10, 30, 10).selectExpr("id law", "explode(sequence(1L, 5L)) article", "date '2020-01-01' since", "cast(null as date) until")
    faults = rules.citation_faults(cited, register, ["i"])
    assert "Broadcast" not in faults._jdf.queryExecution().executedPlan().toString()
    assert details(faults) == [("LAW-01", "30"), ("LAW-02", "20 9"), ("LAW-03", "10 2")]


def test_awaiting_judgement(spark):
    sections = spark.createDataFrame([("d", "s1", "SEC_EFFECT"), ("d", "s2", "SEC_EFFECT"), ("e", "s1", "SEC_PLAN")], "document_id string, section_id string, tag string")
    ann = spark.createDataFrame([("d", "s1", "EFFECT", ["QUANTITATIVE"]), ("d", "s2", "EFFECT", ["QUALITATIVE"]), ("e", "s1", "GROUNDS", [])], "document_id string, section_id string, move string, steps array<string>")
    assert sorted((r.document_id, r.section_id or "", r.rule) for r in rules.awaiting_judgement(sections, ann, ["document_id"]).collect()) == [("d", "", "LAW-05"), ("d", "s2", "EXP-04")]
