import random

from pyspark.sql import functions as F

from doclattice.operators import page as P

LINE = "doc int, page int, line_no long, text string, x0 double, y0 double, x1 double, y1 double, size double, is_bold boolean, height double"


def lines(spark, rows):
    return spark.createDataFrame([(*r, 1000.0) for r in rows], LINE)


def line(n, text, x0, y0, x1=None, size=10.0, page=1, doc=1, bold=False):
    return (doc, page, n, text, float(x0), float(y0), float(x0 + 5 * len(text) if x1 is None else x1), float(y0 + 10), float(size), bold)


def test_running_elements(spark):
    rows = []
    for p in range(1, 6):
        rows += [line(0, f"Report {p}", 50 + p, 20, page=p), line(1, f"{p}", 300, 950, page=p), line(2, "- 3 -", 300, 885, page=p), line(3, "body", 50, 500, page=p)]
    rows += [line(4, "7", 50, 30, page=1), line(5, "beside", 100, 32, page=1), line(6, "Report 9", 400, 20, page=1), line(7, "출력: 부서/홍길동(2024-01-02 03:04:05)", 50, 970, page=2), line(8, "once", 50, 940, page=3)]
    got = {(r.page, r.line_no): r.running for r in P.running_elements(lines(spark, rows), ["doc"]).collect()}
    for p in range(1, 6):
        assert [got[p, n] for n in range(4)] == ["header", "page_number", "page_number", None]
    assert (got[1, 4], got[1, 5], got[1, 6], got[2, 7], got[3, 8]) == (None, None, None, "footer", None)


def test_running_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [line(n, rng.choice(["a 1", "a 2", "b"]), rng.choice([50, 53, 57, 60, 200]), rng.choice([10, 15, 21, 40]), page=p) for p in range(1, 8) for n in range(3)]
    got = {(r.page, r.line_no): r.running for r in P.running_elements(lines(spark, rows), ["doc"]).collect()}
    mask = lambda t: "a #" if t[0] == "a" else t
    for _, p, n, text, x0, y0, *_ in rows:
        pages = {r[1] for r in rows if mask(r[3]) == mask(text) and abs(r[4] - x0) <= 6 and abs(r[5] / 1000 - y0 / 1000) <= 0.01}
        assert got[p, n] == ("header" if len(pages) >= 5 else None)


def row_pieces(*rows):
    return [P.Piece(n, t, x0, y0, x1, y0 + 10, size, False, x0, x1) for n, (t, x0, x1, y0, size) in enumerate(rows)]


def test_rows_are_joined():
    join = lambda *rows: [(p.text, sorted(p.steps)) for p in P.join_rows(row_pieces(*rows))]
    assert join(("개", 0, 10, 0, 10), ("요", 15, 25, 0, 10)) == [("개요", ["visual_row_joined"])]
    assert join(("1", 0, 10, 0, 10), ("추진 배경", 40, 90, 0, 10)) == [("1. 추진 배경", ["section_number_joined"])]
    assert join(("Ⅱ", 0, 10, 0, 10), ("결과", 60, 90, 0, 10)) == [("Ⅱ", []), ("결과", [])]
    assert join(("붙임 2", 0, 20, 0, 10), ("명단", 30, 50, 0, 10)) == [("붙임 2 명단", ["attachment_label_joined"])]
    assert join(("어절이", 0, 30, 0, 10), ("끊긴", 32, 50, 0, 10), ("멀리", 90, 110, 0, 10)) == [("어절이 끊긴", ["row_fragments_joined"]), ("멀리", [])]
    assert join(("○ 일", 0, 20, 0, 10), ("자 :", 45, 60, 0, 10)) == [("○ 일자 :", ["row_fragments_joined"])]
    assert join(("word", 0, 20, 0, 10), ("12", 22, 30, 0, 10)) == [("word", []), ("12", [])]
    assert [p.text for p in P.join_rows(row_pieces(("어절이", 0, 30, 0, 10), ("끊긴", 36, 50, 0, 10)), [(33.0, -1.0, 12.0)])] == ["어절이", "끊긴"]
    assert join(("right", 60, 80, 0.0, 10), ("left", 0, 20, 0.4, 10)) == [("left", []), ("right", [])]


def test_letters_in_a_column():
    found = P.join_columns(row_pieces(("의", 10, 20, 0, 10), ("other", 100, 120, 0, 10), ("무", 10.4, 20, 11, 10), ("기", 10, 20, 60, 10)))
    assert [p.text for p in found] == ["의무", "other", "기"]


def wrapped(*rows, barriers=(), rules=()):
    return [p.text for p in P.wrap(row_pieces(*rows), barriers, rules)]


def test_wrapping():
    first, rest = ("문장이 길게 이어져서 ", 0, 200, 0, 10), ("다음 줄로 넘어간다", 0, 90, 12, 10)
    assert wrapped(first, rest) == ["문장이 길게 이어져서 다음 줄로 넘어간다"]
    assert wrapped(first, ("- 새 항목", 0, 90, 12, 10)) == ["문장이 길게 이어져서 ", "- 새 항목"]
    assert wrapped(first, ("다음 줄", 0, 90, 30, 10)) == ["문장이 길게 이어져서 ", "다음 줄"]
    assert wrapped(first, ("다음 줄", 0, 90, 12, 14)) == ["문장이 길게 이어져서 ", "다음 줄"]
    assert wrapped(first, ("다음 줄", 60, 150, 12, 10)) == ["문장이 길게 이어져서 ", "다음 줄"]
    assert wrapped(("짧다", 0, 40, 0, 10), rest, ("끝까지 가는 줄", 0, 200, 60, 10)) == ["짧다", "다음 줄로 넘어간다", "끝까지 가는 줄"]
    assert wrapped(first, ("다음 줄로 넘어간다", 0, 90, 18, 10), barriers=[(0.0, 8.0, 200.0, 20.0)]) == ["문장이 길게 이어져서 ", "다음 줄로 넘어간다"]
    assert wrapped(first, rest, barriers=[(-12.0, 13.0, -2.0, 22.0)]) == ["문장이 길게 이어져서 ", "다음 줄로 넘어간다"]
    assert wrapped(("좁은 상자", 0, 120, 0, 10), rest, ("넓은 줄", 0, 200, 60, 10), rules=[(125.0, -1.0, 30.0)])[0] == "좁은 상자다음 줄로 넘어간다"
    assert wrapped(("- 표어 -", 0, 200, 0, 10), rest) == ["- 표어 -", "다음 줄로 넘어간다"]


def test_blocks_of_a_page(spark):
    rows = [
        line(0, "큰 제목입니다", 100, 120, 200, size=20), line(1, "1", 50, 200, 60), line(2, "추진 배경", 80, 200), line(3, "ㅇ 첫째 항목이 줄 끝까지 이어지고", 60, 230, 400),
        line(4, "다음 줄로 간다", 60, 242, 130), line(5, "- 1 -", 300, 960), line(6, "plain text", 60, 280), line(7, "오른쪽", 370, 280),
    ]
    table = spark.createDataFrame([(1, 1, "table", "a | b", 50.0, 300.0, 400.0, 380.0)], "doc int, page int, kind string, text string, x0 double, y0 double, x1 double, y1 double")
    blocks = P.assemble(lines(spark, rows), ["doc"], table).cache()
    got = [(r.kind, r.level, r.marker, r.text) for r in blocks.orderBy("page", "position").collect()]
    assert got == [
        ("para", None, None, "큰 제목입니다"), ("heading", 2, "1.", "추진 배경"), ("item", 4, "ㅇ", "첫째 항목이 줄 끝까지 이어지고다음 줄로 간다"), ("para", None, None, "plain text"), ("para", None, None, "오른쪽"), ("table", None, None, "a | b"), ("page_number", None, None, "- 1 -"),
    ]
    titled = P.title_blocks(blocks, ["doc"], F.lit(1000.0))
    assert [r.text for r in titled.where("kind = 'document_title'").collect()] == ["큰 제목입니다"]
    rows = F.when(F.col("kind") == "table", F.array(F.array(F.lit("a"), F.lit("b"))))
    text = P.markdown(titled.withColumn("rows", rows), ["doc"], F.lit("T")).first().markdown
    assert text == "# T\n\n\n<!-- page 1 -->\n\n**큰 제목입니다**\n\n### 1. 추진 배경\n\n  ㅇ 첫째 항목이 줄 끝까지 이어지고다음 줄로 간다\nplain text\n오른쪽\n| a | b |\n| --- | --- |\n"
    assert P.assemble(lines(spark, []), ["doc"]).collect() == []


def test_tall_blocks_keep_their_place(spark):
    rows = [(1, 1, "para", 0.0, 0.0, 40.0, 100.0, 10.0), (1, 2, "para", 60.0, 1.0, 90.0, 11.0, 10.0), (1, 3, "para", 50.0, 1.4, 55.0, 11.4, 10.0), (1, 4, "table", 50.0, 50.0, 90.0, 60.0, None)]
    df = spark.createDataFrame(rows, "page int, id int, kind string, x0 double, y0 double, x1 double, y1 double, size double")
    assert [r.id for r in P.reading_position(df, ["page"], "id").orderBy("position").collect()] == [1, 3, 2, 4]


def test_lines_of_glyphs(spark):
    rows, x = [], 0.0
    for i, ch in enumerate("가나 다.....라\x07마"):
        rows.append((1, 0, i, ch, x, 0.0, x + 9, 10.0, 10.0, False))
        x += 12 if ch == "나" else 9
    rows += [(1, 1, 0, " ", 0.0, 20.0, 5.0, 30.0, 10.0, False), (1, 2, 0, "a", 0.0, 40.0, 5.0, 50.0, 10.0, True), (1, 2, 1, "b", 9.0, 40.0, 14.0, 50.0, 10.0, True)]
    df = spark.createDataFrame(rows, "page int, line int, seq int, ch string, x0 double, y0 double, x1 double, y1 double, size double, bold boolean")
    got = {r.line: r for r in P.glyph_lines(df, ["page"]).collect()}
    assert set(got) == {0, 2} and got[0].text == "가나 다 라 마" and got[2].text == "a b" and got[2].is_bold
    assert [w.text for w in got[0].words] == ["가나", "다.....라", "마"] and [w.text for w in got[2].words] == ["a", "b"]
    words = spark.createDataFrame([([("필요성", 0.0), (":", 30.0), ("값", 40.0)],), ([("값", 40.0)],)], "w array<struct<text:string,x0:double>>")
    assert [r[0] for r in words.select(P.value_left(F.col("w"))).collect()] == [40.0, None]
