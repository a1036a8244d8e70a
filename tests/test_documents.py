"""Small fixtures for the document operators."""

import random
import unicodedata

from pyspark.sql import functions as F

from doclattice.functions import text as T
from doclattice.operators import agreement, labeling, targets, tree, validate
from doclattice.operators import lines as L
from doclattice.operators.rules import date_hits, suppressed


def column(spark, values, expr):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").orderBy("i").select(expr(F.col("x"))).collect()]


def test_normalize(spark):
    decomposed = unicodedata.normalize("NFD", "가")
    assert column(spark, ["가\x01나\r\n다\t라", decomposed, None], T.normalize) == ["가나\n다\t라", "가", None]
    assert column(spark, ["  a　 b ", "a b"], T.normalize_space) == ["a b", "a b"]
    assert column(spark, ["추 진 배 경", "추진 배경"], lambda x: T.collapse_spaced(x)["text"]) == ["추진배경", "추진 배경"]
    assert column(spark, ["1. 추 진 배 경", "사업개요 : 2026년"], T.heading_key) == ["추진배경", "사업개요"]


def test_locate(spark):
    rows = [("aaaa", "aa", None), ("aaaa", "aa", 3), ("aaaa", "aa", 4), ("abc", "z", None), ("abc", "", None), ("a.b a.b\\Ex", "a.b", 2), ("x\\Ey", "\\E", None), ("😀b", "b", None)]
    df = spark.createDataFrame(rows, "t string, q string, n int")
    got = [tuple(r[0]) for r in df.select(T.locate(F.col("t"), F.col("q"), F.col("n"))).collect()]
    assert got == [(None, None, "ambiguous"), (2, 4, None), (None, None, "occurrence_out_of_range"), (None, None, "absent"), (None, None, "empty_quote"), (4, 7, None), (1, 3, None), (1, 2, None)]
    assert [r[0] for r in df.select(T.occurrences(F.col("t"), F.col("q"))).collect()][:2] == [3, 3]


def test_markers(spark):
    lines = ["Ⅰ. 개요", "1. 배경", "1. 2. 회의", "□ 항목", "ㅇ 세부", "- 내용", "- 2 -", "· 점", "※ 참고", "① 하나", "붙임 1 목록", "참고사항을 확인한다", "plain", " 기호", "□"]
    got = column(spark, lines, lambda x: F.concat_ws("/", T.marker(x)["kind"], T.marker(x)["level"].cast("string"), T.marker(x)["type"]))
    assert got == ["heading/1/roman", "heading/2/number", "para", "item/3/square", "item/4/circle", "item/5/dash", "para", "item/6/dot", "note/note", "item/circled", "attachment/1/attachment", "para", "para", "item/3/square", "para"]


def test_markers_that_look_alike(spark):
    lines = ["-5도 이하", "2. 14（수） 회의", "5. 30∼31. 행사", "가.나다라", "(A) 항목", "가. 나다라", "- 표어 -", "-표어", "1. 개 요", "Ⅳ 결 과", "ㆍ점", "ㆍ 점", "붙임2. 명단", "별 첨", "m 항목", "\uf06d항목"]
    got = column(spark, lines, lambda x: F.concat_ws("/", T.marker(x)["kind"], T.marker(x)["type"], T.marker(x)["marker"], T.marker(x)["content"]))
    assert got == [
        "para/-5도 이하", "para/2. 14（수） 회의", "para/5. 30∼31. 행사", "para/가.나다라", "item/paren/(A)/항목", "item/hangul/가./나다라", "para/- 표어 -", "item/dash/-/표어", "heading/number/1./개요", "heading/roman/Ⅳ/결과",
        "para/ㆍ점", "item/dot/ㆍ/점", "attachment/attachment/붙임2./명단", "attachment/attachment/별 첨/", "item/square/m/항목", "item/square/\uf06d/항목",
    ]
    assert column(spark, ["1. 가", "-표어 -", "붙임", "plain", "◆ x"], T.starts_block) == [True, True, True, False, True]


def test_hierarchy_follows_a_stack(spark):
    import random

    rng = random.Random(3)
    rows, want = [], {}
    for doc in range(40):
        stack = []
        for n in range(30):
            level = rng.choice([None, 1, 2, 3, 4, 5, 6])
            while level is not None and stack and stack[-1][0] >= level:
                stack.pop()
            want[doc, n] = stack[-1][1] if stack else None
            rows.append((doc, n, level))
            if level is not None:
                stack.append((level, n))
    got = {(r.doc_id, r.line_no): r.parent for r in tree.with_parent(spark.createDataFrame(rows, "doc_id long, line_no long, level int")).collect()}
    # A block without level hangs below the last block that has one.
    assert {k: v for k, v in got.items()} == want


def test_chunks(spark):
    blocks = [("b2", "s1", 1), ("b3", "s1", 1), ("b4", "s1", 1), ("b5", "s2", 1), ("b6", "s2", 3), ("b12", "s2", 1), ("b9", "s3", 1)]
    df = spark.createDataFrame([("d", i, b, s, u) for i, (b, s, u) in enumerate(blocks)], "doc string, seq long, block string, section string, units long")

    def chunks(limit):
        out = {}
        for r in targets.pack(df, ["doc"], "seq", "section", "units", limit).join(df, ["doc", "seq"]).orderBy("seq").collect():
            out.setdefault(r.chunk, []).append(r.block)
        return list(out.values())

    assert chunks(40) == [["b2", "b3", "b4", "b5", "b6", "b12", "b9"]]
    assert chunks(5) == [["b2", "b3", "b4"], ["b5", "b6", "b12"], ["b9"]]
    assert chunks(2) == [["b2", "b3"], ["b4"], ["b5"], ["b6"], ["b12"], ["b9"]]


def test_title_like(spark):
    rows = [("heading", "anything", False, False), ("item", "개요", True, False), ("item", "개요", False, False), ("item", "확인한다", True, False), ("item", "긴 제목 일곱자", True, True), ("item", "긴 제목 일곱자", True, False)]
    df = spark.createDataFrame(rows, "kind string, text string, c boolean, l boolean")
    assert [r[0] for r in df.select(targets.title_like(F.col("kind"), F.col("text"), F.col("c"), F.col("l"))).collect()] == [True, True, False, False, True, False]


def test_sections(spark):
    lexicon = spark.createDataFrame([("추진배경", "SEC_BACKGROUND", 0), ("추진결과", "SEC_RESULT", 1), ("추진", "SEC_PLAN", 2)], "word string, tag string, seq int")
    heads = spark.createDataFrame([("추진배경",), ("추진결과및성과",), ("시설운영계획",), ("추진",), ("",)], "heading string")
    assert {r.heading: r.tag for r in tree.tag_headings(heads, lexicon).collect()} == {"추진배경": "SEC_BACKGROUND", "추진결과및성과": "SEC_RESULT", "시설운영계획": "SEC_UNKNOWN", "추진": "SEC_PLAN", "": "SEC_UNKNOWN"}


def test_running_share(spark):
    assert spark.range(1).select(L.running_share(F.lit(5)), L.running_share(F.lit(2))).first()[:] == (3, 2)


def test_dates(spark):
    rows = [(1, "2026. 2. 28."), (2, "2026. 2. 30."), (3, "2026-02-03"), (4, "none")]
    hits = suppressed(date_hits(spark.createDataFrame(rows, "k int, text string"), ["k"]), ["k"])
    assert sorted((r.k, r.rule) for r in hits.collect()) == [(2, "FMT-07"), (3, "FMT-01")]


def test_attempts_are_bounded(spark):
    requests = spark.createDataFrame([("r1", "p"), ("r2", "p"), ("r3", "p")], "request_id string, payload string")
    labeler = lambda df: df.withColumn("response", F.concat_ws("-", "request_id", F.col("attempt").cast("string")))
    judge = lambda df: df.where("request_id = 'r3' or (request_id = 'r2' and attempt < 2)").select("request_id", F.lit("V09").alias("code"))
    answers, failed = labeling.ask(requests, labeler, judge)
    assert sorted(map(tuple, answers.collect())) == [("r1", "r1-1", 1), ("r2", "r2-2", 2)]
    assert [tuple(r) for r in failed.collect()] == [("r3", ["V09"])]


def test_agreement_counts_missing_units(spark):
    left = spark.createDataFrame([("b1", None, "x"), ("b2", 0, "x"), ("b3", None, "x")], "b string, r int, signature string")
    right = spark.createDataFrame([("b1", None, "x"), ("b2", 0, "y")], "b string, r int, signature string")
    row = agreement.agreement(agreement.compare_units(left, right, ["b", "r"]), []).first()
    assert (row.total, row.matched, row.left_only, row.right_only) == (3, 1, 1, 0)


def test_snapshots(spark):
    docs = spark.createDataFrame([('{"b":1,"a":100000000.0}',), ('{"a":100000000.0,"b":1}',), ("broken",)], "payload string")
    first = agreement.freeze(docs, None).cache()
    assert first.count() == 1 and agreement.freeze(docs, first).count() == 0 and agreement.tampered(first).count() == 0
    assert agreement.tampered(first.withColumn("payload", F.lit('{"a":2}'))).count() == 1


def test_response_codes_fire_and_do_not(spark):
    from doclattice.plans.queries import QUERIES

    codes = {r.code for r in QUERIES["response_issues"](spark, "/root/testdata/sf0.001").collect()}
    assert codes == {"V02", "V03", "V04", "V05", "V06", "V07", "V08", "V09", "V12"}
    assert validate.duplicate_keys(spark.range(3), ["id"]).count() == 0


def test_quotes_are_located_in_all_documents(spark, tmp_path):
    from doclattice.plans.queries import QUERIES

    rng = random.Random(3)
    long = "".join(rng.choice("abcdefghijklmnop \n") for _ in range(60_000))
    texts = [None, "", "short", "x" * 10, "x" * 11, "0123456789ab", "aa" * 10, "0123456789(.)" + "z" * 5000 + "(.)", "a" * 4000, long, "0123456789éß𝄞" + long]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    every, one = {}, {}
    for i, t in enumerate(texts):
        q = None if t is None else t[10:13]
        found = [p for p in range(len(t)) if t.startswith(q, p)] if q else []
        every[i] = (q, len(found), found[0] if found else None, found[-1] if found else None)
        one[i] = (None, None, "empty_quote") if not q else (None, None, "ambiguous") if len(found) > 1 else (found[0], found[0] + len(q), None)
    assert {r[0]: tuple(r[1:]) for r in QUERIES["locate_all_overlapping"](spark, str(tmp_path)).collect()} == every
    assert {r[0]: tuple(r[1:]) for r in QUERIES["locate_unique"](spark, str(tmp_path)).collect()} == one
