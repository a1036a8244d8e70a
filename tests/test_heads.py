import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from doclattice.functions import boxes as B
from doclattice.functions import checks as C
from doclattice.operators import heads as H
from doclattice.operators import labeling, pilot, prompts, snapshots


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def box(*v):
    return F.array(*[F.lit(float(x)) for x in v])


def test_boxes(spark):
    assert one(spark, B.union(box(0, 1, 5, 6), box(2, 0, 9, 4)), B.center(box(0, 0, 10, 4))) == ([0, 0, 9, 6], [5, 2])
    assert one(spark, B.inside(box(0, 0, 5, 5), box(0.5, 0, 5, 5)), B.inside(box(0, 0, 5, 5), box(2, 0, 5, 5))) == (True, False)
    df = spark.createDataFrame([([(1.0, 2.0, 0, 3), (5.0, 9.0, 4, None)],), ([],)], "w array<struct<x0:double,x1:double,source_start:int,source_end:int>>")
    assert [tuple(r) for r in df.select(B.text_left(F.col("w"), box(7, 0, 8, 1)), B.text_right(F.col("w"), box(7, 0, 8, 1))).collect()] == [(1, 9), (7, 8)]
    assert [[tuple(w)[2:] for w in r[0]] for r in df.select(B.shift_words(F.col("w"), F.lit(10))).collect()] == [[(10, 13), (14, None)], []]
    rows = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (0.0, 5.0, 2.0, 9.0)], "x0 double, y0 double, x1 double, y1 double")
    assert rows.agg(B.bounds()).first()[0] == [0, 2, 3, 9]
    assert one(spark, B.line_high(box(0, 0, 1, 20), F.lit(10.0)), B.line_high(box(0, 0, 1, 21), F.lit(10.0)), B.line_high(box(0, 0, 1, 2), F.lit(None).cast("double"))) == (True, False, False)
    bullet = lambda *b: B.image_bullet(box(*b), box(50, 0, 90, 10), F.lit(50.0), F.lit(10.0))
    assert one(spark, bullet(38, 0, 48, 10), bullet(20, 0, 30, 10), bullet(28, 0, 48, 10), bullet(38, 30, 48, 40)) == (True, False, False, False)


def test_checks(spark):
    ask = lambda f, *values: one(spark, *[f(F.lit(v)).alias(str(i)) for i, v in enumerate(values)])
    assert ask(C.filled, "a", "", " 　", None) == (True, False, False, False)
    assert ask(C.secret_set, "s", "replace-me", "") == (True, False, False)
    assert ask(C.exact_host, "a.b-c.com", "a..com", "A.com", "x.com:1", None) == (True, False, False, False, False)
    assert ask(C.key_prefix, "a/", "/a/", "a", "") == (True, False, False, False)
    urls = ["https://h.com/a?b", "https://h.com:443", "https://h.com:8443/a", "http://h.com", "https://u@h.com/", "https://u:p@h.com/", "https://h.com/#f", "https:///a", None]
    assert ask(C.https_source, *urls) == (True, True, False, False, False, False, False, False, False)
    df = spark.createDataFrame([("s",), ("t",), (None,)], "x string")
    assert [r[0] for r in df.select(C.same_secret(F.col("x"), "s")).collect()] == [True, False, False]
    assert one(spark, C.chronological(F.lit(1), F.lit(1)), C.chronological(F.lit(2), F.lit(1)), C.json_value(F.lit('{"a":1}')), C.json_value(F.lit("{a")), C.same_action(F.lit("X"), F.lit("retry"), {"X": "retry"}), C.same_action(F.lit("Y"), F.lit("retry"), {"X": "retry"})) == (True, False, True, False, True, False)


def test_heading_hints(spark):
    rows = [([["Ⅲ", "운영 결과"]], True), ([["2", "추진 배경"]], False), ([["2", "추진 배경"]], True), ([["2", "아무 글"]], True), ([["a", "b"], ["c", "d"]], True)]
    got = spark.createDataFrame(rows, "rows array<array<string>>, large boolean").select(H.heading_hint(F.col("rows"), F.col("large"))).collect()
    assert [r[0] and (r[0].status, r[0].level, len(r[0].evidence)) for r in got] == [("confirmed", 1, 3), ("needs_review", 2, 1), ("confirmed", 2, 2), ("needs_review", 2, 1), None]


def test_heads(spark):
    ddl = "doc int, seq int, id string, parent_id string, kind string, level int, marker_type string, text string, page int, size double"
    rows = [
        (1, 0, "a", None, "heading", 1, "roman", "운영 상 문제점 (아주 길게 이어지는 운영체계 개선배경 설명)", 1, 12.0), (1, 1, "b", "a", "item", 3, "square", "내용을 정리함", 1, 10.0), (1, 2, "c", "b", "para", None, None, "x", 1, 10.0),
        (1, 3, "d", None, "attachment", 1, "attachment", "", 1, 10.0), (1, 4, "e", "d", "para", None, None, "작은 글", 1, 9.0), (1, 5, "f", "d", "para", None, None, "큰 제목", 1, 15.0), (1, 6, "g", "d", "para", None, None, "다음 쪽", 2, 20.0), (1, 7, "h", "d", "para", None, None, "넷째", 1, 30.0),
        (1, 8, "i", None, "heading", 2, "number", "자식 없음", 1, 10.0),
    ]
    blocks = spark.createDataFrame(rows, ddl)
    found = H.head_candidates(blocks, ["doc"])
    assert sorted(r.id for r in found.collect()) == ["a", "d"]
    assert {r.id: r.title for r in H.head_titles(found, blocks, ["doc"]).collect()} == {"a": rows[0][7], "d": "큰 제목"}


def test_approval_fields(spark):
    ask = lambda f, *values: one(spark, *[f(F.lit(v)).alias(str(i)) for i, v in enumerate(values)])
    assert ask(H.approval_label, "문서 번호", "추진계획", "확인함", "1. 가", "가", "담당/팀장") == (True, False, False, False, False, True)
    assert ask(H.approval_value, "홍길동", "알려 드립니다", "x" * 41, "- 항목") == (True, True, False, False)
    assert ask(H.approval_value, "처리 바랍니다.") == (False,) and ask(H.approval_hits, "문서번호 등록 일자 문서번호", "없음") == (2, 0)
    outside = F.array(F.struct(F.lit("추진 결과").alias("text"), F.lit(30.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(10.0).alias("y1"), F.lit(10.0).alias("size")))
    grid = lambda *c: F.array(F.array(*[F.lit(x) for x in c]))
    assert one(spark, H.chapter_number_box(grid("Ⅲ", ""), box(0, 0, 20, 10), outside), H.chapter_number_box(grid("Ⅲ", "a"), box(0, 0, 20, 10), outside)) == (True, False)
    ddl = "doc int, page int, kind string, text string, x0 double, y0 double, x1 double, y1 double"
    blocks = spark.createDataFrame([(1, 1, "document_title", "언론수용자 조사", 0.0, 0.0, 100.0, 20.0), (1, 1, "para", "수용자", 2.0, 2.0, 50.0, 20.0), (1, 1, "para", "다른 글", 2.0, 2.0, 50.0, 20.0), (1, 1, "para", "조사", 2.0, 60.0, 50.0, 80.0)], ddl)
    assert [r.text for r in H.title_copies(blocks, ["doc"]).collect()] == ["수용자"]


def test_prompts(tmp_path):
    assert prompts.fill("a {x} r{row} {y}", {"x": "1", "y": "{x}"}) == "a 1 r{row} {x}"
    assert prompts.flat({"a": [1, "b  c"], "d": {"e": None}}) == "a: 1 / b c; d: e: None" and prompts.bullets([1, {"a": 2}]) == "- 1\n- a: 2"
    assert prompts.labelled({"u": "x", "v": "y"}, {"v": "V"}) == "- V: y"
    assert prompts.strict_object({"a": {"type": "string"}})["required"] == ["a"] and prompts.nullable({"type": "x"}) == {"anyOf": [{"type": "x"}, {"type": "null"}]}
    assert prompts.request_json({"a": "가"}) == '{"a":"가"}' and json.loads(prompts.request_json({"a": 1}, "r", ["V"])) == {"a": 1, "previous_response": "r", "issues": ["V"]}
    (tmp_path / "f").write_bytes(b"x")
    hashes = prompts.file_hashes({"f": str(tmp_path / "f")})
    assert hashes == {"f": hashlib.sha256(b"x").hexdigest()}
    prompts.require_same(hashes, dict(hashes))
    with pytest.raises(ValueError, match="f"):
        prompts.require_same(hashes, {"f": "other"})


def test_snapshots(spark):
    doc = {"document": {"document_id": "d"}, "sections": [], "blocks": [{"id": "b"}], "parser": {"name": "p", "stats": {"n": 1}}, "snapshot": 1}
    other = doc | {"snapshot": 2, "parser": {"name": "p", "stats": {"n": 9}}}
    rows = spark.createDataFrame([(json.dumps(doc),), (json.dumps(other),), (json.dumps(doc | {"blocks": []}),), ("{",), (None,)], "payload string")
    got = [r.snapshot_id for r in snapshots.identity(rows).collect()]
    assert got[0] == got[1] != got[2] and got[3] is None and got[4] is None and got[0].startswith("snap_")
    same = [r[0] for r in rows.select(snapshots.structure_hash(F.col("payload"))).collect()]
    assert same[0] == same[1] != same[2] and same[3] is None
    blocks = spark.createDataFrame([("d", "b1", 1, [0.0], "s", "t"), ("d", "b2", 1, [0.0], "s", None)], "document_id string, id string, page int, bbox array<double>, source_text string, text string")
    sources = snapshots.block_sources(blocks)
    moved = sources.withColumn("page", F.when(F.col("block_id") == "b2", 5).otherwise(F.col("page")))
    assert snapshots.unbound(sources, sources).count() == 0 and [r.block_id for r in snapshots.unbound(moved, sources).collect()] == ["b2"]
    classes = spark.createDataFrame([("d", "b1", "target"), ("d", "b2", "excluded")], "document_id string, block_id string, class string")
    assert [r.block_id for r in snapshots.not_labelable(sources, classes).collect()] == ["b2"]


def test_pilot(spark):
    blocks = spark.createDataFrame([("d", "s1", "target", "heading", 0), ("d", "s1", "table", "table", 4), ("d", "s1", "excluded", "para", 0), ("d", None, "target", "para", 0), ("d", "s2", "target", "para", 0)], "doc string, section_id string, class string, kind string, n_rows int")
    units = pilot.units_by_section(blocks, ["doc"])
    assert sorted(map(tuple, units.collect())) == [("d", "s1", 5, 4, 1), ("d", "s2", 1, 0, 0)]
    assert pilot.totals(units, ["doc"]).first()[1:] == (6, 4, 1)
    rng = random.Random(1)
    rows = [(f"d{i}", f"g{i // 2}", "plan" if i % 2 else "result", f"{'행사' if i % 3 else '보고'}{i}", rng.randint(5, 40), rng.randint(0, 9), rng.randint(0, 5)) for i in range(40)]
    frame = spark.createDataFrame(rows, "document_id string, group_id string, category string, title string, units long, table_rows long, headings long")
    draw = pilot.Draw({"plan": 3, "result": 3}, (100, 110), 25, 14, 4, "행사")
    listed = [dict(zip(frame.columns, r)) for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    want = next(s for s in range(1000) if pilot.meets(pilot.drawn(listed, s, draw), draw))
    got = pilot.first_draw(spark, frame, draw).collect()
    assert {r.seed for r in got} == {want} and sorted(r.document_id for r in got) == sorted(c["document_id"] for c in pilot.drawn(listed, want, draw)) and len({c["group_id"] for c in pilot.drawn(listed, want, draw)}) == 6
    assert pilot.first_draw(spark, frame, pilot.Draw({"plan": 3}, (9999, 9999))).collect() == []


def test_labelling_run(spark):
    documents = spark.createDataFrame([("D1", "p"), ("D2", "bad")], "request_id string, payload string")
    labeler = lambda asked: asked.withColumn("response", F.concat("payload", F.lit("!")))
    refuse = lambda asked: asked.where("payload = 'bad'").select("request_id", F.lit("V01").alias("code"))
    blocks = lambda told: told.select(F.explode(F.array(F.lit("b1"), F.lit("b2"), F.lit("b3"))).alias("request_id"), F.lit("local").alias("payload")).withColumn("local", F.col("request_id") != "b3")
    widened = lambda rows: rows.select("request_id", F.when(F.col("request_id") == "b1", "wide").otherwise("bad").alias("payload"))
    missing = lambda answers: answers.select("request_id", F.array(F.lit("CONTEXT_MISSING")).alias("reasons"))
    told, answers, failed = labeling.label_documents(documents, blocks, widened, labeler, refuse, refuse, missing, 2)
    assert [r.request_id for r in told.collect()] == ["D1"]
    assert {r.request_id: (r.response, r.wide) for r in answers.collect()} == {"b1": ("wide!", True), "b2": ("local!", False), "b3": ("local!", False)}
    assert [(r.request_id, r.unit, r.codes) for r in failed.collect()] == [("D2", "document", ["V01"])]
