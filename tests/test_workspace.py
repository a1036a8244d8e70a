import hashlib
import json

import pytest
from pyspark.sql import functions as F

from doclattice.functions import replies
from doclattice.operators import drawings, projection, prompts, snapshots, workspace


def test_schemas():
    moves = {"SPEC": {"field": {"enum": ["COST"]}, "steps": {"b": 1, "a": 1}}, "UNDETERMINED": {"reasons": {"AMBIGUOUS": 1}}, "PLAN": {"steps": {"a": 1}}}
    schema = prompts.block_schema(moves)
    annotation = schema["properties"]["blocks"]["items"]["properties"]["annotations"]["items"]
    assert annotation["properties"]["steps"]["items"]["properties"]["step"]["enum"] == ["a", "b"]
    assert annotation["properties"]["move"]["enum"] == list(moves) and annotation["properties"]["undetermined_reason"]["enum"] == ["AMBIGUOUS", None]

    def closed(part):
        if isinstance(part, dict):
            assert part.get("type") != "object" or (part["additionalProperties"] is False and part["required"] == list(part["properties"]))
            list(map(closed, part.values()))
        elif isinstance(part, list):
            list(map(closed, part))

    closed(schema)
    closed(prompts.document_schema(["A"], ["T"]))
    none = prompts.no_document_answer("r", "why")
    assert set(none) == set(prompts.document_schema(["A"], ["T"])["properties"]) and none["document_type"] is None and none["outline_reason"] == "why" and none["document_topics_evidence"] == []


def test_projection(spark):
    ddl = "id string, page int, kind string, text string, bbox array<double>, level int, marker string, rows array<array<string>>, requires_vision boolean"
    blocks = spark.createDataFrame([("b1", 1, "item", "x", [1.06, 2.0], 3, "", [], False), ("b2", 1, "table", "", [0.0, 0.0], None, None, [["a"]], True)], ddl)
    got = [json.loads(r[0]) for r in blocks.select(projection.block_json(blocks)).collect()]
    assert got == [{"id": "b1", "page": 1, "kind": "item", "text": "x", "bbox": [1.1, 2.0], "level": 3}, {"id": "b2", "page": 1, "kind": "table", "text": "", "bbox": [0.0, 0.0], "rows": [["a"]], "requires_vision": True}]
    section = spark.createDataFrame([("s", "b1", "h", None, 1, ["b2"], ["b1", "b2"], 1, 3)], "section_id string, head_block_id string, head_text string, marker string, level int, child_block_ids array<string>, block_ids array<string>, first_page int, last_page int")
    assert json.loads(section.select(projection.section_json()).first()[0])["page_range"] == [1, 3]
    rows = spark.createDataFrame([("d", 1, "b2", "para", "target", "y", 4), ("d", 0, "b1", "para", "context", "x", 4), ("d", 2, "b3", "figure", "excluded", "", 4)], "doc string, seq int, block_id string, kind string, class string, text string, merged int")
    assert [b.block_id for b in projection.shown_blocks(rows, ["doc"]).first().blocks] == ["b1", "b2"]
    assert projection.summary_line(rows, ["doc"], ["merged"]).first().summary == "3 blocks (figure=1 para=2) | merged=4"


def test_workspace(spark, tmp_path):
    assert workspace.safe_path("/w/", "labels", "a-1.b") == "/w/labels/a-1.b"
    for bad in ("", "a/b", "..", "x" * 41, "가"):
        with pytest.raises(ValueError, match="not a name"):
            workspace.safe_path("/w", bad)
    docs = snapshots.identity(spark.createDataFrame([("d", '{"a":1}'), ("e", '{"a":2}')], "document_id string, payload string"))
    sha = {r.document_id: r.parsed_content_sha256 for r in docs.collect()}
    requests = spark.createDataFrame([("d", "r1", sha["d"], ["b1", "b2"]), ("e", "r2", "old", ["b1"]), ("f", "r3", "x", [])], "document_id string, request_id string, parsed_sha256 string, targets array<string>")
    assert sorted(r.request_id for r in workspace.stale_requests(requests, docs).collect()) == ["r2", "r3"]
    blocks = spark.createDataFrame([("d", "b1", "target", "s1"), ("d", "b3", "table", "s1"), ("d", "b4", "target", "s2"), ("d", "b5", "context", "s1"), ("e", "b1", "target", None), ("z", "b1", "target", None)], "document_id string, block_id string, class string, section_id string")
    chosen = spark.createDataFrame([("d", "s1")], "document_id string, section_id string")
    assert sorted(map(tuple, workspace.moved_targets(requests, blocks, chosen).collect())) == [("d", "b2", "frozen"), ("d", "b3", "current")]
    assert sorted(map(tuple, workspace.moved_targets(requests, blocks).collect())) == [("d", "b2", "frozen"), ("d", "b3", "current"), ("d", "b4", "current")]
    sources = snapshots.block_sources(spark.createDataFrame([("d", "b1", 1, [0.0], "s", "t")], "document_id string, id string, page int, bbox array<double>, source_text string, text string"))
    labels = sources.withColumn("move", F.lit("PLAN"))
    workspace.save_labels(labels, sources, str(tmp_path), "ann")
    assert spark.read.parquet(f"{tmp_path}/labels/ann").count() == 1
    with pytest.raises(ValueError, match="b1"):
        workspace.save_labels(labels.withColumn("page", F.lit(9)), sources, str(tmp_path), "other")


def test_replies(spark):
    expired = b"<Error><Code>AccessDenied</Code><Message>Request has expired</Message></Error>"
    assert replies.expired_reply(expired) and replies.expired_reply(b"<E><Code>ExpiredToken</Code></E>")
    assert not any(map(replies.expired_reply, [b"", b"<E>", b"\xff", b"<!DOCTYPE a><E><Code>ExpiredToken</Code></E>", b"<E><Code>AccessDenied</Code></E>", b" " * 9000]))
    rows = [(200, None), (404, None), (429, None), (503, None), (403, expired), (403, b"x"), (418, None)]
    got = spark.createDataFrame(rows, "status int, body binary").select(replies.reply_error(F.col("status"), F.col("body"))).collect()
    assert [r[0] for r in got] == [None, "SOURCE_NOT_FOUND", "SOURCE_DOWNLOAD_TEMPORARY_FAILURE", "SOURCE_DOWNLOAD_TEMPORARY_FAILURE", "SOURCE_URL_EXPIRED", "SOURCE_ACCESS_DENIED", "SOURCE_ACCESS_DENIED"]
    sha = hashlib.sha256(b"abcd").hexdigest()
    assert replies.received([b"ab", b"cd"], 4, 4, sha) == (4, sha)
    for limit, length, digest, said in ((3, None, None, "FILE_TOO_LARGE"), (9, 5, None, "SIZE_MISMATCH"), (9, 3, None, "SIZE_MISMATCH"), (9, 4, "x", "HASH_MISMATCH")):
        with pytest.raises(ValueError, match=said):
            replies.received([b"ab", b"cd"], limit, length, digest)


def test_nodes_and_glyphs(spark):
    blocks = spark.createDataFrame([(1, "right", 30.0, 0.0, 60.0, 20.0), (1, "far", 100.0, 0.0, 120.0, 20.0), (1, "between", 30.0, 100.0, 40.0, 110.0), (1, "below", 30.0, 300.0, 60.0, 320.0)], "page int, block_id string, x0 double, y0 double, x1 double, y1 double")
    nodes = spark.createDataFrame([(1, "a", 0.0, 0.0, 20.0, 200.0), (1, "b", 45.0, 90.0, 60.0, 130.0)], "page int, node string, x0 double, y0 double, x1 double, y1 double")
    assert sorted(map(tuple, drawings.nearest_vertical_node(blocks, nodes, ["page"]).collect())) == [(1, "between", "b"), (1, "right", "a")]
    glyphs = spark.createDataFrame([(1, c, x, y, x + 1, y + 10) for c, x, y in [("b", 5.0, 0.5), ("a", 1.0, 1.0), ("d", 2.0, 20.0), (" ", 0.0, 20.0), ("c", 1.0, 20.4)]], "page int, ch string, x0 double, y0 double, x1 double, y1 double")
    assert drawings.glyph_text(glyphs, ["page"]).first().text == "ab\ncd"
