import json

import pytest
from pyspark.sql import functions as F

from doclattice.sources import readers
from doclattice.streaming.ingest import document_stream, freeze_stream, usage_stream


def test_pdf_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.pdf").write_bytes(b"nothing")
    (tmp_path / "c.txt").write_text("no")
    rows = {r.path.rsplit("/", 1)[1]: r for r in readers.pdf_files(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.pdf", "b.pdf"} and rows["a.pdf"].error_code is None and rows["b.pdf"].error_code == "UNSUPPORTED_MEDIA_TYPE"
    assert rows["a.pdf"].document_id == "doc_" + rows["a.pdf"].sha256[:16]


def test_parsed_documents(spark, tmp_path):
    good = {"schema_version": "1.2.0", "document": {"document_id": "d1", "filename": "x.pdf"}, "blocks": [{"id": "b1", "kind": "para", "text": "가"}, {"id": "b2", "kind": "table", "rows": [["a"]]}]}
    (tmp_path / "a.json").write_text(json.dumps(good), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({**good, "schema_version": "1.0"}), encoding="utf-8")
    parsed = readers.parsed_documents(spark, str(tmp_path))
    assert sorted(r.error_code or "" for r in parsed.collect()) == ["", "SCHEMA_VERSION"]
    blocks = readers.blocks(parsed.where("error_code is null")).orderBy("seq").collect()
    assert [(b.id, b.rows, b.requires_vision) for b in blocks] == [("b1", [], False), ("b2", [["a"]], False)]


def test_manifest_and_catalogue(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"groups": [{"group_id": "g1", "split": "dev", "files": ["plan/a.pdf"]}, {"group_id": "g2", "split": "test", "files": ["plan/b.pdf"]}]}))
    assert [tuple(r) for r in readers.split_files(spark, str(tmp_path / "m.json"), "dev", "/root").collect()] == [("g1", "/root/plan/a.json")]
    (tmp_path / "moves.yaml").write_text("GROUNDS: {steps: [LAW]}\n")
    assert readers.catalogue(spark, str(tmp_path / "moves.yaml")).first().name == "GROUNDS"
    with pytest.raises(ValueError):
        readers.catalogue(spark, str(tmp_path / "other.yaml"))


def test_sink_refuses_to_overwrite(spark, tmp_path):
    rows = spark.range(3)
    readers.write_documents(rows, str(tmp_path / "o"))
    with pytest.raises(Exception):
        readers.write_documents(rows, str(tmp_path / "o"))


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"payload": "{\\"a\\":1}"}\n{"payload": "{ \\"a\\": 1 }"}\n')
    run = lambda: freeze_stream(document_stream(spark, str(src), "payload string"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (src / "2.json").write_text('{"payload": "{\\"a\\":1}"}\n{"payload": "{\\"a\\":2}"}\n')
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    calls = spark.readStream.schema("ts timestamp, document_id string, tokens long").json(str(tmp_path / "calls") if (tmp_path / "calls").mkdir() is None else "")
    (tmp_path / "calls/1.json").write_text('{"ts":"2026-01-01T00:01:00Z","document_id":"d","tokens":5}\n{"ts":"2026-01-01T00:02:00Z","document_id":"d","tokens":7}\n')
    q = usage_stream(calls).writeStream.outputMode("complete").format("memory").queryName("usage_test").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.calls, r.tokens) for r in spark.table("usage_test").select(F.col("calls"), F.col("tokens")).collect()] == [(2, 12)]
