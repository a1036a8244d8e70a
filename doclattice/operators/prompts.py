"""Instructions and response schemas, made from catalogues on the driver: a catalogue has tens of entries."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from pathlib import Path


def fill(template: str, values: Mapping[str, str]) -> str:
    """{name} of each value replaced, in order; other braces stay."""
    for name, value in values.items():
        template = template.replace(f"{{{name}}}", value)
    return template


def flat(value: object) -> str:
    """A nested value in one line."""
    match value:
        case Mapping():
            return "; ".join(f"{k}: {flat(v)}" for k, v in value.items())
        case list() | tuple():
            return " / ".join(map(flat, value))
        case _:
            return " ".join(str(value).split())


def bullets(value: object) -> str:
    """A list of a mapping's entries, or of values."""
    shown = [f"{k}: {flat(v)}" for k, v in value.items()] if isinstance(value, Mapping) else map(flat, value)
    return "\n".join(f"- {x}" for x in shown)


def labelled(entries: Mapping[str, object], names: Mapping[str, str]) -> str:
    """The entries that names lists, under its names and in its order."""
    return bullets({shown: entries[key] for key, shown in names.items()})


def strict_object(properties: Mapping[str, object]) -> dict:
    """A JSON schema with all properties required and no others allowed."""
    return {"type": "object", "properties": dict(properties), "required": list(properties), "additionalProperties": False}


def nullable(schema: Mapping[str, object]) -> dict:
    return {"anyOf": [dict(schema), {"type": "null"}]}


def request_json(request: Mapping[str, object], previous: object = None, issues: list | None = None) -> str:
    """A request as compact JSON; with a retry, the response before it and what was wrong with it."""
    body = dict(request) if issues is None else {**request, "previous_response": previous, "issues": issues}
    return json.dumps(body, ensure_ascii=False, separators=(",", ":"))


def file_hashes(paths: Mapping[str, str]) -> dict[str, str]:
    """SHA-256 of each file's bytes, read in parts."""
    out = {}
    for name, path in paths.items():
        with Path(path).open("rb") as f:
            out[name] = hashlib.file_digest(f, "sha256").hexdigest()
    return out


def require_same(frozen: Mapping[str, str], current: Mapping[str, str]) -> None:
    """Raise if specifications moved since they were frozen."""
    moved = sorted(k for k in frozen.keys() | current.keys() if frozen.get(k) != current.get(k))
    if moved:
        raise ValueError(f"specifications changed: {', '.join(moved)}")


# Forms of the answers' fields.
TEXT, WHOLE, TEXT_OR_NULL, WHOLE_OR_NULL = {"type": "string"}, {"type": "integer"}, {"type": ["string", "null"]}, {"type": ["integer", "null"]}
STATUSES, ROLES, TABLE_STATES = ("determined", "partial", "undetermined", "not_applicable"), ("header", "body", "empty"), ("labeled", "unreadable")


def one_of(values, null: bool = False) -> dict:
    return {"type": ["string", "null"], "enum": [*values, None]} if null else {"type": "string", "enum": list(values)}


def each(items: Mapping[str, object]) -> dict:
    return {"type": "array", "items": dict(items)}


def block_schema(moves: Mapping[str, Mapping]) -> dict:
    """The schema of a block answer; what may be said comes from the catalogue of moves."""
    span = strict_object({"quote": TEXT, "occurrence": WHOLE_OR_NULL, "row": WHOLE_OR_NULL, "col": WHOLE_OR_NULL})
    steps = sorted({step for move in moves.values() for step in move.get("steps") or ()})
    item = strict_object({"spec_field": one_of(moves["SPEC"]["field"]["enum"], null=True), "raw_label": TEXT, "value": TEXT, "evidence_span": span, "label_span": nullable(span), "reason": TEXT_OR_NULL})
    annotation = strict_object(
        {
            "annotation_id": TEXT, "move": one_of(moves), "evidence_span": span, "context_block_ids": each(TEXT), "steps": each(strict_object({"step": one_of(steps), "evidence_span": span})),
            "step_status": one_of(STATUSES), "step_reason": TEXT_OR_NULL, "undetermined_reason": one_of(moves["UNDETERMINED"]["reasons"], null=True), "spec_items": each(item),
        }
    )
    judged = {"primary_annotation_id": TEXT_OR_NULL, "annotations": each(annotation)}
    row = strict_object({"row": WHOLE, "role": one_of(ROLES), **judged})
    table = strict_object({"table_status": one_of(TABLE_STATES), "table_reason": TEXT_OR_NULL, "header_rows": each(WHOLE), "row_header_cols": each(WHOLE), "rows": each(row)})
    block = strict_object({"block_id": TEXT, **judged, "table": nullable(table)})
    return strict_object({"schema_version": one_of(["rma-block-response-1"]), "request_id": TEXT, "blocks": each(block)})


def document_schema(types, topics) -> dict:
    """The schema of a document answer."""
    span = strict_object({"block_id": TEXT, "quote": TEXT, "occurrence": WHOLE_OR_NULL})
    return strict_object(
        {
            "schema_version": one_of(["rma-doc-response-1"]), "request_id": TEXT, "document_type": one_of(types, null=True), "document_type_evidence": nullable(span), "document_type_reason": TEXT_OR_NULL,
            "document_topics": {"anyOf": [each(one_of(topics)), {"type": "null"}]}, "document_topics_evidence": each(span), "document_topics_reason": TEXT_OR_NULL, "outline_id": TEXT_OR_NULL, "outline_reason": TEXT_OR_NULL,
        }
    )


def no_document_answer(request_id: str, reason: str) -> dict:
    """The document answer where none was valid: every judgement null, with the reason."""
    empty = {name: ([] if "array" == form.get("type") else None) for name, form in document_schema((), ())["properties"].items()}
    reasons = {name: reason for name in empty if name.endswith("_reason")}
    return empty | reasons | {"schema_version": "rma-doc-response-1", "request_id": request_id}
