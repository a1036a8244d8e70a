"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each whole text once and stops at anchors: at-signs, plus signs, schemes,
identifier cues and digits. At an anchor a deterministic local parser expands to the left and right, finds the
boundaries and validates what it found. Parsers of a kind never look back past the end of their last match,
so matches are leftmost and don't overlap within a kind; a match that fails validation is passed over.

Base kinds: email, ip, card, phone. The method adds `address` (a scheme's authority that carries user
information) and `account` (an IBAN after a cue, its check digits valid).

Result: one row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans. Offsets are code
points. A null text is empty. Repeated rows have a result each. Extra columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.session import short_batches

KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]

# The forms of the base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USER_INFO = re.compile(r"[A-Za-z0-9._%+-]+:[^\s/@:]+@[A-Za-z0-9.-]+")
IBAN = re.compile(r"[ :=#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
CUES = ("IBAN", "iban", "Iban", "account", "Account", "compte", "Konto", "konto", "cuenta")
SCHEMES = ("://",)
DIGITS = "0123456789"


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    total += sum(d - 9 if d > 9 else d for d in (2 * int(x) for x in digits[-2::-2]))
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for word, kind in [("@", "at"), ("+", "plus"), *((s, "scheme") for s in SCHEMES), *((c, "cue") for c in CUES), *((d, "digit") for d in DIGITS)]:
        made.add_word(word, kind)
    made.make_automaton()
    return made


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    after = dict.fromkeys(KINDS, 0)
    digits_end = 0
    for last, what in anchors.iter(text):
        if what == "digit":
            if last < digits_end:
                continue
            # The run of digits that starts here; a match cannot start within it and not at its start.
            digits_end = last + 1
            while digits_end < len(text) and "0" <= text[digits_end] <= "9":
                digits_end += 1
            if last >= after["ip"] and text[digits_end : digits_end + 1] == "." and (m := IP.match(text, last)):
                after["ip"] = m.end()
                if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
                    found["ip"].append(m.span())
            if last >= after["card"] and (m := CARD.match(text, last)):
                after["card"] = m.end()
                number = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(number) <= 19 and luhn(number):
                    found["card"].append(m.span())
        elif what == "at":
            start = last
            while start > after["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < last and (m := DOMAIN.match(text, last + 1)):
                after["email"] = m.end()
                found["email"].append((start, m.end()))
        elif what == "plus":
            if last >= after["phone"] and (m := PHONE.match(text, last)):
                after["phone"] = m.end()
                if 9 <= sum(c in DIGITS for c in m[0]) <= 15:
                    found["phone"].append(m.span())
        elif what == "scheme":
            if last >= after["address"] and (m := USER_INFO.match(text, last + 1)):
                after["address"] = m.end()
                found["address"].append(m.span())
        elif last >= after["account"] and (m := IBAN.match(text, last + 1)) and iban_valid(m[1]):
            after["account"] = m.end(1)
            found["account"].append(m.span(1))
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        counts: list[list[int]] = [[] for _ in BASE]
        digest, spans = [], []
        for text in batch.column("text"):
            found = find(text.as_py() or "", anchors)
            for column, kind in zip(counts, BASE, strict=True):
                column.append(sum(k == kind for k, _, _ in found))
            written = [f"{k}:{a}:{b}" for k, a, b in found]
            digest.append(hashlib.sha256(",".join(w for w, (k, _, _) in zip(written, found, strict=True) if k in BASE).encode()).hexdigest())
            spans.append(",".join(written))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
        )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
