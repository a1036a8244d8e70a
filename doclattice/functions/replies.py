"""Replies of a source: what a status means, and a body that is received under limits."""

from __future__ import annotations

import hashlib
import xml.etree.ElementTree as ET
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of refusals that mean that a signed address has expired.
EXPIRED = ("ExpiredToken", "RequestExpired")
ERROR_BYTES = 8192


def expired_reply(body: bytes) -> bool:
    """Whether a small XML error says that the request expired. Declarations of types or entities are refused unread."""
    if len(body) > ERROR_BYTES:
        return False
    try:
        text = body.decode("utf-8")
        if any(word in text.upper() for word in ("<!DOCTYPE", "<!ENTITY")):
            return False
        said = {child.tag: child.text for child in ET.fromstring(text)}
    except (UnicodeError, ET.ParseError):
        return False
    return said.get("Code") in EXPIRED or (said.get("Code"), said.get("Message")) == ("AccessDenied", "Request has expired")


def reply_error(status: Column, body: Column) -> Column:
    """The error of a reply, or null for 200. Only a body that says so makes a refusal an expired address."""

    def expired(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: b is not None and expired_reply(bytes(b)))

    late = status.isin(400, 403) & F.pandas_udf(expired, "boolean")(body)
    return (
        F.when(status == 200, None).when(status == 404, "SOURCE_NOT_FOUND").when(status.isin(408, 429) | (status >= 500), "SOURCE_DOWNLOAD_TEMPORARY_FAILURE")
        .when(late, "SOURCE_URL_EXPIRED").otherwise("SOURCE_ACCESS_DENIED")
    )


def received(chunks: Iterable[bytes], limit: int, length: int | None = None, sha256: str | None = None) -> tuple[int, str]:
    """Bytes and SHA-256 of a body that comes in parts; raises as soon as it passes the limit, and at its end if length or hash differ from what was declared."""
    digest, n = hashlib.sha256(), 0
    for chunk in chunks:
        n += len(chunk)
        if n > limit or (length is not None and n > length):
            raise ValueError("FILE_TOO_LARGE" if n > limit else "SIZE_MISMATCH")
        digest.update(chunk)
    if length is not None and n != length:
        raise ValueError("SIZE_MISMATCH")
    if sha256 is not None and digest.hexdigest() != sha256:
        raise ValueError("HASH_MISMATCH")
    return n, digest.hexdigest()
