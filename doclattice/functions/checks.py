"""Checks of settings, requests and replies as column expressions; each is true where the value passes."""

from __future__ import annotations

import hmac

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A host's form, and the value that a setting has before it is set.
HOST = r"^(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$"
UNSET = "replace-me"


def filled(text: Column) -> Column:
    """A string that isn't blank."""
    return F.coalesce(F.regexp_replace(text, r"(?U)\s+", "") != "", F.lit(False))


def secret_set(text: Column) -> Column:
    return filled(text) & (text != UNSET)


def exact_host(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(HOST)), F.lit(False))


def key_prefix(text: Column) -> Column:
    """Relative, and with a slash at its end."""
    return filled(text) & ~F.startswith(text, F.lit("/")) & F.endswith(text, F.lit("/"))


def https_source(url: Column) -> Column:
    """https with a host, on no port but 443, without user, password or fragment."""
    port = F.regexp_extract(url, r"^https://[^/?#@]+:(\d*)(?:[/?#]|$)", 1)
    shape = F.rlike(url, F.lit(r"^https://[^/?#@:\s]+(?::\d*)?(?:[/?][^#]*)?$"))
    return F.coalesce(shape & ((port == "") | (port == "443")), F.lit(False))


def same_secret(given: Column, expected: str) -> Column:
    """Compared in a time that doesn't depend on where they differ."""

    def same(values: pd.Series) -> pd.Series:
        return values.map(lambda x: x is not None and hmac.compare_digest(x.encode(), expected.encode()))

    return F.pandas_udf(same, "boolean")(given)


def chronological(started: Column, completed: Column) -> Column:
    return F.coalesce(completed >= started, F.lit(False))


def json_value(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def same_action(code: Column, action: Column, actions: dict[str, str]) -> Column:
    """The action is the one that its code asks for; an unknown code has none."""
    known = F.create_map(*[F.lit(x) for pair in actions.items() for x in pair])
    return F.coalesce(F.element_at(known, code) == action, F.lit(False))
