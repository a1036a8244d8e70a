"""The labelling loop: bounded attempts, each written before it is judged, so a lost executor never asks twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclattice.session import materialize

ATTEMPTS, WIDEN_AT = 3, 0.3


def ask(requests: DataFrame, labeler: Callable[[DataFrame], DataFrame], validate: Callable[[DataFrame], DataFrame], attempts: int = ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """(answers, failed). labeler adds `response` to (request_id, payload, attempt, issues); validate gives (request_id, code).

    Answers are valid responses with their attempt; failed are requests without one, with the sorted codes of the last attempt.
    """
    pending = requests.select("request_id", "payload").withColumn("issues", F.array().cast("array<string>"))
    answers: DataFrame | None = None
    for attempt in range(1, attempts + 1):
        asked = materialize(labeler(pending.withColumn("attempt", F.lit(attempt))), "responses", small=True)
        found = materialize(validate(asked).groupBy("request_id").agg(F.sort_array(F.collect_set("code")).alias("codes")), "issues", small=True)
        good = asked.join(found, "request_id", "left_anti").select("request_id", "response", "attempt")
        answers = good if answers is None else answers.unionByName(good)
        pending = materialize(asked.select("request_id", "payload").join(found.withColumnRenamed("codes", "issues"), "request_id"), "pending", small=True)
        if not pending.limit(1).count():
            break
    return answers, pending.select("request_id", F.col("issues").alias("codes"))


def context_missing_ratio(units: DataFrame, key: list[str]) -> DataFrame:
    """Share of units that an annotation calls CONTEXT_MISSING; at WIDEN_AT a request is asked again with more context."""
    hit = F.exists("reasons", lambda r: r.eqNullSafe(F.lit("CONTEXT_MISSING")))
    return units.groupBy(*key).agg(F.coalesce(F.avg(F.coalesce(hit, F.lit(False)).cast("int")), F.lit(0.0)).alias("ratio")).withColumn("widen", F.col("ratio") >= WIDEN_AT)


def label_documents(
    document_requests: DataFrame,
    block_requests: Callable[[DataFrame], DataFrame],
    widened: Callable[[DataFrame], DataFrame],
    labeler: Callable[[DataFrame], DataFrame],
    validate_document: Callable[[DataFrame], DataFrame],
    validate_blocks: Callable[[DataFrame], DataFrame],
    units: Callable[[DataFrame], DataFrame],
    attempts: int = ATTEMPTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(document answers, block answers, failed): the document pass, then block passes, then one widening.

    block_requests makes requests (request_id, payload, local: whether their context is partial) of the document answers. units makes (request_id, reasons) of block
    answers; where a local request's share of CONTEXT_MISSING reaches WIDEN_AT it is asked once more with widened's payload. A valid answer to
    that replaces the narrower one, which is kept otherwise. failed has the unit (document or blocks) and the sorted codes.
    """
    told, unheard = ask(document_requests, labeler, validate_document, attempts)
    told = materialize(told, "documents", small=True)
    requests = materialize(block_requests(told), "requests", small=True)
    answers, failed = ask(requests, labeler, validate_blocks, attempts)
    answers = materialize(answers, "answers", small=True)
    thin = context_missing_ratio(units(answers), ["request_id"]).where("widen").select("request_id")
    again = materialize(widened(requests.where("local").join(thin, "request_id", "left_semi")), "widened", small=True)
    wide, _ = ask(again, labeler, validate_blocks, attempts)
    wide = materialize(wide, "wide", small=True).withColumn("wide", F.lit(True))
    kept = answers.join(wide.select("request_id"), "request_id", "left_anti").withColumn("wide", F.lit(False))
    lost = unheard.withColumn("unit", F.lit("document")).unionByName(failed.withColumn("unit", F.lit("blocks")))
    return told, kept.unionByName(wide), lost
