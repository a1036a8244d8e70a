"""Language identification by Bayesian evidence fusion.

For each page and each document, the log posterior over languages adds up four kinds of evidence:

- text: log likelihood of the whole visible text under hashed byte-triple models, one a language, counted over
  all documents whose language is labelled; tempered, as neighbouring triples aren't independent;
- declared markup language: P(declared | language);
- address suffix: P(suffix | language);
- host: a prior smoothed hierarchically, host to domain to suffix to the whole corpus (Dirichlet).

The tables behind the last three are grouped counts over all rows, the language being the text's best one.
Tables by host are joined on the host, so nothing that grows with the corpus is broadcast; a hot host is one row
of the table after partial aggregation, and the join on it is left to Spark's skew handling. Only rows of a few
numbers travel, never texts.

Documents take part with their source as the host, and without markup or address. Their own label is not
evidence, only training data.

Result: one row per page and per document: kind ("page" or "document"), doc_id, page_id, language,
text_language (text alone), declared, confidence. Null or empty texts have no text evidence: the priors decide. A
null or malformed url has no host and no suffix. Repeated rows have a result each. Extra columns are ignored.
Without labelled documents the language is null. Empty tables give no rows. Very long and broken markup takes time in
proportion to its length (see visible). Labels beyond the LANGUAGES most frequent ones count as none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclattice.session import materialize, short_batches

#: Hash buckets of byte triples, temper of the text's likelihood, pseudo-counts of a level's parent, and of a table's cell.
BUCKETS, TEMPER, KAPPA, ALPHA = 1 << 16, 0.1, 5.0, 1.0
#: Bytes that are looked up at once.
CHUNK = 1 << 20

#: Languages that the model knows: the labels of most documents, ties to the smaller one. Rarer labels are no evidence.
LANGUAGES = 256

LANG = re.compile(rb"\blang\s*=\s*[\"']?([a-z]{2,3})")
NAME = re.compile(rb"[a-z0-9_]*")
LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c in (9, 10, 11, 12, 13) or 33 <= c <= 64 else c for c in range(256))


def triples(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of the byte triples, a chunk at a time. Digits and ASCII punctuation count as spaces."""
    data = np.frombuffer(text.translate(LOWER), np.uint8)
    for i in range(0, max(len(data) - 2, 0), CHUNK):
        d = data[i : i + CHUNK + 2].astype(np.uint32)
        yield ((d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]) * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64)


def visible(html: bytes) -> bytes:
    """Text outside tags, comments, scripts and styles; each of these is a space. One pass: every search goes on where the last ended.

    A comment, script or style that isn't closed reaches to the end; a < after which no > comes is text."""
    low, out, at = html.lower(), [], 0
    while (start := html.find(b"<", at)) >= 0:
        out.append(html[at:start])
        name = NAME.match(low, start + 1)[0]
        if low.startswith(b"<!--", start):
            end = html.find(b"-->", start + 4)
            at = end + 3 if end >= 0 else len(html)
        else:
            closing = low.find(b"</" + name, start) if name in (b"script", b"style") else start
            at = html.find(b">", closing) + 1 if closing >= 0 else len(html)
            if not at:
                if closing == start:
                    out.append(html[start:])
                at = len(html)
        out.append(b" ")
    out.append(html[at:])
    return b"".join(out)


def declared_language(html: bytes) -> str | None:
    """The first two or three letters of the lang attribute of the first html tag that has one."""
    low, at = html.lower(), 0
    while (start := low.find(b"<html", at)) >= 0:
        at = start + 5
        if NAME.match(low, at)[0]:
            continue
        end = low.find(b">", at)
        # A tag without an end holds all that follows.
        if told := LANG.search(low, at, len(low) if end < 0 else end):
            return told[1].decode()
        if end < 0:
            return None
        at = end + 1
    return None


def _train(languages: list[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                if text.is_valid and lang in place:
                    mine = counts.setdefault(place[lang], np.zeros(BUCKETS, np.int64))
                    for t in triples(text.as_py().encode("utf-8", "surrogatepass")):
                        mine += np.bincount(t, minlength=BUCKETS)
        for lang, mine in counts.items():
            bucket = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), lang)), pa.array(bucket), pa.array(mine[bucket])], ["lang", "bucket", "n"])

    return run


def text_model(docs: DataFrame, most: int = LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities by bucket and language. Its size is BUCKETS times most at the most."""
    labelled = docs.where("lang is not null").select("text", "lang")
    languages = sorted(r.lang for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect())
    model = np.zeros((len(languages), BUCKETS))
    if languages:
        rows = labelled.mapInArrow(_train(languages), "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        model[rows["lang"], rows["bucket"]] = rows["n"]
    return languages, np.ascontiguousarray(np.log((model + ALPHA) / (model.sum(1, keepdims=True) + ALPHA * BUCKETS)).T.astype(np.float32))


def _evidence(shared, html: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, declared = np.zeros((len(batch), model.shape[1])), []
            for row, raw in enumerate(batch.column("raw")):
                text = raw.as_py().encode("utf-8", "surrogatepass") if raw.is_valid else b""
                if html:
                    declared.append(declared_language(text))
                    text = visible(text)
                else:
                    declared.append(None)
                for t in triples(text):
                    scores[row] += model[t].sum(axis=0, dtype=np.float64)
            flat = pa.array((scores * TEMPER).ravel())
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * model.shape[1])
            best = scores.argmax(1).astype(np.int32) if model.shape[1] else np.zeros(len(batch), np.int32)
            told_apart = pa.array(best, mask=(scores.max(1) == scores.min(1)) if model.shape[1] else np.ones(len(batch), bool))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(declared, pa.string()), pa.ListArray.from_arrays(offsets, flat), told_apart], ["id", "url", "declared", "loglik", "best"])

    return run


def _counts(rows: DataFrame, key: str, n: int) -> DataFrame:
    """key, counts (array by language) over rows whose text has a best language."""
    each = rows.where(F.col(key).isNotNull() & F.col("best").isNotNull()).groupBy(key, "best").agg(F.count("*").alias("n"))
    grouped = each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m"))
    return grouped.select(key, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.element_at("m", i.cast("int")), F.lit(0)).cast("double")).alias(f"{key}_n"))


def _smooth(counts: str, parent: Column, n: int) -> Column:
    """(counts + KAPPA * parent) / (sum + KAPPA); without counts, the parent."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.col(counts).isNull(), parent).otherwise(F.zip_with(counts, parent, lambda c, p: (c + KAPPA * p) / (total + KAPPA)))


def _given_language(counts: str, totals: Column, values: Column) -> Column:
    """log P(value | language) of one value, from its counts by language; 0 everywhere where there is no value."""
    return F.zip_with(counts, totals, lambda c, t: F.log((c + ALPHA) / (t + ALPHA * values)))


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    short_batches(docs.sparkSession)
    spark = docs.sparkSession
    languages, model = text_model(docs.select("text", "lang"))
    shared, n = spark.sparkContext.broadcast(model), len(languages)
    schema = "id long, url string, declared string, loglik array<double>, best int"
    page = pages.select(F.col("page_id").cast("long").alias("id"), "url", F.col("html").alias("raw")).mapInArrow(_evidence(shared, True), schema)
    doc = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("source").alias("url"), F.col("text").alias("raw")).mapInArrow(_evidence(shared, False), schema)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    page = page.select("*", F.lit("page").alias("kind"), F.when(host != "", host).alias("host"))
    page = page.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    doc = doc.select("*", F.lit("document").alias("kind"), F.concat(F.lit("source:"), "url").alias("host"), F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("suffix"))
    rows = materialize(page.unionByName(doc).drop("url"), "evidence")
    if not n:
        return rows.select(*_ids(), F.lit(None).cast("string").alias("language"), F.lit(None).cast("string").alias("text_language"), "declared", F.lit(None).cast("double").alias("confidence"))

    # Totals by language: one row of n numbers; suffixes and declarations are counted, not collected.
    whole = rows.where("best is not null").groupBy("kind", "best").agg(F.count("*").alias("n")).collect()
    total = [float(sum(r.n for r in whole if r.best == i)) for i in range(n)]
    on_pages = F.array(*[F.lit(float(sum(r.n for r in whole if r.best == i and r.kind == "page"))) for i in range(n)])
    top = F.array(*[F.lit((t + ALPHA) / (sum(total) + ALPHA * n)) for t in total])
    kinds = rows.agg(F.countDistinct("declared").alias("d"), F.countDistinct("suffix").alias("s")).first()
    suffixes = materialize(_counts(rows, "suffix", n), "suffixes", small=True)
    domains = _counts(rows, "domain", n).withColumn("suffix", F.substring_index("domain", ".", -1)).join(suffixes, "suffix", "left")
    domains = domains.select("domain", _smooth("domain_n", _smooth("suffix_n", top, n), n).alias("domain_p"))
    hosts = rows.where("host is not null").select("host", "domain").distinct().join(_counts(rows, "host", n), "host", "left").join(domains, "domain", "left")
    hosts = hosts.select("host", _smooth("host_n", F.coalesce("domain_p", top), n).alias("prior"))
    hosts = materialize(hosts, "hosts", small=True)
    declared = materialize(_counts(rows, "declared", n), "declared", small=True)

    zero = F.array(*[F.lit(0.0)] * n)
    fused = (
        rows.join(hosts, "host", "left").join(declared, "declared", "left").join(suffixes, "suffix", "left")
        .withColumn("prior", F.transform(F.coalesce("prior", top), lambda p: F.log(p)))
        .withColumn("from_declared", F.coalesce(_given_language("declared_n", on_pages, F.lit(float(max(kinds.d, 1)))), zero))
        .withColumn("from_suffix", F.coalesce(_given_language("suffix_n", on_pages, F.lit(float(max(kinds.s, 1)))), zero))
        .withColumn("posterior", F.zip_with(F.zip_with("loglik", "prior", lambda a, b: a + b), F.zip_with("from_declared", "from_suffix", lambda a, b: a + b), lambda a, b: a + b))
        .withColumn("most", F.array_max("posterior"))
    )
    names = F.array(*[F.lit(x) for x in languages])
    mass = F.aggregate(F.transform("posterior", lambda x: F.exp(x - F.col("most"))), F.lit(0.0), lambda a, x: a + x)
    return fused.select(
        *_ids(), F.element_at(names, F.array_position("posterior", F.col("most")).cast("int")).alias("language"),
        F.when(F.col("best").isNotNull(), F.element_at(names, F.coalesce("best", F.lit(0)) + 1)).alias("text_language"), "declared", (1.0 / mass).alias("confidence"),
    )


def _ids() -> list[Column]:
    return [F.col("kind"), F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"), F.when(F.col("kind") == "page", F.col("id")).alias("page_id")]


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/pages.parquet"))
