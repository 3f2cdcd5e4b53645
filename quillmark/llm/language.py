"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence meet as log probabilities: how likely the visible text is in a language
(byte trigrams), which language the markup declares, the last part of the host's name, and a
prior for the host. The reliability of declarations and suffixes, and the host priors, come
from grouped sums of the text posteriors of all pages. A host's prior is smoothed by its
domain's, that by the prior of all pages. A page is taken out of the sums it meets, so it
never confirms itself.

Trigram likelihoods are learned from a bounded sample of texts with known languages.
"""

from __future__ import annotations

import html
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, schemas, stored
from quillmark.llm.words import slices

BITS, PER_LANGUAGE, LANGUAGES, SMOOTHING = 14, 1000, 256, 0.5
# Trigrams of a text are far from independent: at most so many count as evidence of their own.
EVIDENCE, HOST_WEIGHT, DOMAIN_WEIGHT, CUE_WEIGHT, FLOOR = 20.0, 5.0, 20.0, 10.0, 1e-4

# What a reader does not read as the page's own text.
UNSEEN = re.compile(
    rb"<!--.*?(?:-->|$)|<(script|style|nav|aside|footer|noscript)\b.*?(?:</\1\s*>|$)"
    rb"|<div\b[^>]*?\bclass\s*=\s*[\"']?(?:ads?|advert\w*|banner)\b.*?(?:</div\s*>|$)",
    re.S | re.I,
)
TAG = re.compile(rb"<[^>]*>")


def visible(page: bytes) -> bytes:
    """The text of a page in bytes, lower case, without markup."""
    text = TAG.sub(b" ", UNSEEN.sub(b" ", page)).decode("utf-8", "replace")
    return " ".join(html.unescape(text).lower().split()).encode()


def trigrams(data: np.ndarray) -> np.ndarray:
    """Hashed byte trigrams in order; letters and blanks only, so signs say nothing."""
    d = data.astype(np.uint32)
    letter = ((d >= 97) & (d <= 122)) | (d >= 128) | (d == 32)
    grams = d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]
    return (grams * np.uint32(2654435761) >> np.uint32(32 - BITS))[letter[:-2] & letter[1:-1] & letter[2:]] if len(d) > 2 else np.zeros(0, np.uint32)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each trigram in each; from at most ``per_language`` ids of each, those of the smallest hashes.

    So a rare language is learned as well. Rows without text, language or id teach nothing. More
    languages than ``LANGUAGES`` are an error.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    if known.select(lang_col).distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages")
    # Ids of each language are counted by the leading bits of their hashes, at most 65,536 counters
    # a language; only those below the cut are ranked, so a frequent language is no hot key.
    ids = known.select(F.col(id_col).alias("_chosen"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("_hash"))
    ids = ids.withColumn("_lead", F.shiftrightunsigned("_hash", 48))
    before = Window.partitionBy("lang").orderBy("_lead").rowsBetween(Window.unboundedPreceding, -1)
    leads = ids.groupBy("lang", "_lead").agg(F.count(F.lit(1)).alias("_n"))
    leads = leads.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < per_language)
    cuts = stored(leads.groupBy("lang").agg(F.max("_lead").alias("_cut")), "language-cuts")  # a row for each language
    first = Window.partitionBy("lang").orderBy("_lead", "_hash", "_chosen")
    chosen = ids.join(F.broadcast(cuts), "lang").where(F.col("_lead") <= F.col("_cut"))
    chosen = chosen.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= per_language).select("_chosen", "lang").distinct()
    rows = known.select(F.col(id_col).alias("_chosen"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(F.broadcast(chosen), ["_chosen", "lang"])
    schema, arrow = schemas("lang string, counts binary")

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, last, data, at in slices(batch.column("text")):
                raw = data.tobytes()
                for k in range(last - first):
                    words = b" ".join(raw[at[k] : at[k + 1]].decode("utf-8", "replace").lower().encode().split())
                    grams = np.bincount(trigrams(np.frombuffer(words, np.uint8)), minlength=1 << BITS)
                    lang = langs[first + k]
                    totals[lang] = totals.get(lang, 0) + grams
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array([t.astype(np.int64).tobytes() for t in totals.values()], pa.binary())], schema=arrow)

    # A row for each task and language with sampled texts, taken one by one.
    totals: dict[str, np.ndarray] = {}
    for row in rows.select("lang", "text").mapInArrow(count, schema).toLocalIterator():
        totals[row["lang"]] = totals.get(row["lang"], 0) + np.frombuffer(row["counts"], np.int64)
    langs = sorted(totals)
    if not langs:
        return [], np.zeros((0, 1 << BITS))
    table = np.stack([totals[x] for x in langs]) + SMOOTHING
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def _evidence(pages: DataFrame, table: np.ndarray, html_col: str, url_col: str, id_col: str) -> DataFrame:
    """Each page's cues and the log likelihoods of its text."""
    shipped = pages.sparkSession.sparkContext.broadcast(table)
    url = F.lower(F.coalesce(F.col(url_col), F.lit("")))
    host = F.regexp_replace(F.regexp_extract(url, r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), r"\.$", "")
    declared = F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)
    rows = numbered(pages, F.col(id_col).alias("page_id"), host.alias("host"), F.lower(declared).alias("declared"), F.col(html_col).alias("html"))
    schema, arrow = schemas(f"_row long, page_id {pages.schema[id_col].dataType.simpleString()}, host string, declared string, logs array<double>")

    def weigh(batches):
        table = shipped.value
        for batch in batches:
            logs = []
            for _, _, data, at in slices(batch.column("html")):
                raw = data.tobytes()
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    grams = trigrams(np.frombuffer(visible(raw[a:b]), np.uint8))
                    n = len(grams)
                    logs.append((table[:, grams].sum(axis=1) * (min(1.0, EVIDENCE / n) if n else 0.0)).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "page_id", "host", "declared")), pa.array(logs, arrow.field("logs").type)], schema=arrow)

    return rows.mapInArrow(weigh, schema)


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    raised = [F.exp(x - top) for x in logs]
    total = reduce(lambda a, b: a + b, raised)
    return [x / total for x in raised]


def identify(pages: DataFrame, langs: list[str], table: np.ndarray, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """``_row, page_id, host, declared, text_language, language, probability`` for each page.

    ``text_language`` is by the text alone. A page without text, markup language or host is
    judged by what it has, by the prior of all pages if it has nothing; ties go to the language
    first in order. Without any known language ``language`` is null. Repeated rows and null ids
    are rows like any other; an empty table gives none; other columns are not read.
    """
    k = range(len(langs))
    rows = _evidence(pages, table, html_col, url_col, id_col)
    if not langs:
        nothing = F.lit(None).cast("string")
        return rows.select("_row", "page_id", "host", "declared", nothing.alias("text_language"), nothing.alias("language"), F.lit(None).cast("double").alias("probability"))
    rows = rows.select("_row", "page_id", "host", "declared", *[F.col("logs")[i].alias(f"t{i}") for i in k])
    rows = rows.select("*", *[p.alias(f"p{i}") for i, p in zip(k, _softmax([F.col(f"t{i}") for i in k]))])
    labels = F.split("host", r"\.")
    numeric = F.col("host").rlike(r"^[0-9.]*$")
    rows = rows.withColumn("domain", F.when(numeric, F.col("host")).otherwise(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")))
    rows = stored(rows.withColumn("suffix", F.when(numeric, "").otherwise(F.element_at(labels, -1))), "pages")
    sums = [F.sum(f"p{i}").alias(f"s{i}") for i in k]
    every = rows.agg(*sums, F.count(F.lit(1)).alias("n")).first()
    prior = [((every[f"s{i}"] or 0.0) + 1) / (every["n"] + len(langs)) for i in k]
    hosts = rows.groupBy("host", "domain").agg(*sums, F.count(F.lit(1)).alias("n"))
    hosts = stored(hosts, "hosts")
    domains = hosts.groupBy("domain").agg(*[F.sum(f"s{i}").alias(f"d{i}") for i in k], F.sum("n").alias("dn"))
    hosts = stored(hosts.join(domains, "domain").drop("domain"), "host-sums")
    declared = stored(rows.groupBy("declared").agg(*[F.sum(f"p{i}").alias(f"c{i}") for i in k]), "declared")
    suffixes = stored(rows.groupBy("suffix").agg(*[F.sum(f"p{i}").alias(f"x{i}") for i in k]), "suffixes")
    met = rows.join(hosts, "host").join(declared, "declared").join(suffixes, "suffix")

    def own(name: str, i: int) -> Column:
        return F.greatest(F.col(f"{name}{i}") - F.col(f"p{i}"), F.lit(0.0))

    logs = []
    for i in k:
        domain = (own("d", i) + DOMAIN_WEIGHT * prior[i]) / (F.col("dn") - 1 + DOMAIN_WEIGHT)
        host = (own("s", i) + HOST_WEIGHT * domain) / (F.col("n") - 1 + HOST_WEIGHT)
        total = max(every[f"s{i}"] or 0.0, 1.0)
        # How often this cue is seen with the language, against how often it would be by chance.
        seen = [(own(c, i) + CUE_WEIGHT * FLOOR) / (total + CUE_WEIGHT) for c in ("c", "x")]
        cues = [F.when(F.col(cue) == "", F.lit(0.0)).otherwise(F.log(s)) for cue, s in zip(("declared", "suffix"), seen)]
        logs.append(F.col(f"t{i}") + F.log(host) + cues[0] + cues[1])
    met = met.select("_row", "page_id", "host", "declared", *[F.col(f"t{i}") for i in k], *[x.alias(f"l{i}") for i, x in zip(k, logs)])
    met = met.select("*", *[p.alias(f"q{i}") for i, p in zip(k, _softmax([F.col(f"l{i}") for i in k]))])

    def best(prefix: str) -> Column:
        return reduce(lambda rest, i: F.when(F.col(f"{prefix}{i}") == F.greatest(*[F.col(f"{prefix}{j}") for j in k], F.lit(float("-inf"))), langs[i]).otherwise(rest), reversed(k), F.lit(None).cast("string"))

    return met.select(
        "_row", "page_id", "host", "declared", best("t").alias("text_language"), best("q").alias("language"),
        F.greatest(*[F.col(f"q{i}") for i in k], F.lit(0.0)).alias("probability"),
    )
