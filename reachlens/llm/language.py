"""Language identification by Bayesian evidence fusion.

log P(lang | page) = text likelihood (hashed byte trigrams, learned from
labelled documents) + declared markup language + address suffix + host prior
(+ constant). The last three are estimated from the pages themselves, by grouped
counts of the languages that the text alone suggests. Host priors are smoothed
hierarchically: a host leans on its domain, the domain on all pages. A page's
own vote is taken out of the counts of its host and domain.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored
from .html_text import main_text
from .site_lines import host

#: Buckets of the trigram hash.
BUCKETS = 1 << 15
#: The classifier is fitted on about so many documents of a language, drawn by hash.
TRAIN_PER_LANGUAGE = 2000
#: Neighbouring trigrams share bytes, so their evidence counts a third.
TEMPER = 1 / 3
#: Pseudo-counts: of a host's prior from its domain, of a domain's from all pages, of declared languages and suffixes.
HOST_WEIGHT, DOMAIN_WEIGHT, EVIDENCE_WEIGHT = 5.0, 20.0, 2.0


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased words with spaces around them."""
    b = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = (b[:-2] * np.uint32(65599) + b[1:-1]) * np.uint32(65599) + b[2:]
    return ((h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS)).astype(np.int64)


def unit_hash(col: Column) -> Column:
    """A number in [0, 1) from the value's hash, fine enough for shares of any size of table."""
    return F.shiftrightunsigned(F.xxhash64(col.cast("string"), F.lit("train")), 11) / F.lit(float(1 << 53))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages, log P(trigram | language)) from labelled documents, for every label; nulls are left out.

    The model has BUCKETS numbers a language; nothing else here grows with the languages but counts of them.
    """
    known = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(label_col).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return ["und"], np.zeros((1, BUCKETS))
    share = reduce(lambda c, x: c.when(F.col(label_col) == x, per_language / sizes[x]), languages, F.when(F.lit(False), 0.0))
    sample = known.filter(unit_hash(F.col(id_col)) < share).select(F.col(label_col).alias("label"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                own = sums.setdefault(label, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for label, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"label": label, "bucket": at.astype(np.int32), "n": own[at]})

    cells = sample.mapInPandas(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((len(languages), BUCKETS), 0.5)
    table[cells["label"].map({x: i for i, x in enumerate(languages)}).to_numpy(), cells["bucket"].to_numpy()] += cells["n"].to_numpy()
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def text_scores(pages: DataFrame, model: np.ndarray, text_col: str, is_html: bool) -> DataFrame:
    """``pages`` with ``scores``: tempered log likelihood by language; zeros if there is no text."""
    table = np.ascontiguousarray(model.T * TEMPER)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([table[trigrams(main_text(x) if is_html else x or "")].sum(axis=0) for x in batch])

    return pages.withColumn("scores", F.pandas_udf(score, "array<double>")(F.coalesce(F.col(text_col), F.lit(""))))


def declared_language(page: Column) -> Column:
    """Primary tag of the html element's lang attribute, lower case; empty if there is none."""
    element = F.regexp_extract(F.coalesce(page, F.lit("")), "(?is)<html\\b([^>]*)>", 1)
    return F.lower(F.regexp_extract(element, "(?i)(?:^|\\s)(?:xml:)?lang\\s*=\\s*[\"']?\\s*([a-zA-Z]{2,3})(?![a-zA-Z])", 1))


def identify(pages: DataFrame, languages: list[str], model: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, host, declared, suffix, text_lang, lang, confidence.

    ``text_lang`` is what the text alone says, null without text; such pages are
    judged by the other evidence. Null urls share an empty host. Ties go to the
    first language in order. The tables of evidence have a row by host, and by
    language and declared tag (any tag that is not a known language counts as
    "other"), so only the latter, bounded ones pass through the driver.
    """
    prepare(pages.sparkSession)
    n = len(languages)
    site = host(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), site.alias("host"), declared_language(F.col(html_col)).alias("declared"), F.col(html_col).alias("page"))
    rows = text_scores(rows, model, "page", True).drop("page")
    best = F.array_position(F.col("scores"), F.array_max("scores")).cast("int")
    rows = stored(rows.withColumn("vote", F.when(F.array_max("scores") != F.array_min("scores"), best)), "page-evidence")
    own = [F.coalesce(F.col("vote") == i + 1, F.lit(False)).cast("double") for i in range(n)]
    kind = F.when(F.col("declared").isin(languages), F.array_position(F.array(*map(F.lit, languages)), F.col("declared")).cast("int") - 1).when(F.col("declared") == "", n + 1).otherwise(n)

    # votes by host, then by domain and suffix, all from the table of hosts
    votes = F.array(*[F.sum(x) for x in own])
    hosts = stored(rows.groupBy("host").agg(votes.alias("own")), "host-votes")
    named = hosts.withColumn("suffix", F.element_at(F.split("host", "\\."), -1)).withColumn("domain", F.array_join(F.slice(F.reverse(F.split("host", "\\.")), 1, 2), "."))
    add = [F.sum(F.col("own")[i]) for i in range(n)]
    domains = stored(named.groupBy("domain").agg(F.array(*add).alias("domain_own")), "domain-votes")
    suffixes = stored(named.groupBy("suffix").agg(F.array(*add).alias("suffix_own")), "suffix-votes")
    total = [float(x or 0) for x in suffixes.agg(*[F.sum(F.col("suffix_own")[i]) for i in range(n)]).first()]
    every = sum(total)
    prior = [(x + 1) / (every + n) for x in total]
    table = named.join(domains, "domain").join(suffixes, "suffix").select("host", "suffix", "own", "domain_own", "suffix_own")
    table = stored(table, "host-evidence")

    # declared tag given language
    said = {(r["kind"], r["vote"]): r["n"] for r in rows.filter("vote is not null").groupBy(kind.alias("kind"), "vote").agg(F.count("*").alias("n")).collect()}
    by_kind = [sum(said.get((k, v), 0) for v in range(1, n + 1)) for k in range(n + 2)]
    p_kind = [(x + 1) / (every + n + 2) for x in by_kind]
    declared = [(k, [float(np.log((said.get((k, i + 1), 0) + EVIDENCE_WEIGHT * p_kind[k]) / (total[i] + EVIDENCE_WEIGHT))) for i in range(n)]) for k in range(n + 2)]
    declared = pages.sparkSession.createDataFrame(declared, "kind int, declared_score array<double>")

    # expressions that do not grow with the square of the languages
    out = rows.withColumn("kind", kind).join(table, "host").join(F.broadcast(declared), "kind")
    for name in ("own", "domain_own", "suffix_own"):
        out = out.withColumn(f"{name}_sum", F.aggregate(name, F.lit(0.0), lambda a, x: a + x))
    priors, totals = F.array(*map(F.lit, prior)), F.array(*map(F.lit, total))
    voted = F.col("vote").isNotNull().cast("double")

    def fused(score, i):
        mine = F.coalesce(F.col("vote") == i + 1, F.lit(False)).cast("double")
        above = (F.get("domain_own", i) - mine + DOMAIN_WEIGHT * F.get(priors, i)) / (F.col("domain_own_sum") - voted + DOMAIN_WEIGHT)
        here = (F.get("own", i) - mine + HOST_WEIGHT * above) / (F.col("own_sum") - voted + HOST_WEIGHT)
        share = F.col("suffix_own_sum") / max(every, 1.0)
        suffix = (F.get("suffix_own", i) + EVIDENCE_WEIGHT * share) / (F.get(totals, i) + EVIDENCE_WEIGHT)
        return score + F.log(here) + F.log(F.greatest(suffix, F.lit(1e-9))) + F.get("declared_score", i)

    out = out.withColumn("fused", F.transform("scores", fused))
    names = F.array(*map(F.lit, languages))
    top = F.array_max("fused")
    confidence = 1 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return out.select("page_id", "url", "host", "declared", "suffix", F.get(names, F.col("vote") - 1).alias("text_lang"),
                      F.get(names, (F.array_position("fused", top) - 1).cast("int")).alias("lang"), confidence.alias("confidence"))
