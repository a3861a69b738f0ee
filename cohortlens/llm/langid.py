"""Language of web pages: Bayesian fusion of four kinds of evidence.

P(lang | page) is proportional to
    P(text | lang) * P(declared | lang) * P(suffix | lang) * P(lang | host)

* text: character trigrams (hashed) under a naive Bayes model.  The model is
  fitted on at most ``per_lang`` labelled documents of each language, those of
  the smallest id hashes (a documented, bounded sample; a language whose ids
  hash oddly may give fewer).  Neighbouring
  trigrams repeat each other, so the sum counts as one third of its trigrams;
* declared: the ``lang`` of the ``<html>`` tag (primary part), ``none``
  without one;
* suffix: the last label of the host name;
* host: share of each language among the host's pages, smoothed towards its
  domain's, which is smoothed towards all pages' (``strength`` pages each).

The last three come from counts over all pages: grouped sums of each page's
text posterior.  A page's own part is taken out of its host's and domain's
sums, so it does not confirm itself.  Sums are pre-aggregated before any
shuffle, and small sums are written before they are joined, so Spark can
split the join of a host with very many pages.

Defined results
* null html: no text and nothing declared; null or malformed url: host,
  domain and suffix are empty strings, which form a group of their own;
* without any labelled document there is no language: lang null, posterior
  null; equal posteriors: the language that sorts first;
* repeated pages stay rows and count as pages; an empty table gives an empty
  result; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import freeze, table

CELLS = 1 << 14
PER_LANG = 2000
STRENGTH = 5.0
OVERLAP = 3            # trigrams that share each character

_drop = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_declared = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)
_host = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
_letters = re.compile(r"[\W\d_]+")


def trigrams(text: str) -> np.ndarray:
    """Cells of the trigrams of a text's letters, words framed by spaces."""
    return cells_of(f" {_letters.sub(' ', text.lower()).strip()} ")


def cells_of(framed: str) -> np.ndarray:
    c = np.frombuffer(framed.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    x = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(50)).astype(np.int64)


def page_text(page: str | None) -> str:
    return html.unescape(_drop.sub(" ", page)) if page else ""


def _counts(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            sums.setdefault(lang, np.zeros(CELLS, np.int64))
            sums[lang] += np.bincount(trigrams(text.as_py() or ""), minlength=CELLS)
    for lang, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "cell", "n"])


def train(docs: DataFrame, per_lang: int = PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages, and log P(trigram cell | language)."""
    ids = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").select("lang", F.col("doc_id").cast("long").alias("id")).distinct()
    # hashes are even over 2**64: the share of them that holds about twice the
    # sample is all that is sorted, however many rows a language has
    size = freeze(ids.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "langid-sizes")
    ids = ids.join(size, F.col("lang") == F.col("of")).where(
        F.xxhash64("id").cast("double") / 2.0**64 + 0.5 <= 2.0 * per_lang / F.col("n")).select("lang", "id")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = freeze(ids.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang).select("id", F.col("lang").alias("of")), "langid-sample")
    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("lang"), F.col("text").cast("string").alias("text"))
    # one text for each sampled id, however many rows have it
    chosen = (chosen.join(sample.withColumnRenamed("id", "sampled"), (F.col("lang") == F.col("of")) & (F.col("id") == F.col("sampled")))
              .groupBy("lang", "id").agg(F.min("text").alias("text")).select("lang", "text"))
    rows = chosen.mapInArrow(_counts, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()  # CELLS a language
    langs = sorted({r.lang for r in rows})
    n = np.full((CELLS, len(langs)), 0.5)
    for r in rows:
        n[r.cell, langs.index(r.lang)] += r.n
    return langs, np.log(n / n.sum(0)).astype(np.float32)


def _evidence(batches, weights):
    for batch in batches:
        out = []
        for page, url in zip(batch.column("html"), batch.column("url").to_pylist()):
            page = page.as_py()
            cells = trigrams(page_text(page))
            found = _declared.search(page) if page else None
            m = _host.match(url) if url else None
            host = m[1].lower().rstrip(".") if m else ""
            parts = host.split(".")
            out.append((found[1].lower() if found else "none", parts[-1], ".".join(parts[-2:]), host,
                        (weights.value[cells].sum(0, dtype=np.float64) / OVERLAP).tolist()))
        cols = [pa.array(c, ty) for c, ty in zip(zip(*out), (*[pa.string()] * 4, pa.list_(pa.float64())))] if out else []
        if out:
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *cols], ["page_id", "declared", "suffix", "domain", "host", "ll"])


def _posterior(ll):
    """exp(ll) over its sum, without overflow."""
    e = F.transform(ll, lambda x: F.exp(x - F.array_max(ll)))
    return e, F.aggregate(e, F.lit(0.0), lambda a, x: a + x)


def identify(pages: DataFrame, docs: DataFrame, per_lang: int = PER_LANG, strength: float = STRENGTH) -> DataFrame:
    """(page_id, lang, posterior, text_lang, declared, host) of every page."""
    spark = pages.sparkSession
    langs, weights = train(docs, per_lang)
    n = len(langs)
    shared = spark.sparkContext.broadcast(weights)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = freeze(rows.mapInArrow(lambda b: _evidence(b, shared), "page_id long, declared string, suffix string, domain string, host string, ll array<double>"), "langid-pages")
    if not n:
        return rows.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    e, total = _posterior(F.col("ll"))
    rows = rows.withColumn("e", e).withColumn("p", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda a, y: a + y))).drop("e")
    vector = F.array(*[F.sum(F.col("p")[i]) for i in range(n)])

    def sums(key: str) -> DataFrame:
        return freeze(rows.groupBy(F.col(key).alias(f"of_{key}")).agg(vector.alias(f"n_{key}")), f"langid-{key}")

    whole = sums("host").agg(F.array(*[F.sum(F.col("n_host")[i]) for i in range(n)]).alias("all")).first()["all"]
    whole = [x or 0.0 for x in whole]  # no page, no sum
    everything = sum(whole)
    base = F.array(*[F.lit((x + 1.0 / n) / (everything + 1.0)) for x in whole])
    joined = rows
    values = {}
    for key in ("declared", "suffix", "domain", "host"):
        s = sums(key)
        values[key] = s.count() if key in ("declared", "suffix") else 0
        joined = joined.join(s, F.col(key) == F.col(f"of_{key}"))

    def share(counts, parent):  # smoothed shares, the page's own part taken out
        rest = F.zip_with(counts, F.col("p"), lambda a, b: F.greatest(a - b, F.lit(0.0)))
        size = F.aggregate(rest, F.lit(strength), lambda a, x: a + x)
        return F.transform(F.zip_with(rest, parent, lambda a, b: a + strength * b), lambda x: x / size)

    joined = joined.withColumn("by_domain", share(F.col("n_domain"), base))
    joined = joined.withColumn("by_host", share(F.col("n_host"), F.col("by_domain")))

    def likelihood(key):  # log P(value | language), add-one over the values seen
        of_lang = F.array(*[F.lit(x + values[key]) for x in whole])
        return F.zip_with(F.col(f"n_{key}"), of_lang, lambda a, b: F.log((a + 1) / b))

    ll = F.zip_with(F.zip_with(F.col("ll"), F.transform("by_host", lambda x: F.log(x)), lambda a, b: a + b),
                    F.zip_with(likelihood("declared"), likelihood("suffix"), lambda a, b: a + b), lambda a, b: a + b)
    joined = joined.withColumn("score", ll)
    e, total = _posterior(F.col("score"))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return joined.select("page_id", best(F.col("score")).alias("lang"), (F.array_max(e) / total).alias("posterior"),
                         best(F.col("ll")).alias("text_lang"), "declared", "host")


# ---------------------------------------------------------------- query

def op4_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


QUERIES = {"op4_language_id": op4_language_id}
SQL: dict[str, str] = {}
