"""Language of web pages: text likelihoods fused with declared language, address suffix and host priors."""

from __future__ import annotations

import html as markup
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourvault.llm.common import map_rows, stored, texts
from hourvault.llm.registry import query, table

#: Labelled documents of each language that train the text model, chosen by a hash of their id.
TRAINING_DOCUMENTS = 4096
#: Byte trigrams are counted in so many bins.
BINS = 1 << 14
#: Trigrams overlap and repeat: a text counts as no more independent evidence than this many of them.
EVIDENCE_TRIGRAMS = 40
#: Votes that a level of the address adds to the level below, and that smooth declared languages and suffixes.
STRENGTH = 5.0

HIDDEN = re.compile(r"<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", re.IGNORECASE | re.DOTALL)
TAG = re.compile(r"<[^>]*>")
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)", re.IGNORECASE)

SIGNALS = "page_id bigint, declared string, suffix string, domain string, host string, text array<double>, vote int"


def visible_text(page: str) -> str:
    return markup.unescape(TAG.sub(" ", HIDDEN.sub(" ", page)))


def declared_language(page: str) -> str:
    found = DECLARED.search(page)
    return found[1].lower() if found else ""


def address(url: str | None) -> tuple[str, str, str]:
    """(suffix, domain, host) in lower case; empty where there is none."""
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        host = ""
    parts = host.split(".")
    return parts[-1], ".".join(parts[-2:]), host


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams of the text in lower case, digits and punctuation left out."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    data = np.frombuffer((" " + " ".join(letters.split()) + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(BINS, np.int64)
    h = ((data[:-2] << 16) | (data[1:-1] << 8) | data[2:]) * np.uint32(2654435761)
    return np.bincount(h >> np.uint32(18), minlength=BINS)


def text_model(docs: DataFrame, documents: int = TRAINING_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Languages and their log shares of trigram bins (one added), from so many labelled documents of each.

    Every language with a labelled document is told apart. The driver gets one sum for each language and bin, whatever
    the number of documents.
    """
    labelled = docs.filter("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (labelled.select("doc_id", "lang").distinct().withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= documents)
              .select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")))
    rows = labelled.select("doc_id", "lang", "text").join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")

    def over(batches):
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
                sums[lang] = sums.get(lang, 0) + trigram_counts(text.decode("utf-8", "replace"))
            for lang, counts in sums.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at].astype(np.int64))],
                                                 names=["lang", "bin", "n"])

    counted = rows.mapInArrow(over, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counted = stored(counted, "language-bins")
    sums = counted.toArrow()
    languages, row = np.unique(np.array(sums["lang"].to_pylist(), object).astype(str), return_inverse=True)
    shares = np.ones((len(languages), BINS))
    shares[row, sums["bin"].to_numpy()] += sums["n"].to_numpy()
    return languages.tolist(), np.log(shares / shares.sum(axis=1, keepdims=True))


def page_signals(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """Signals of each page; `text` holds log likelihoods by language and `vote` the largest of them."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("declared", "suffix", "domain", "host", "text", "vote")}
        for url, data in zip(batch.column("url").to_pylist(), texts(batch, "html"), strict=True):
            page = data.decode("utf-8", "replace")
            counts = trigram_counts(visible_text(page))
            n = counts.sum()
            likelihood = sent.value @ counts * (min(1.0, EVIDENCE_TRIGRAMS / n) if n else 0.0)
            out["text"].append(likelihood - likelihood.max(initial=-np.inf))
            out["vote"].append(int(likelihood.argmax()) if n and len(likelihood) else None)
            out["declared"].append(declared_language(page))
            for name, value in zip(("suffix", "domain", "host"), address(url), strict=True):
                out[name].append(value)
        return out | {"page_id": batch.column("page_id")}

    return stored(map_rows(pages, run, SIGNALS), "language-signals")


def _votes(signals: DataFrame, key: str, n: int) -> DataFrame:
    """Votes by language for each value of a column: a grouped count of one row for each value and language first."""
    pairs = signals.groupBy(key, "vote").agg(F.count(F.lit(1)).cast("double").alias("n"))
    cast = pairs.groupBy(F.col(key).alias(f"_{key}")).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("vote").isNotNull(), F.struct("vote", "n")))).alias("_cast"))
    every = F.sequence(F.lit(0), F.lit(n - 1))
    return cast.select(f"_{key}", F.transform(every, lambda k: F.coalesce(F.try_element_at("_cast", k), F.lit(0.0))).alias(f"{key}_votes"))


def _total(votes: Column) -> Column:
    return F.aggregate(votes, F.lit(0.0), lambda s, x: s + x)


def page_languages(pages: DataFrame, docs: DataFrame, documents: int = TRAINING_DOCUMENTS, id_column: str = "page_id",
                   url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The language of each page with its probability: page_id, lang, probability, text_lang, declared, suffix, host.

    Posterior = text likelihood x P(declared | language) x P(suffix | language) x P(language | host). The last three
    come from the votes of the texts of all pages, by grouped counts: declared languages and suffixes with
    STRENGTH votes shared out evenly, and hosts by levels - all pages, domain, host - each smoothed with STRENGTH votes
    of the level above. A page's own vote is taken out of its domain's and host's.

    Pages without letters have no text evidence and cast no vote. Null url and html are empty, and count as a host and
    a declaration of their own; repeated rows get a row each; a null id stays null; other columns are not read.
    Without labelled documents there are no languages and lang is null.
    """
    languages, model = text_model(docs, documents)
    rows = pages.select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").alias("url"), F.col(f"`{html_column}`").alias("html"))
    signals = page_signals(rows, model)
    n = len(languages)
    if not n:
        return signals.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                              F.lit(None).cast("string").alias("text_lang"), "declared", "suffix", "host")
    names = F.lit(languages)
    everywhere = signals.groupBy("vote").agg(F.count(F.lit(1)).alias("n")).collect()
    votes = np.zeros(n)
    for r in everywhere:
        if r.vote is not None:
            votes[r.vote] = r.n
    whole, of_language = F.lit(((votes + 1) / (votes.sum() + n)).tolist()), F.lit(votes.tolist())
    for key in ("declared", "suffix", "domain", "host"):
        side = _votes(signals.select(key, "vote"), key, n)
        signals = signals.join(side, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    own = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.when(F.col("vote") == k, 1.0).otherwise(0.0))

    def level(votes: str, above: Column) -> Column:
        others = F.zip_with(votes, own, lambda v, o: v - o)
        return F.zip_with(others, above, lambda v, p: (v + F.lit(STRENGTH) * p) / (_total(others) + F.lit(STRENGTH)))

    def evidence(votes: str) -> Column:
        """log P(value | language), with a chance of 1 in the number of languages for what was never seen."""
        return F.zip_with(votes, of_language, lambda v, t: F.log((v + F.lit(STRENGTH / n)) / (t + F.lit(STRENGTH))))

    prior = level("host_votes", level("domain_votes", whole))
    fused = F.zip_with(F.zip_with("text", F.transform(prior, lambda x: F.log(x)), lambda a, b: a + b),
                       F.zip_with(evidence("declared_votes"), evidence("suffix_votes"), lambda a, b: a + b), lambda a, b: a + b)
    fused = signals.withColumn("_fused", fused).withColumn("_top", F.array_max("_fused"))
    return fused.select(
        "page_id", F.element_at(names, F.array_position("_fused", F.col("_top")).cast("int")).alias("lang"),
        (1 / _total(F.transform("_fused", lambda x: F.exp(x - F.col("_top"))))).alias("probability"),
        F.when(F.col("vote").isNotNull(), F.element_at(names, F.col("vote") + 1)).alias("text_lang"), "declared", "suffix", "host")


@query("op7_page_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
