"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.llm.common import fold, map_rows, stored, texts
from hourvault.llm.registry import query, table

#: Labelled examples in the index, chosen by a hash of their id; bounds index, driver and broadcast.
EXAMPLES = 8192
#: Terms besides whole words: the beginnings of longer words, of so many bytes. They join the forms of rare words.
BEGINNINGS = (4, 5, 6)
#: Terms in the index speak for the label: among the examples that hold one, label 1 is LIFT times as frequent as among
#: all, with a log-likelihood ratio of EVIDENT (p = 1e-4), and MOST_SHARE of all hold it at most.
LIFT, EVIDENT, MOST_SHARE = 2.0, 15.0, 0.3
TERMS = 1 << 17
NEIGHBOURS = 31
#: A neighbour at distance d (1 - cosine) votes with 1 / (SMOOTH + d): a single copy doesn't outvote the rest.
SMOOTH = 0.25
#: Where no term speaks for the label, examples of this cosine in all words are neighbours: copies and near copies.
NEAR = 0.5
#: Words of all examples (distinct in each): with more, fewer examples are taken. Bounds index, driver and broadcast in bytes.
EXAMPLE_WORDS = 4_000_000
#: With a floor, words of the longest lists are left out of the search as long as their part of the vector is no longer than
#: this share of the floor: by themselves they cannot reach it, and the other words must bring the rest.
COMMON_SHARE = 0.75
BLOCK = 64
FIRST_BLOCKS = 4
#: With so few postings in all lists of a text, all are scored: choosing blocks would cost more.
FEW_POSTINGS = 1 << 15
#: Share by which weights in 32 bits may fall short.
SLACK = 1e-5
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
EVIDENCE = 3

#: Lower-cases A-Z; other ASCII bytes than letters and digits become spaces.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

RESULT = ("doc_id bigint, held_out boolean, score double, predicted int, vote double, "
          "evidence array<struct<doc_id: bigint, toxic: int, cosine: double>>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def terms_of(word: bytes) -> list[bytes]:
    """A word and its beginnings, marked by a byte that no word holds."""
    return [word, *[word[:n] + b"*" for n in BEGINNINGS if len(word) > n]]


class TermNumbers(dict):
    """Numbers of the index terms of a word, kept for at most `limit` words at a time.

    Words that no term begins like are known by their first bytes and never kept: every term of a word shares them.
    """

    HEAD = min(BEGINNINGS)

    def __init__(self, terms: dict[bytes, int], limit: int = 200_000):
        super().__init__()
        self.terms, self.limit = terms, limit
        self.heads = {t[:self.HEAD] for t in terms}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = tuple(self.terms[t] for t in terms_of(word) if t in self.terms)
        return value

    def vector(self, words: list[bytes] | Counter[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the index terms of a text, in order, and their counts."""
        heads, head, counts = self.heads, self.HEAD, counter(words)
        found: dict[int, int] = {}
        for word in [w for w in counts if w[:head] in heads]:
            n = counts[word]
            for term in self[word]:
                found[term] = found.get(term, 0) + n
        terms = sorted(found)
        return np.array(terms, np.int64), np.array([found[t] for t in terms], np.int64)


@dataclass
class WordNumbers:
    """Numbers of words by their 64-bit hashes, which stand in order: no words are kept."""

    hashes: np.ndarray

    @cached_property
    def buckets(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Bits to drop from a hash for its bucket, the first number of each bucket, and the steps from it in the fullest."""
        bits = max(1, len(self.hashes).bit_length())
        sizes = np.bincount((self.hashes >> (64 - bits)) + (1 << bits - 1), minlength=1 << bits)
        return 64 - bits, (np.cumsum(sizes) - sizes).astype(np.int32), np.arange(sizes.max())

    def vector(self, words: list[bytes] | Counter[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        counts = counter(words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
        shift, first, steps = self.buckets
        begin = first[(hashes >> shift) + (len(first) >> 1)]
        same = self.hashes.take(begin[:, None] + steps, mode="clip") == hashes[:, None]
        known = same.any(axis=1)
        at = (begin + same.argmax(axis=1))[known]
        order = np.argsort(at)
        return at[order], np.fromiter(counts.values(), np.int64, len(counts))[known][order]


def counter(words: list[bytes] | Counter[bytes]) -> Counter[bytes]:
    return words if isinstance(words, Counter) else Counter(words)


def word_counts(words: list[bytes] | Counter[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words, in order, and their counts."""
    counts = counter(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
    order = np.argsort(hashes)
    return hashes[order], np.fromiter(counts.values(), np.int64, len(counts))[order]


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for size[0] numbers, then the same for the next."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


@dataclass
class Index:
    """Postings (example, weight) by term, and the same by example (term, weight)."""

    numbers: TermNumbers | WordNumbers
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    posting_of_term: np.ndarray  # first posting of each term
    example: np.ndarray  # of each posting
    weight: np.ndarray
    term_of_example: np.ndarray  # first term of each example
    term: np.ndarray
    term_weight: np.ndarray

    @staticmethod
    def of(terms: list[bytes], df: np.ndarray, ids: np.ndarray, toxic: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]]) -> Index:
        """vectors: for each example its term numbers, in order, and counts."""
        return Index.built(TermNumbers(dict(zip(terms, range(len(terms)), strict=True))), df, ids, toxic, vectors)

    @staticmethod
    def built(numbers: TermNumbers | WordNumbers, df: np.ndarray, ids: np.ndarray, toxic: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]]) -> Index:
        idf = np.log(max(1, len(ids)) / np.maximum(df, 1)) if len(df) else np.zeros(0)
        index = Index(numbers, idf, ids, toxic, *[np.zeros(1, np.int64)] * 6)
        index.term_weight = np.concatenate([index.weights(t, c) for t, c in vectors] or [np.zeros(0)]).astype(np.float32)
        index.term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int32)
        sizes = [len(t) for t, _ in vectors]
        index.term_of_example = np.cumsum([0, *sizes]).astype(np.int32)
        example = np.repeat(np.arange(len(vectors), dtype=np.int32), sizes)
        order = np.argsort(index.term, kind="stable")
        index.example, index.weight = example[order], index.term_weight[order]
        index.posting_of_term = np.searchsorted(index.term[order], np.arange(len(df) + 1)).astype(np.int32)
        return index

    @cached_property
    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries (one per term and block of examples): the first of each term, and of each its block, largest weight and first posting."""
        term = np.repeat(np.arange(len(self.posting_of_term) - 1), np.diff(self.posting_of_term))
        first = np.flatnonzero(np.diff(term * (len(self.ids) // BLOCK + 1) + self.example // BLOCK, prepend=-1))
        largest = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        return (np.searchsorted(term[first], np.arange(len(self.posting_of_term))).astype(np.int32), self.example[first] // BLOCK, largest,
                np.append(first, len(term)).astype(np.int32))

    def vector(self, words: list[bytes] | Counter[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.numbers.vector(words)

    def weights(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Unit vector of (1 + log count) * log(N / df)."""
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / max(np.linalg.norm(w), 1e-12)

    def scores(self, begin: np.ndarray, size: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sums by example over runs of postings, each with its weight in the text."""
        at = ragged(begin, size)
        return np.bincount(self.example[at], np.repeat(weight, size) * self.weight[at], len(self.ids))

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, leave_out: int = -1, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine over 0, and of `floor` at least, exactly; ties go to the first."""
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        weight = self.weights(terms, counts)
        begin = self.posting_of_term[terms]
        size = self.posting_of_term[terms + 1] - begin
        if floor:
            found, score = self.reaching(terms, begin, size, weight, floor)
        else:
            score = self.scores(begin, size, weight) if size.sum() <= FEW_POSTINGS else self.promising(terms, weight, k, leave_out)
            found = np.flatnonzero(score > 0)
            score = score[found]
        if leave_out >= 0:
            score, found = score[found != leave_out], found[found != leave_out]
        if len(found) > k:
            near = score >= np.partition(score, -k)[-k]
            found, score = found[near], score[near]
        order = np.argsort(-score, kind="stable")[:k]
        return found[order], np.minimum(score[order], 1.0)

    def reaching(self, terms: np.ndarray, begin: np.ndarray, size: np.ndarray, weight: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Examples of a cosine of `floor` at least, in order, and their cosines.

        What an example gains by some of the terms is at most the length of their part of the text's vector. So the
        terms of the longest lists, up to a length of COMMON_SHARE of the floor, bring no example to it alone: only those
        that the other terms bring near enough are scored in full.
        """
        long = np.argsort(-size, kind="stable")
        length = np.sqrt(np.cumsum(weight[long] ** 2))
        common = int(np.searchsorted(length, COMMON_SHARE * floor, side="right"))
        rest = np.ones(len(terms), bool)
        rest[long[:common]] = False
        score = self.scores(begin[rest], size[rest], weight[rest])
        least = floor * (1 - SLACK)
        near = np.flatnonzero(score >= least - SLACK - (length[common - 1] if common else 0.0))
        first = self.term_of_example[near]
        sizes = self.term_of_example[near + 1] - first
        if sizes.sum() > size.sum():  # many copies: their terms are more than the text's postings
            score = self.scores(begin, size, weight)[near]
        elif len(near):
            at = ragged(first, sizes)
            place = np.minimum(np.searchsorted(terms, self.term[at]), len(terms) - 1)
            value = np.where(terms[place] == self.term[at], weight[place] * self.term_weight[at], 0.0)
            score = np.bincount(np.repeat(np.arange(len(near)), sizes), value, len(near))
        else:
            score = np.zeros(0)
        return near[score >= least], score[score >= least]

    def promising(self, terms: np.ndarray, weight: np.ndarray, k: int, leave_out: int) -> np.ndarray:
        """Cosines of all examples that can be among the k nearest, 0 for others.

        The most that a block's examples can score is the sum of its entries' largest weights. The blocks that
        promise most are scored first; of the others, only those that promise as much as the k-th so far.
        """
        entry_of_term, block, largest, posting_of_entry = self.blocks
        size = entry_of_term[terms + 1] - entry_of_term[terms]
        entries, weight = ragged(entry_of_term[terms], size), np.repeat(weight, size)
        begin = posting_of_entry[entries]
        size, block = posting_of_entry[entries + 1] - begin, block[entries]
        promise = np.bincount(block, weight * largest[entries], len(self.ids) // BLOCK + 1)
        early = np.zeros(len(promise), bool)
        early[np.argsort(-promise, kind="stable")[:FIRST_BLOCKS]] = True
        chosen = early[block]
        score = self.scores(begin[chosen], size[chosen], weight[chosen])
        if leave_out >= 0:
            score[leave_out] = 0
        least = np.partition(score, -k)[-k] if len(score) >= k else 0.0
        chosen = (~early & (promise >= least * (1 - SLACK)) & (promise > 0))[block]
        return score + self.scores(begin[chosen], size[chosen], weight[chosen]) if chosen.any() else score

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        """Share of label 1 in the distance-weighted votes; that of all examples where nothing is near."""
        if not len(best):
            return float(self.toxic.mean()) if len(self.toxic) else 0.0
        w = 1 / (SMOOTH + 1 - cosine)
        return float((w * self.toxic[best]).sum() / w.sum())


EXAMPLE = "doc_id bigint, toxic int, terms array<binary>, counts array<int>, words array<bigint>, word_counts array<int>"


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing label shares by votes (pool adjacent violators, a count of 1/2 added on both sides)."""
    order = np.argsort(votes, kind="stable")
    blocks: list[list[float]] = []  # label sum, count, first vote
    for v, y in zip(votes[order].tolist(), labels[order].tolist(), strict=True):
        blocks.append([y, 1.0, v])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][2] == blocks[-1][2]):
            y1, n1, _ = blocks.pop()
            blocks[-1][0] += y1
            blocks[-1][1] += n1
    return np.array([b[2] for b in blocks]), np.array([(b[0] + 0.5) / (b[1] + 1) for b in blocks])


def likelihood_ratio(df: Column, toxic: Column, n: int, positive: int) -> Column:
    """Twice the log-likelihood ratio of a term and the label, from the four counts of examples."""
    def part(seen: Column, rows: Column, labelled: int) -> Column:
        return F.when(seen > 0, seen * F.ln(seen * F.lit(float(n)) / (rows * F.lit(float(labelled))))).otherwise(0.0)

    rest = F.lit(float(n)) - df
    return 2 * (part(toxic, df, positive) + part(df - toxic, df, n - positive)
                + part(positive - toxic, rest, positive) + part(rest - positive + toxic, rest, n - positive))


def fitted(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, example_words: int = EXAMPLE_WORDS):
    """Index of labelled examples, all their terms, and a calibration for each of the two, from training folds only.

    The sample is bounded by `examples` and chosen by a hash of the id, so both classes stand in it as they occur.
    Vectors hold the terms that speak for the label: nearness in the words of a topic or language says little about it.
    Texts without such a term, at a label share of a half or more all of them, are looked up by all words, for copies.
    Votes of the examples, each without itself, give the calibrations.
    """
    own = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT_FOLD))
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples))

    def counted(batch: pa.RecordBatch) -> dict:
        found, hashed = [], []
        for text in texts(batch, "text"):
            counts: Counter[bytes] = Counter()
            words = Counter(words_of(text))
            hashed.append(word_counts(words))
            for word, n in words.items():
                for term in terms_of(word):
                    counts[term] += n
            found.append(counts)
        return {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"),
                "terms": [list(c) for c in found], "counts": [list(c.values()) for c in found],
                "words": [h for h, _ in hashed], "word_counts": [c for _, c in hashed]}

    # Of several texts under one id the least is the example, so that runs agree.
    rows = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = stored(map_rows(rows.select("doc_id", "toxic", "text"), counted, EXAMPLE), "toxic-examples")
    drawn = sample.select(F.xxhash64("doc_id").alias("draw"), "doc_id", F.size("words").alias("n")).toArrow().sort_by([("draw", "ascending"), ("doc_id", "ascending")])
    if (pc.sum(drawn["n"]).as_py() or 0) > example_words:
        last = drawn.slice(max(0, int(np.searchsorted(np.cumsum(drawn["n"].to_numpy()), example_words, side="right")) - 1), 1).to_pylist()[0]
        sample = sample.filter((F.xxhash64("doc_id") < last["draw"]) | (F.xxhash64("doc_id") == last["draw"]) & (F.col("doc_id") <= last["doc_id"]))
    n, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = positive / n if n else 0.0
    seen = (sample.select("toxic", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).cast("double").alias("df"), F.sum("toxic").cast("double").alias("toxic")))
    telling = (seen.filter((F.col("df") <= MOST_SHARE * n) & (F.col("toxic") >= LIFT * share * F.col("df")) & (F.col("toxic") > 0))
               .withColumn("ratio", likelihood_ratio(F.col("df"), F.col("toxic"), n, positive))
               .filter(F.col("ratio") >= EVIDENT).orderBy(F.desc("ratio"), "term").limit(TERMS).collect())
    terms = [bytes(r.term) for r in telling]
    sent = docs.sparkSession.sparkContext.broadcast(dict(zip(terms, range(len(terms)), strict=True)))

    def numbered(batch: pa.RecordBatch, sent=sent) -> dict:
        known = sent.value
        pairs = [[(known[t], c) for t, c in zip(ts, cs, strict=True) if t in known]
                 for ts, cs in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True)]
        return {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "terms": [[t for t, _ in p] for p in pairs],
                "counts": [[c for _, c in p] for p in pairs]}

    vectors = map_rows(sample, numbered, "doc_id bigint, toxic int, terms array<int>, counts array<int>").toArrow().sort_by("doc_id")
    pairs = [(np.array(t, np.int64), np.array(c, np.int64))
             for t, c in zip(vectors["terms"].to_pylist(), vectors["counts"].to_pylist(), strict=True)]
    ids, toxic = np.array(vectors["doc_id"].to_pylist(), np.int64), np.array(vectors["toxic"].to_pylist(), np.int64)
    index = Index.of(terms, np.array([r.df for r in telling], np.float64), ids, toxic, pairs)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    whole = sample.select("doc_id", "words", "word_counts").toArrow().sort_by("doc_id").combine_chunks()
    hashes, number, df = np.unique(pc.list_flatten(whole["words"]).to_numpy(), return_inverse=True, return_counts=True)
    ends = np.cumsum(pc.list_value_length(whole["words"]).to_numpy())[:-1]
    every = [(t, c) for t, c in zip(np.split(number, ends), np.split(pc.list_flatten(whole["word_counts"]).to_numpy(), ends), strict=True)] if len(ids) else []
    shared_all = docs.sparkSession.sparkContext.broadcast(Index.built(WordNumbers(hashes), df.astype(np.float64), ids, toxic, every))
    del whole, every

    def own_votes(batch: pa.RecordBatch) -> dict:
        model, other = shared.value, shared_all.value
        ids = batch.column("doc_id").to_pylist()
        at = np.searchsorted(model.ids, ids).tolist()
        votes: list[float] = []
        told = []
        for k, ts, cs, hs, ns in zip(at, *(batch.column(c).to_pylist() for c in ("terms", "counts", "words", "word_counts")), strict=True):
            known = [(model.numbers.terms[t], c) for t, c in zip(ts, cs, strict=True) if t in model.numbers.terms]
            told.append(bool(known))
            if known:
                t, c = np.array(sorted(known), np.int64).reshape(-1, 2).T
                votes.append(model.vote(*model.nearest(t, c, NEIGHBOURS, leave_out=k)))
            else:
                terms = np.searchsorted(other.numbers.hashes, np.array(hs, np.int64))
                votes.append(other.vote(*other.nearest(terms, np.array(ns, np.int64), NEIGHBOURS, leave_out=k, floor=NEAR)))
        return {"doc_id": ids, "vote": votes, "toxic": batch.column("toxic"), "told": told}

    votes = map_rows(sample, own_votes, "doc_id bigint, vote double, toxic int, told boolean").toArrow().sort_by("doc_id")
    vote, label, told = votes["vote"].to_numpy(), votes["toxic"].to_numpy().astype(np.float64), votes["told"].to_numpy().astype(bool)
    return shared, shared_all, [isotonic(vote[told == t], label[told == t]) for t in (False, True)]


def toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Calibrated toxicity of each document, with its nearest labelled examples.

    Only the text enters a score. Rows whose crc32(doc_id) modulo 4 is 2 teach nothing (held_out). Texts without a
    telling term are looked up by all their words, for examples of a cosine of NEAR at least, and calibrated on the
    examples without such a term; null and empty texts have no neighbours. Without any labelled example every score is
    0. Of several texts under one labelled id the least is the example; repeated rows are scored alike; a null id is
    folded like the empty text; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    shared, shared_all, steps = fitted(rows, labels, examples)

    def run(batch: pa.RecordBatch) -> dict:
        model, other = shared.value, shared_all.value
        found: list = []
        for text in texts(batch, "text"):
            words = Counter(words_of(text))
            terms, counts = model.vector(words)
            told = bool(len(terms)) or not len(model.ids)
            best, cosine = model.nearest(terms, counts, NEIGHBOURS) if told else other.nearest(*other.vector(words), NEIGHBOURS, floor=NEAR)
            found.append(((model if told else other).vote(best, cosine), best, cosine, told))
        out: dict[str, list] = {"score": [], "predicted": [], "vote": [], "evidence": []}
        for vote, best, cosine, told in found:
            votes, shares = steps[told]
            score = float(shares[max(0, np.searchsorted(votes, vote, side="right") - 1)]) if len(votes) else 0.0
            out["vote"].append(vote)
            out["score"].append(score)
            out["predicted"].append(int(score >= THRESHOLD))
            out["evidence"].append([{"doc_id": int(model.ids[b]), "toxic": int(model.toxic[b]), "cosine": float(c)}
                                    for b, c in zip(best[:EVIDENCE], cosine[:EVIDENCE], strict=True)])
        return out | {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out")}

    return map_rows(rows.withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT_FOLD), run, RESULT)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
