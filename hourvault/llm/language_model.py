"""Scores of texts by a log-bilinear neural model, trained with noise-contrastive estimation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourvault.llm.common import WordHashes, arrow_schema, fold, map_rows, slices, stored, texts
from hourvault.llm.registry import query, table

FOLDS, HELD_OUT_FOLD = 7, 2
#: Words with a vector of their own; all others share one output, split by their counts.
SHORTLIST = 511
DIMENSIONS = 16
#: Words whose counts are sent to every task; counts of rarer ones are joined.
HEAD = 1 << 16
NOISE = 24
BATCH = 4096
STEP = 0.1
ROUNDS = 2
#: Training tokens of a shard, which one trainer works through: the number of shards follows the tokens, not the cluster.
SHARD_TOKENS = 1_000_000
#: Tokens that a task counts before it passes the counts on, and that it works on at a time.
COUNTED = 2_000_000
AT_ONCE = 300_000
#: The end of a text is a token that no word can equal.
END = b" "

TOKENS = ("rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_head bigint, known bigint, head_log double, other_log double, n_other bigint, "
          "ids binary, word bigint, tf bigint")
RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def token_hashes(text: bytes, hashes: WordHashes) -> np.ndarray:
    return hashes.of([*text.lower().split(), END])


def word_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each token (by its 64-bit hash) in the training documents, over all of them."""
    hashes = WordHashes()

    def over(batches):
        waiting, size = [], 0

        def packed():
            words, at = np.unique(np.concatenate(waiting), return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(np.bincount(at).astype(np.int64))], names=["word", "n"])

        for batch in batches:
            for text in texts(batch, "text"):
                waiting.append(token_hashes(text, hashes))
                size += len(waiting[-1])
                if size >= COUNTED:
                    yield packed()
                    waiting, size = [], 0
        if waiting:
            yield packed()

    partial = docs.filter("NOT held_out").select("text").mapInArrow(over, "word bigint, n bigint")
    return stored(partial.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


@dataclass
class Vocabulary:
    """Counts of the most frequent tokens, sorted by hash; the first of them by count make the shortlist."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray  # 1.. for the shortlist, 0 for others
    tokens: int
    distinct: int

    @staticmethod
    def of(words: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, shortlist: int) -> Vocabulary:
        """words and counts by falling count."""
        classes = np.where(np.arange(len(words)) < shortlist, np.arange(len(words)) + 1, 0)
        order = np.argsort(words)
        return Vocabulary(words[order], counts[order], classes[order], tokens, distinct)

    @property
    def class_counts(self) -> np.ndarray:
        own = np.bincount(self.classes, self.counts, max(1, self.classes.max(initial=0) + 1))
        own[0] = self.tokens - own[1:].sum()
        return own

    @property
    def base_log(self) -> float:
        return float(np.log10(self.tokens + self.distinct + 1))

    @property
    def rest_log(self) -> float:
        """Of the others' total: tokens and words outside the shortlist, and one for words never seen."""
        counts = self.class_counts
        return float(np.log10(counts[0] + self.distinct - (len(counts) - 1) + 1))

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, whether the token is in the head, and its count there."""
        if not len(self.words):
            zero = np.zeros(len(tokens), np.int64)
            return zero, zero.astype(bool), zero
        at = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        there = self.words[at] == tokens
        return np.where(there, self.classes[at], 0), there, np.where(there, self.counts[at], 0)


class LogBilinear:
    """P(next | two tokens before): predicted vector = sum of context vectors, each scaled by its place; dot products
    with output vectors and biases, normalised over all classes.
    """

    def __init__(self, classes: int, dimensions: int = DIMENSIONS, seed: int = 7):
        random = np.random.default_rng(seed)
        self.context = random.normal(0, 0.1, (classes + 1, dimensions)).astype(np.float32)  # the last is a text's start
        self.output = random.normal(0, 0.1, (classes, dimensions)).astype(np.float32)
        self.place = np.ones((2, dimensions), np.float32) * np.array([[0.7], [0.4]], np.float32)
        self.bias = np.zeros(classes, np.float32)

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.context[one] * self.place[0] + self.context[two] * self.place[1]

    def log_probabilities(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised natural logs of all classes for each context: one matrix product."""
        scores = self.predicted(one, two) @ self.output.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))

    def rows(self) -> np.ndarray:
        """All parameters as rows of one width."""
        bias = np.zeros((len(self.bias), self.output.shape[1]), np.float32)
        bias[:, 0] = self.bias
        return np.concatenate([self.context, self.output, self.place, bias])

    def load(self, rows: np.ndarray) -> LogBilinear:
        classes = len(self.bias)
        self.context, self.output, self.place, bias = (x.astype(np.float32) for x in np.split(rows, np.cumsum([classes + 1, classes, 2])))
        self.bias = bias[:, 0]
        return self


def contexts(sequences: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every token with the one and the two before it; `start` stands before a text."""
    token = np.concatenate(sequences).astype(np.int64)
    begin = np.cumsum([0] + [len(s) for s in sequences[:-1]])
    one = np.concatenate([[start], token[:-1]])
    one[begin] = start
    two = np.concatenate([[start], one[:-1]])
    two[begin] = start
    return token, one, two


def _sums(which: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(which, column, n) for column in values.T], axis=1)


class Trainer:
    """Noise-contrastive estimation with Adagrad: a batch shares its noise samples, so that all scores are matrix products."""

    def __init__(self, model: LogBilinear, noise: np.ndarray, seed: int):
        self.model, self.noise, self.random = model, noise, np.random.default_rng(seed)
        self.cumulative = np.cumsum(noise)
        self.log_noise = np.log(NOISE * noise).astype(np.float32)
        self.seen = 0
        self.square = {n: np.full(getattr(model, n).shape, 1e-2) for n in ("context", "output", "place", "bias")}

    def step(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m = self.model
        classes = len(m.bias)
        false = np.minimum(np.searchsorted(self.cumulative, self.random.random(NOISE)), classes - 1)
        h = m.predicted(one, two)
        target = m.output[token]
        right = (h * target).sum(axis=1) + m.bias[token] - self.log_noise[token]
        wrong = h @ m.output[false].T + m.bias[false] - self.log_noise[false]
        up = 1 / (1 + np.exp(np.clip(right, -30, 30)))
        down = 1 / (1 + np.exp(-np.clip(wrong, -30, 30)))
        dh = up[:, None] * target - down @ m.output[false]
        output = _sums(token, up[:, None] * h, classes) + _sums(false, -(down.T @ h), classes)
        bias = np.bincount(token, up, classes) - np.bincount(false, down.sum(axis=0), classes)
        context = _sums(one, dh * m.place[0], classes + 1) + _sums(two, dh * m.place[1], classes + 1)
        place = np.stack([(dh * m.context[one]).sum(axis=0), (dh * m.context[two]).sum(axis=0)])
        for name, gradient in (("context", context), ("output", output), ("place", place), ("bias", bias)):
            gradient /= len(token)
            self.square[name] += gradient * gradient
            value = getattr(m, name)
            value += (STEP * gradient / np.sqrt(self.square[name])).astype(np.float32)
        self.seen += len(token)

    def learn(self, sequences: list[np.ndarray]) -> None:
        token, one, two = contexts(sequences, len(self.model.bias))
        order = self.random.permutation(len(token))
        for k in range(0, len(order), BATCH):
            part = order[k:k + BATCH]
            self.step(token[part], one[part], two[part])


def trained(rows: DataFrame, vocabulary, classes: int) -> LogBilinear:
    """Training over all training documents: each shard trains on its own, and parameters are averaged between rounds.

    A round takes its share of the documents; these are dealt over shards of about SHARD_TOKENS tokens, and go through
    a shard in order, by hashes of id and tokens. Chance is drawn from the shard's number, so scores don't depend on
    how rows are spread over tasks. Averages are grouped sums over the parameters' rows, so what reaches the driver
    doesn't grow with shards or documents.
    """
    counts = vocabulary.value.class_counts
    model = LogBilinear(classes)
    noise = (counts + 1) / (counts + 1).sum()
    model.bias = np.log(noise).astype(np.float32)
    names = [f"x{k}" for k in range(DIMENSIONS)]
    fields = "row int, weight double, " + ", ".join(f"{n} double" for n in names)
    learning = rows.filter(F.col("ids").isNotNull() & ~F.col("held_out")).withColumn("deal", F.xxhash64("doc_id", "ids"))
    shards = max(1, -(-vocabulary.value.tokens // (ROUNDS * SHARD_TOKENS)))
    for turn in range(ROUNDS):
        sent = rows.sparkSession.sparkContext.broadcast(model.rows())

        def over(batches, turn=turn, sent=sent):
            def averaged(trainer: Trainer) -> pa.RecordBatch:
                values = trainer.model.rows().astype(np.float64)
                weight = np.full(len(values), float(trainer.seen))
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(weight), *[pa.array(c * weight) for c in values.T]],
                    names=["row", "weight", *names])

            shard, trainer, waiting, size = None, None, [], 0
            for batch in batches:
                for number, x in zip(batch.column("shard").to_pylist(), batch.column("ids").cast(pa.large_binary()).to_pylist(), strict=True):
                    if number != shard or size >= AT_ONCE:
                        if waiting:
                            trainer.learn(waiting)
                        if number != shard:
                            if trainer is not None:
                                yield averaged(trainer)
                            shard, trainer = number, Trainer(LogBilinear(classes).load(sent.value.copy()), noise, (1 << 20) * turn + number)
                        waiting, size = [], 0
                    waiting.append(np.frombuffer(x, np.uint16))
                    size += len(waiting[-1])
            if waiting:
                trainer.learn(waiting)
            if trainer is not None:
                yield averaged(trainer)

        own = learning.filter(F.pmod("deal", F.lit(ROUNDS)) == turn).select(
            F.pmod(F.floor(F.col("deal") / ROUNDS), F.lit(shards)).cast("int").alias("shard"), "deal", "ids")
        own = own.repartition(shards, "shard").sortWithinPartitions("shard", "deal", "ids").select("shard", "ids")
        sums = own.mapInArrow(over, fields).groupBy("row").agg(*[F.sum(n).alias(n) for n in ["weight", *names]]).toArrow().sort_by("row")
        if sums.num_rows:
            weight = sums["weight"].to_numpy()
            model.load(np.stack([sums[n].to_numpy() / weight for n in names], axis=1))
    return model


def _byte_slices(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Rows of a batch of texts by about AT_ONCE tokens."""
    return slices(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 6 + 1, AT_ONCE)


def numbered_tokens(docs: DataFrame, vocabulary) -> DataFrame:
    """One row for each document with its classes and sums over head tokens, and one for each of its rarer words."""
    hashes = WordHashes()

    def over(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in (b.slice(low, high - low) for b in batches for low, high in _byte_slices(b)):
            v: Vocabulary = vocabulary.value
            tokens = [token_hashes(t, hashes) for t in texts(batch, "text")]
            sizes = np.array([len(t) for t in tokens], np.int64)
            n = len(sizes)
            flat = np.concatenate(tokens)
            doc = np.repeat(np.arange(n), sizes)
            classes, head, count = v.find(flat)
            log = np.log10(count + 1.0)
            other = classes == 0
            rids = rid + np.arange(n)
            rid += n
            ids = [x.tobytes() for x in np.split(classes.astype(np.uint16), np.cumsum(sizes)[:-1])]
            doc_rows = {"rid": rids, "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": sizes,
                        "n_head": np.bincount(doc, head, n).astype(np.int64), "known": np.bincount(doc, head & (count > 0), n).astype(np.int64),
                        "head_log": np.bincount(doc, np.where(head, log, 0), n), "other_log": np.bincount(doc, np.where(head & other, log, 0), n),
                        "n_other": np.bincount(doc, other, n).astype(np.int64), "ids": ids, "word": pa.nulls(n, pa.int64()), "tf": pa.nulls(n, pa.int64())}
            yield doc_rows
            tail = ~head
            if tail.any():
                order = np.lexsort((flat[tail], doc[tail]))
                w, d = flat[tail][order], doc[tail][order]
                first = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (d[1:] != d[:-1])]))
                m = len(first)
                empty = {c: pa.nulls(m, t) for c, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_head", pa.int64()),
                                                        ("known", pa.int64()), ("head_log", pa.float64()), ("other_log", pa.float64()),
                                                        ("n_other", pa.int64()), ("ids", pa.binary()))}
                yield empty | {"rid": rids[d[first]], "word": w[first].view(np.int64), "tf": np.diff(np.append(first, len(w)))}

    schema = T._parse_datatype_string(TOKENS)
    fields = arrow_schema(schema)

    def batches_of(batches):
        for out in over(batches):
            yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                                              for f in fields], schema=fields)

    return stored(docs.mapInArrow(batches_of, schema), "lm-tokens")


def language_scores(docs: DataFrame, shortlist: int = SHORTLIST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """log10 probability of each text by the model, beside that of single-word counts with one added.

    The model learns from rows whose crc32(doc_id) modulo 7 is not 2. The next token is a word of the shortlist, the
    end, or another word, by the log-bilinear model from the two tokens before; another word is told apart by its
    count plus one, with one for words never seen. Counts cover all training documents.

    Null and empty texts are the end token alone; repeated rows are scored each; a null id is folded like the empty
    text; other columns are not read; without training documents every count is 0.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    rows = rows.withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT_FOLD)
    counts = word_counts(rows)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary.of(
        head["word"].to_numpy().view(np.uint64), head["n"].to_numpy(), int(total.n), int(total.v), shortlist))
    tokens = numbered_tokens(rows, sent)
    classes = len(sent.value.class_counts)
    model = docs.sparkSession.sparkContext.broadcast(trained(tokens, sent, classes))
    # A rarer word has at most 1/HEAD of all tokens: no key of this join is hot.
    tail = (tokens.filter("word IS NOT NULL").select("rid", "word", "tf").join(counts, "word", "left")
            .groupBy("rid").agg(F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("tail_log"),
                                F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("tail_known")))
    whole = (tokens.filter("ids IS NOT NULL").drop("word", "tf").join(tail, "rid", "left")
             .fillna({"tail_log": 0.0, "tail_known": 0}))

    def text_logs(m: LogBilinear, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of the classes of each text."""
        start = len(m.bias)
        token, one, two = contexts(sequences, start)
        pairs, at = np.unique(one * (start + 1) + two, return_inverse=True)
        # Tokens by context: all classes of a block of contexts come from one product.
        order = np.argsort(at, kind="stable")
        bounds = np.searchsorted(at[order], np.arange(0, len(pairs) + BATCH, BATCH))
        log = np.zeros(len(token))
        for k, low in enumerate(range(0, len(pairs), BATCH)):
            block = pairs[low:low + BATCH]
            own = order[bounds[k]:bounds[k + 1]]
            log[own] = m.log_probabilities(block // (start + 1), block % (start + 1))[at[own] - low, token[own]]
        return np.bincount(np.repeat(np.arange(len(sequences)), [len(s) for s in sequences]), log, len(sequences))

    def run(batch: pa.RecordBatch) -> dict:
        v: Vocabulary = sent.value
        sequences = [np.frombuffer(x, np.uint16) for x in batch.column("ids").cast(pa.large_binary()).to_pylist()]
        parts = slices(np.array([len(s) for s in sequences]), AT_ONCE)
        log = np.concatenate([text_logs(model.value, sequences[low:high]) for low, high in parts])
        number = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        n, tail_log = number("n_tokens"), number("tail_log")
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": n,
                "n_known": number("known") + number("tail_known"), "train_tokens": np.full(len(n), v.tokens),
                "base_score": number("head_log") + tail_log - n * v.base_log,
                "score": log / np.log(10) + number("other_log") + tail_log - number("n_other") * v.rest_log}

    return map_rows(whole, run, RESULT)


@query("op3_log_bilinear")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
