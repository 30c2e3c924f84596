"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) P(word | class, before). The most frequent words form classes of equal number; all
others form tiers, each a class with a binary tree in which a word is a path of choices between two sides. Without
weights each choice has the share of its words' counts; weights of contexts move it. Words under a tiny share of all tokens
are too many to send to all machines: they are dealt by hash to the leaves of a tree of their own, and in its leaf a word
has its smoothed share of the leaf's counts. The features of what is before
are the last word, the last two (an n-gram) and the one before the last (a skip), hashed into buckets whose number grows with
the corpus, with one weight for each class, with the class for each of its words, and with a branching one for its side. Training is distributed and goes in
synchronous rounds, each over another part of the texts: every shard of the corpus makes AdaGrad updates in mini-batches from the weights
that the round before left, and the shards' weights are averaged, each bucket by those that saw it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.tables import bounded, crc32_mod, slices, written
from chatloom.llm.textbytes import Words, mix, seeded, texts_of, words

_U = np.uint64
END = int(seeded(1, 9)[0])  #: the hash of the end token
_SALT = seeded(16, 8)
SMOOTHING = 0.1
#: Words with at least this share of all tokens are in the model, and are sent to all machines with their counts.
COMMON = 2.0**-22
#: Levels of the tree of the other words at most.
REST_DEPTH = 4
#: Tokens from which buckets grow, and how many times their number doubles at most.
GROWS_FROM, DOUBLINGS = 1 << 24, 4
#: Tokens from which shards grow.
SHARDS_FROM = 1 << 26
_NONE = np.float32(-1e9)
#: Bytes of texts that make mini-batches together.
BLOCK_BYTES = 1 << 20
#: Tokens that are worked on at once.
PIECE = 1 << 13
#: Of AdaGrad's sums before any update.
FIRST_SUM = np.float32(1e-4)


@dataclass(frozen=True)
class Shape:
    """Size of the model at least; the vocabulary's trees and the buckets grow with the corpus."""

    classes: int = 16
    words: int = 32  #: of each class
    width: int = 16  #: how many times a tier has the words of the one before
    bits: int = 14  #: buckets of the class features
    word_bits: int = 14  #: buckets of the word features
    tree_bits: int = 18  #: buckets of the features of branchings
    rate: float = 0.3
    batch: int = 65536
    shards: int = 16  #: of a small corpus at most; they grow with the square root of a larger one
    rounds: int = 2  #: averages, each after a part of the texts
    block: int = 1 << 15  #: weights that are averaged together, about

    def grown(self, tokens: int) -> Shape:
        """With buckets and shards by the square root of the tokens: each shard sends its weights, so what is sent stays a share of the corpus."""
        times = max(1.0, tokens / GROWS_FROM) ** 0.5
        more = min(DOUBLINGS, round(np.log2(times)))
        shards = round(self.shards * max(1.0, tokens / SHARDS_FROM) ** 0.5)
        return replace(self, bits=self.bits + more, word_bits=self.word_bits + more, tree_bits=self.tree_bits + more, shards=shards)


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with an end token after each, and where each text's begin."""
    n_texts = w.last - w.first
    begin = w.word_at + np.arange(n_texts + 1)
    out = np.full(len(w.hash) + n_texts, END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[begin[1:] - 1] = False
    out[keep] = w.hash
    return out, begin


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (a hash), n: of all tokens of all rows, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, small=False):
            found = [tokens(w)[0] for w in words(texts_of(batch), most=BLOCK_BYTES)]
            if found:
                word, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def log_shares(counts: np.ndarray) -> np.ndarray:
    """Log of each count's share of its row, for rows that have any."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(counts > 0, np.log(counts / counts.sum(axis=-1, keepdims=True)), _NONE).astype(np.float32)


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log of the odds of the second of two counts, of which the first isn't 0."""
    with np.errstate(divide="ignore"):
        return np.where(counts[:, 1] > 0, np.log(counts[:, 1] / counts[:, 0]), _NONE).astype(np.float32)


def rest_depth(leaves: int, width: int) -> int:
    """Levels of a tree of so many leaves."""
    depth = 0
    while width**depth < leaves:
        depth += 1
    return depth


def leaf_of(hashes: np.ndarray, leaves: int) -> np.ndarray:
    """The leaf of a word outside the vocabulary: the first bits of its hash. leaves is a power of 2."""
    bits = leaves.bit_length() - 1
    return (hashes >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def rest_leaves(rare: DataFrame, distinct: int, shape: Shape) -> np.ndarray:
    """Smoothed counts of the leaves of so many words: about as many leaves, a power of the tree's width."""
    leaves = shape.width ** min(REST_DEPTH, max(0, rest_depth(distinct, shape.width) - 1))
    bits = leaves.bit_length() - 1
    leaf = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")
    found = rare.groupBy(leaf.alias("leaf")).agg((F.sum("n") + SMOOTHING * F.count(F.lit(1))).alias("n")).toPandas()
    out = np.full(leaves, SMOOTHING)
    out[found["leaf"].to_numpy(np.int64)] += found["n"].to_numpy(np.float64)
    return out


class Vocabulary:
    """Classes, trees and words of the model with their counts, and the shares that they have without weights."""

    def __init__(self, word: np.ndarray, n: np.ndarray, total: int, distinct: int, shape: Shape, leaves: np.ndarray | None = None):
        s = self.shape = shape
        order = np.lexsort((word, -n))
        sort = np.argsort(word[order])
        self.known, self.count, self.id = word[order][sort], n[order][sort], sort.astype(np.int32)
        # Hashes are even: the first bits give a few neighbours in known.
        self.bits = (2 * len(word)).bit_length()
        edges = np.searchsorted(self.known, np.arange(1 << self.bits, dtype=np.uint64) << _U(64 - self.bits)) if self.bits else [0]
        self.slots = np.append(edges, len(word)).astype(np.int32)
        self.rest_total, self.rest_distinct = total - int(n.sum()), distinct - len(n)
        ranked = n[order].astype(np.float64)
        flat = np.zeros((s.classes, s.words))
        at = min(len(ranked), flat.size)
        flat.flat[:at] = ranked[:at]
        self.words = log_shares(flat)
        by_class = list(flat.sum(axis=1))
        #: Of each tier: its first word, and the first branching of each level.
        self.tiers: list[tuple[int, list[int]]] = []
        #: Counts of the leaves of the other words, smoothed.
        self.leaves = np.array([self.rest_total + SMOOTHING * (self.rest_distinct + 1)]) if leaves is None else leaves
        odds, nodes, most, end = [np.zeros(0, np.float32)], 0, s.width**2, len(ranked)
        ranked = np.concatenate([ranked, self.leaves])
        while at < len(ranked):
            # The last tier is the leaves.
            mine = ranked[at : min(at + most, end)] if at < end else self.leaves
            by_class.append(mine.sum())
            levels, below = [], mine
            while len(below) > 1:
                below = np.append(below, np.zeros(len(below) % 2)).reshape(-1, 2)
                levels.append(log_odds(below))
                below = below.sum(axis=1)
            first = []
            for level in reversed(levels):
                first.append(nodes)
                odds.append(level)
                nodes += len(level)
            self.tiers.append((at, first))
            at, most = at + len(mine), most * s.width
        self.odds = np.concatenate(odds)
        self.classes = log_shares(np.array(by_class))
        self.first = np.array([t[0] for t in self.tiers[:-1]], np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """A word's place in known, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        slot = (hashes >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        at, end = self.slots.take(slot), self.slots.take(slot + 1)
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            found = self.known.take(at) == hashes[left]
            out[left[found]] = at[found]
            more = ~found & (at + 1 < end)
            left, at, end = left[more], at[more] + 1, end[more]
        return out

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """A word's number in the model by frequency; of other words -1 less the leaf."""
        at = self.find(hashes)
        out = -1 - leaf_of(hashes, len(self.leaves))
        out[at >= 0] = self.id[at[at >= 0]]
        return out

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        s = self.shape
        tier = s.classes - 1 + np.searchsorted(self.first, ids, side="right")
        return np.where(ids < 0, len(self.classes) - 1, np.where(ids < s.classes * s.words, ids // s.words, tier))

    def choices(self, ids: np.ndarray, cls: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each tier: its tokens, the branching of each on each level (a row), and whether the second side was taken."""
        for k, (begin, first) in enumerate(self.tiers):
            at = np.flatnonzero(cls == self.shape.classes + k)
            if len(at) and first:
                place = np.where(ids[at] < 0, -1 - ids[at], ids[at] - begin)
                path = place >> np.arange(len(first))[::-1, None]
                yield at, (path >> 1) + np.array(first)[:, None], (path & 1).astype(bool)


def contexts(token: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Three hashes for each token: of the word before, of the two before, and of the one before the last. Texts start after two ends."""
    end = _U(END)
    one = np.concatenate([[end], token[:-1]]) if len(token) else token
    one[begin[:-1]] = end
    two = np.concatenate([[end], one[:-1]]) if len(token) else token
    two[begin[:-1]] = end
    return np.stack([mix(one * _SALT[0]), mix(one * _SALT[1] + two * _SALT[2]), mix(two * _SALT[3])])


class Model:
    """Weights: class_w[bucket, class], word_w[bucket, place in its class] and tree_w[bucket] of the second side of a branching."""

    def __init__(self, v: Vocabulary, learned: Model | None = None):
        s = v.shape
        self.v, self.s = v, s
        if learned:
            self.class_w, self.word_w, self.tree_w = learned.class_w, learned.word_w, learned.tree_w
            return
        # Each bank of features has buckets of its own; the last row of class_w is the bias.
        self.class_w = np.zeros((3 * (1 << s.bits) + 1, len(v.classes)), np.float32)
        self.word_w = np.zeros((3 * (1 << s.word_bits) + s.classes, s.words), np.float32)
        self.tree_w = np.zeros(3 * (1 << s.tree_bits), np.float32)

    def class_rows(self, context: np.ndarray) -> list[np.ndarray]:
        """Rows of each feature's bucket by token; one row alone is that of all tokens."""
        rows = (context >> _U(64 - self.s.bits)).astype(np.int64) + (np.arange(3) << self.s.bits)[:, None]
        return [*rows, np.array([len(self.class_w) - 1])]

    def word_rows(self, context: np.ndarray, cls: np.ndarray) -> np.ndarray:
        rows = (mix(context + cls.astype(np.uint64) * _SALT[5]) >> _U(64 - self.s.word_bits)).astype(np.int64) + (np.arange(3) << self.s.word_bits)[:, None]
        return np.concatenate([rows, (3 << self.s.word_bits) + cls[None, :]])

    def tree_rows(self, context: np.ndarray, node: np.ndarray) -> np.ndarray:
        # Contexts are mixed already: the upper bits of a product are enough.
        salted = node.astype(np.uint64) * _SALT[6]
        rows = np.empty((3, *node.shape), np.uint64)
        for k, x in enumerate(context):
            np.bitwise_xor(salted, x, out=rows[k])
            rows[k] *= _SALT[7]
            rows[k] >>= _U(64 - self.s.tree_bits)
            rows[k] += _U(k << self.s.tree_bits)
        return rows.view(np.int64)

    @staticmethod
    def _odds(weights: np.ndarray, rows: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """exp of base plus weights, and its sums."""
        logit = weights.take(rows[0], axis=0)
        for r in rows[1:]:
            logit += weights.take(r, axis=0)
        logit += base
        np.minimum(logit, np.float32(60), out=logit)
        np.exp(logit, out=logit)
        return logit, np.maximum(logit @ np.ones(logit.shape[1], np.float32), np.float32(1e-37))

    @staticmethod
    def _logit(weights: np.ndarray, rows: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Log odds of the second side."""
        logit = base + weights.take(rows[0])
        for r in rows[1:]:
            logit += weights.take(r)
        return logit

    def _log(self, weights: np.ndarray, rows: np.ndarray, base: np.ndarray, target: np.ndarray) -> np.ndarray:
        if weights.ndim == 1:
            against = self._logit(weights, rows, base)
            np.negative(against, out=against, where=target)
            np.minimum(against, np.float32(60), out=against)
            np.exp(against, out=against)
            against += 1
            return -np.log(against).sum(axis=0)
        odds, total = self._odds(weights, rows, base)
        return np.log(np.maximum(odds[np.arange(len(target)), target], np.float32(1e-37)) / total)

    def _parts(self, token: np.ndarray, begin: np.ndarray, ids: np.ndarray, size: int) -> Iterator[tuple]:
        """All choices of all tokens in batches: a name of the weights, tokens, rows, shares or odds without weights, and what was chosen."""
        context, cls = contexts(token, begin), self.v.class_of(ids)
        for i in range(0, len(token), size):
            c, x, mine = cls[i : i + size], context[:, i : i + size], ids[i : i + size]
            yield "class", slice(i, i + len(c)), self.class_rows(x), self.v.classes, c
            at = np.flatnonzero(c < self.s.classes)
            if len(at):
                yield "word", i + at, self.word_rows(x[:, at], c[at]), self.v.words[c[at]], mine[at] % self.s.words
            for at, node, side in self.v.choices(mine, c):
                yield "tree", i + at, self.tree_rows(x.take(at, axis=1), node), self.v.odds.take(node), side

    def log_probability(self, token: np.ndarray, begin: np.ndarray, ids: np.ndarray | None = None) -> np.ndarray:
        """Natural log of each token's model probability; of words outside the vocabulary that of their leaf only."""
        out = np.zeros(len(token))
        # Smaller batches than in training: the arrays stay in the processor's cache.
        for which, at, rows, base, target in self._parts(token, begin, self.v.ids(token) if ids is None else ids, self.s.batch // 4):
            out[at] += self._log(getattr(self, f"{which}_w"), rows, base, target)
        return out


class Trainer(Model):
    """A model with AdaGrad sums; each update is one mini-batch. start: where an earlier round ended."""

    def __init__(self, v: Vocabulary, start: Trainer | None = None):
        super().__init__(v)
        self.class_g, self.word_g, self.tree_g = (np.full(len(w), FIRST_SUM, np.float32) for w in (self.class_w, self.word_w, self.tree_w))
        for name in [f"{which}_{x}" for which in ("class", "word", "tree") for x in "wg"] if start else ():
            setattr(self, name, getattr(start, name).copy())

    def _errors(self, weights: np.ndarray, rows: np.ndarray, base: np.ndarray, target: np.ndarray) -> np.ndarray:
        """What the probability of each outcome (of the second side, in trees) is above what came, a row for each outcome."""
        if weights.ndim == 1:
            error = self._logit(weights, rows, base)
            np.negative(error, out=error)
            np.minimum(error, np.float32(60), out=error)
            np.exp(error, out=error)
            error += 1
            np.reciprocal(error, out=error)
            error -= target
            return error.reshape(1, -1)
        out = np.empty((weights.shape[1], len(target)))
        # In pieces that stay in the processor's cache.
        for i in range(0, len(target), PIECE):
            mine = slice(i, i + PIECE)
            error, total = self._odds(weights, [r[mine] if len(r) > 1 else r for r in rows], base[mine] if base.ndim > 1 else base)
            error /= total[:, None]
            error[np.arange(len(error)), target[mine]] -= 1
            out[:, mine] = error.T
        return out

    def _step(self, weights: np.ndarray, sums: np.ndarray, rows: list[np.ndarray], errors: np.ndarray) -> None:
        for r in rows:
            # Sums by bucket are counted, without a sort.
            first = r.min()
            place = r - first
            count = np.bincount(place)
            some = np.flatnonzero(count)
            at = slice(first, first + len(count))
            if len(place) + len(errors) * len(some) < len(errors) * len(count):
                # Few of many buckets occur: these are numbered.
                number = np.empty(len(count), np.int64)
                number[some] = np.arange(len(some))
                place, count, at = number.take(place), count[some], first + some
            gradient = np.empty((len(errors), len(count)), np.float32)
            for k, error in enumerate(errors):
                gradient[k] = np.bincount(place, error, len(count)) if len(r) > 1 else error.sum()
            # The mean error of a bucket's tokens, with a step that grows with their number.
            n = np.maximum(count if len(r) > 1 else errors.shape[1], 1).astype(np.float32)
            sums[at] += np.einsum("ij,ij->j", gradient, gradient) / (n * len(errors)).astype(np.float32)
            gradient *= np.float32(self.s.rate) / np.sqrt(n * sums[at])
            weights[at] -= gradient.T.reshape(-1, *weights.shape[1:])

    def learn(self, token: np.ndarray, begin: np.ndarray) -> None:
        """A mini-batch's classes, then its words in classes, then its choices in all trees together."""
        for which, parts in groupby(self._parts(token, begin, self.v.ids(token), self.s.batch), itemgetter(0)):
            weights, sums = getattr(self, f"{which}_w"), getattr(self, f"{which}_g")
            found = [(rows, self._errors(weights, rows, base, target)) for _, _, rows, base, target in parts]
            rows = np.concatenate([x.reshape(3, -1) for x, _ in found], axis=1) if which == "tree" else found[0][0]
            self._step(weights, sums, rows, np.concatenate([e for _, e in found], axis=1, dtype=np.float64) if which == "tree" else found[0][1])


def train(docs: DataFrame, v: Vocabulary, text: str = "text") -> Model:
    """Weights learned from all texts of docs, each in one of the rounds: shards in parallel, then averages of blocks of buckets. What reaches the driver has the model's size."""
    model = Trainer(v)
    for turn in range(v.shape.rounds):
        part = docs.where(F.pmod(F.xxhash64(text), F.lit(v.shape.rounds)) == turn).select(F.col(text).alias("text"))
        model = _averaged(part, model)
    return model


def block_of(weights: np.ndarray, shape: Shape) -> int:
    """Buckets of a block of weights that are averaged together."""
    return max(1, shape.block * len(weights) // weights.size)


def _averaged(docs: DataFrame, start: Trainer) -> Trainer:
    """The mean of what shards of docs make of a model: a bucket's weights and sums by how much each shard saw it."""
    v, s = start.v, start.s
    held = docs.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, some = Trainer(held.value.v, held.value), False
        for batch in slices(batches, small=False):
            for w in words(texts_of(batch), most=BLOCK_BYTES):
                model.learn(*tokens(w))
                some = True
        for which in ("class", "word", "tree") if some else ():
            weights, sums, before = (getattr(m, f"{which}_{x}") for m, x in ((model, "w"), (model, "g"), (held.value, "g")))
            seen = np.sqrt(np.maximum(sums - before, 0)).astype(np.float16)
            size = block_of(weights, s)
            for i in range(0, len(weights), size):
                if seen[i : i + size].any():
                    yield pa.RecordBatch.from_arrays([pa.array([which]), pa.array([i // size]), pa.array([weights[i : i + size].astype(np.float16).tobytes()], pa.binary()), pa.array([seen[i : i + size].tobytes()], pa.binary())], ["which", "block", "weights", "seen"])

    def mean(parts: pa.Table) -> pa.Table:
        total, weight, sums = 0.0, 0.0, 0.0
        for w, g in zip(parts.column("weights").to_pylist(), parts.column("seen").to_pylist(), strict=True):
            seen = np.frombuffer(g, np.float16).astype(np.float64)
            total = total + np.frombuffer(w, np.float16).astype(np.float32).reshape(len(seen), -1) * seen[:, None]
            weight, sums = weight + seen, sums + seen**3
        some = np.maximum(weight, 1e-12)
        out = (total / some[:, None]).astype(np.float32)
        columns = [[parts.column("which")[0].as_py()], [parts.column("block")[0].as_py()], [out.tobytes()], [np.where(weight > 0, sums / some, -1).astype(np.float32).tobytes()]]
        return pa.table(dict(zip(("which", "block", "weights", "seen"), columns, strict=True)))

    shards = docs.coalesce(s.shards) if docs.rdd.getNumPartitions() > s.shards else docs
    schema = "which string, block long, weights binary, seen binary"
    learned = shards.mapInArrow(run, schema).groupBy("which", "block").applyInArrow(mean, schema).collect()
    model = Trainer(v, start)
    for row in learned:
        weights, sums = (getattr(model, f"{row.which}_{x}") for x in "wg")
        seen = np.frombuffer(row.seen, np.float32)
        at = row.block * block_of(weights, s) + np.flatnonzero(seen >= 0)
        weights[at] = np.frombuffer(row.weights, np.float32).reshape(len(seen), *weights.shape[1:])[seen >= 0]
        sums[at] += seen[seen >= 0]
    held.destroy()
    return model


def language_scores(docs: DataFrame, shape: Shape = Shape(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row of docs.

    Learns from rows whose crc32(key as text) modulo 10 is not 0. Null and empty texts are one end token; null
    keys count as training rows; repeated rows count and are scored each; an empty table gives none. Without training
    rows N and V are 0 and both scores are finite or null as the formula gives. Other columns are not read.
    """
    spark = docs.sparkSession
    known = bounded(docs).select(F.col(key), F.col(text).alias("text"), (F.col(key).isNotNull() & (crc32_mod(key, 10) == 0)).alias("held_out"))
    training = known.where(~F.col("held_out"))
    counts = written(word_counts(training))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    common = counts.where(F.col("n") >= max(1.0, total.n * COMMON)).toPandas()
    rare = counts.where(F.col("n") < max(1.0, total.n * COMMON))
    leaves = rest_leaves(rare, total.v - len(common), shape)
    v = Vocabulary(common["word"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.int64), total.n, total.v, shape.grown(total.n), leaves)
    model = train(training, v)
    held = spark.sparkContext.broadcast(Model(v, model))
    denominator = np.log10(max(total.n + SMOOTHING * (total.v + 1), 1e-300))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        row = TaskContext.get().partitionId() << 34
        for batch in slices(batches, small=False):
            for w in words(texts_of(batch), most=BLOCK_BYTES):
                token, begin = tokens(w)
                n = w.last - w.first
                owner = np.repeat(np.arange(n), np.diff(begin))
                place = m.v.find(token)
                some = place >= 0
                leaf = leaf_of(token[~some], len(m.v.leaves))
                ids = np.empty(len(token), np.int64)
                ids[some], ids[~some] = m.v.id[place[some]], -1 - leaf
                # Another word's share of its leaf: its count, which is joined, and the smoothing over those of the leaf.
                score = np.bincount(owner, m.log_probability(token, begin, ids), minlength=n) / np.log(10) - np.bincount(owner[~some], np.log10(m.v.leaves[leaf]), minlength=n)
                base = np.bincount(owner[some], np.log10(m.v.count[place[some]] + SMOOTHING), minlength=n)
                n_tokens = np.diff(begin)
                number = row + np.arange(n)
                row += n
                # One row for the text itself, with a word number of its own, and one for each word outside the model.
                text_of, word_at = owner[~some], token[~some]
                order = np.lexsort((word_at, text_of))
                text_of, word_at = text_of[order], word_at[order]
                edge = np.flatnonzero(np.concatenate([[True], (word_at[1:] != word_at[:-1]) | (text_of[1:] != text_of[:-1])])) if len(word_at) else np.zeros(0, np.int64)
                times = np.diff(np.append(edge, len(word_at)))
                text_of, word_at = text_of[edge], word_at[edge]
                k = len(edge)
                first = pa.array(np.arange(w.first, w.last))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([number, number[text_of]])),
                        pa.array(np.concatenate([mix(number.astype(np.uint64)), word_at]).view(np.int64)),
                        pa.array(np.concatenate([np.zeros(n, np.int64), times])),
                        pa.concat_arrays([batch.column(0).take(first), pa.nulls(k, batch.column(0).type)]),
                        pa.concat_arrays([batch.column(2).take(first), pa.nulls(k, pa.bool_())]),
                        *(pa.concat_arrays([pa.array(x), pa.nulls(k, pa.array(x).type)]) for x in (n_tokens.astype(np.int64), np.bincount(owner[some], minlength=n).astype(np.int64), base, score)),
                    ],
                    ["row", "word", "times", key, "held_out", "n_tokens", "common", "base", "model"],
                )

    schema = f"row long, word long, times long, `{key}` {dict(docs.dtypes)[key]}, held_out boolean, n_tokens long, common long, base double, model double"
    rows = known.mapInArrow(run, schema)
    looked = rows.join(rare.select(F.col("word").alias("_w"), F.col("n").alias("_n")), F.col("word") == F.col("_w"), "left")
    log_rare = F.col("times") * F.log10(F.coalesce("_n", F.lit(0)) + SMOOTHING)
    each = looked.groupBy("row").agg(
        *(F.max(c).alias(c) for c in (key, "held_out", "n_tokens", "common", "base", "model")),
        F.sum(log_rare).alias("rare"),
        F.sum(F.when(F.col("_n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    return each.select(
        key,
        "held_out",
        "n_tokens",
        (F.col("common") + F.col("rare_known")).alias("n_known"),
        F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare") - F.col("n_tokens") * F.lit(float(denominator))).alias("base_score"),
        (F.col("model") + F.col("rare")).alias("score"),
    )
