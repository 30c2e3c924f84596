"""N-gram Jaccard join by prefix filters under several global orders of the shingles.

Two sets can only reach the similarity if their prefixes (their first n - ceil(t n) + 1 shingles) share one,
and that holds under every global order. So candidates must pass the filter under several orders before their sets are
compared. What is wanted is who is linked with whom, directly or through others, so groups are never
expanded into pairs:

1. Equal sets are one node from here on.
2. Under each order, the sets with the same first shingle are compared with one of them, a pivot. Links make
   components; weaker similarity makes groups, which hold what is alike but not linked so far.
3. In a group whose sets aren't all connected, blocks of the sets outside its largest component meet blocks of all its sets, in a task
   each. Sets that are connected already are passed over, so only links that join something come out.
4. Between groups, prefixes under one order (shingles that many documents share come last) are dealt by shingle. Sets of
   different groups that share one are candidates; where very many share one, blocks of their sizes and parity bits meet in tasks. Sizes,
   parity bits and the prefixes under the other orders are intersected before any text is fetched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.components import components
from chatloom.llm.tables import bounded, slices, written
from chatloom.llm.textbytes import mix, seeded, texts_of, windows, words

ORDERS = 5
#: Of these, so many more than the first have their prefixes intersected before texts are fetched.
FILTERS = 2
#: Shingles that so many of a task's sets have, among so many shingles in turn, may be frequent; each time at most so many are named.
LOCAL_COUNT, LOCAL_NAMED, COUNTED = 3, 50_000, 1 << 22
#: Frequent shingles that orders put last, at most; any choice gives the same links.
FREQUENT = 4_000_000
#: Similarity from which sets share a group, in percent; any value gives the same links.
GROUP_PERCENT = 50
#: Shingles of a block of a group's sets, about: what a task holds of each side.
BLOCK_SHINGLES = 150_000
#: A shingle in the prefixes of more sets of different groups becomes frequent too, and prefixes are taken anew, at most so often.
LONG_LIST, AGAIN = 100, 1
#: Sets of a block of a list with more than LONG_LIST sets.
LIST_BLOCK = 1024
#: Parts of the rows of one key where a large table meets facts about its keys.
SALTS = 32
#: Ids are sent to all machines to pick texts up to so many; beyond, texts are joined by shuffle.
SENT_IDS = 1_000_000
#: Pairs of one pivot that stay together; a pivot with more is dealt to several tasks.
PIVOT_PAIRS = 64
_U = np.uint64
_ORDER = seeded(ORDERS, 5)
_EPS = 1e-9


def shingle_sets(texts: list[bytes], width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Block by block: first text, end, sorted distinct shingle hashes of all its texts, and where each text's begin.

    A text with fewer words than width has its whole sequence as one shingle, without words none.
    """
    for w in words(texts):
        value, at = windows(w.hash, w.word_at, width)
        owner = w.text_of_word()[at]
        n_words = np.diff(w.word_at)
        short = np.flatnonzero((n_words > 0) & (n_words < width))
        if len(short):
            own = [windows(w.hash[w.word_at[i] : w.word_at[i + 1]], np.array([0, n_words[i]]), int(n_words[i]))[0] for i in short]
            value, owner = np.concatenate([value, *own]), np.concatenate([owner, short])
            order = np.argsort(owner, kind="stable")
            value, owner = value[order], owner[order]
        begin = np.searchsorted(owner, np.arange(w.last - w.first + 1))
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            value[a:b].sort()
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        count = np.concatenate([[0], np.cumsum(new)])
        yield w.first, w.last, value[new], count[begin]


def short(values: np.ndarray) -> np.ndarray:
    """The upper half of each hash: enough to tell what is frequent, and to find that prefixes share nothing."""
    return (values >> _U(32)).astype(np.uint32)


def _ranks(values: np.ndarray, order: int, frequent: np.ndarray) -> np.ndarray:
    """A shingle's place in a global order: seeded, with the frequent ones (short, sorted) last."""
    place = mix(values ^ _ORDER[order]) >> _U(1)
    if len(frequent):
        place[_among(short(values), frequent)] |= _U(1 << 63)
    return place


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known, sorted ones."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def parity_bits(value: np.ndarray, size: int = 0) -> bytes:
    """A bit for each residue of the shingles: whether their number is odd. Four bits a shingle or more.

    Where two sets' bits differ, at least one shingle is in one set only, so differing bits bound the difference from below.
    """
    size = max(64, size or 4 << max(len(value) - 1, 0).bit_length())
    return np.packbits(np.bincount((value & _U(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """Differing bits, after the longer one is folded to the length of the shorter."""
    a, b = (np.frombuffer(v, np.uint64) for v in sorted((x, y), key=len))
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def profile(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """For each document (named: false) its key, text_hash, n, node (a hash of its set, null if empty), first shingles, parity bits and standing; and shingles that are frequent in a slice (named: true) as node, short, with n.

    A set's standing is the share of its shingles that its slice holds twice: central sets of a group have most.
    """
    names = [key, "text_hash", "named", "n", "node", "firsts", "bits", "standing"]
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[key].dataType)

    def named(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, count = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        many = np.flatnonzero(count >= LOCAL_COUNT)
        many = many[np.argsort(-count[many], kind="stable")][:LOCAL_NAMED]
        m = len(many)
        columns = [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.array(np.ones(m, bool)), pa.array(count[many]), pa.array(values[many].astype(np.int64)), pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.binary()), pa.nulls(m, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        for batch in slices(batches):
            sizes, nodes, firsts, held, bits = [], [], [], [], []
            for _, _, value, at in shingle_sets(texts_of(batch), width):
                n = np.diff(at)
                some = n > 0
                node = np.zeros(len(n), np.uint64)
                first = np.zeros((len(n), ORDERS), np.uint64)
                if some.any():
                    begin = at[:-1][some]
                    node[some] = node_hash(value, begin, n[some])
                    for k in range(ORDERS):
                        first[some, k] = np.minimum.reduceat(mix(value ^ _ORDER[k]), begin)
                sizes.append(n)
                nodes.append(node)
                firsts.append(first)
                held.append(short(value))
                bits += [parity_bits(value[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            n, node, first = np.concatenate(sizes), np.concatenate(nodes).view(np.int64), np.concatenate(firsts).view(np.int64)
            values = np.sort(np.concatenate(held))
            again = np.zeros(len(values), bool)
            again[1:] = values[1:] == values[:-1]
            twice = values[again]
            total = [np.concatenate([[0], np.cumsum(_among(x, twice))]) for x in held]
            common = np.concatenate([np.diff(t[np.concatenate([[0], np.cumsum(k)])]) for t, k in zip(total, sizes, strict=True)]) / np.maximum(n, 1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(first.ravel()), ORDERS).cast(pa.list_(pa.int64()))
            columns = [batch.column(0), batch.column(2), pa.array(np.zeros(len(n), bool)), pa.array(n), pa.array(node, mask=n == 0), lists, pa.array(bits, pa.binary()), pa.array(common)]
            yield pa.RecordBatch.from_arrays(columns, names)
            seen.append(values)
            if sum(map(len, seen)) >= COUNTED:
                yield from named(seen)
                seen = []
        yield from named(seen)

    schema = f"`{key}` {dict(docs.dtypes)[key]}, text_hash long, named boolean, n long, node long, firsts array<long>, bits binary, standing double"
    return docs.select(key, F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(run, schema)


def node_hash(value: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of each set of shingles; the sets lie one after another from begin on, and none is empty."""
    return mix(np.add.reduceat(mix(value + _U(1)), begin) + n.astype(np.uint64))


def texts_of_nodes(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """The columns of nodes, and the text of the document that stands for each: by its id and the text's hash, as an id may have several texts."""
    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.xxhash64(text).alias("_hash"))
    wanted = F.broadcast(nodes) if nodes.count() <= SENT_IDS else nodes
    return found.join(wanted, (F.col("_key") == F.col("doc")) & (F.col("_hash") == F.col("text_hash"))).select(*nodes.columns, "text")


def linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))


def near_enough(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs(a, b, slack) whose distance can be the threshold's plus slack, by their sizes and parity bits: a, b, exact (slack is above 0)."""
    info = nodes.select("node", "n", "bits")
    for side in ("a", "b"):
        pairs = pairs.join(info.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"bits_{side}")), side)
    bound = 1 - percent / 100 + _EPS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, slack = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 2))
            differ = np.fromiter((least_difference(x, y) for x, y in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True)), np.int64, len(na))
            least = np.maximum(2 * differ / np.maximum(na + nb + differ, 1), 1 - np.minimum(na, nb) / np.maximum(np.maximum(na, nb), 1))
            keep = pa.array(least <= bound + slack)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(slack > 0).filter(keep)], ["a", "b", "exact"])

    return pairs.select("a", "b", "slack", "na", "nb", "bits_a", "bits_b").mapInArrow(run, "a long, b long, exact boolean")


def _ends_of(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, doc and text_hash of the nodes in pairs."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    return ends.join(nodes, "node").select("node", "doc", "text_hash")


def prefixes_meet(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """The pairs(a, b, exact) whose prefixes share a shingle under each of the other orders. Prefixes are taken where the texts lie."""
    named = texts_of_nodes(docs, written(_ends_of(pairs, nodes)), key, text).select("node", "text")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint32)
        for batch in slices(batches):
            lists: list[list[bytes]] = [[] for _ in range(FILTERS)]
            for _, _, value, at in shingle_sets(texts_of(batch), width):
                for k, out in enumerate(lists, 1):
                    rank = _ranks(value, k, none)
                    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                        m = prefix_size(b - a, percent)
                        out.append(np.sort(short(value[a:b][np.argpartition(rank[a:b], m - 1)[:m]])).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in lists)], ["node", *names])

    names = [f"order{k}" for k in range(1, FILTERS + 1)]
    taken = written(named.mapInArrow(take, "node long, " + ", ".join(f"{n} binary" for n in names)).dropDuplicates(["node"]))
    for side in ("a", "b"):
        pairs = pairs.join(taken.select(F.col("node").alias(side), *(F.col(n).alias(f"{n}_{side}") for n in names)), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for k in range(FILTERS):
                both = zip(batch.column(3 + k).to_pylist(), batch.column(3 + FILTERS + k).to_pylist(), strict=True)
                keep &= np.fromiter((bool(_among(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)).any()) for x, y in both), bool, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in range(3)], ["a", "b", "exact"])

    return pairs.select("a", "b", "exact", *(f"{n}_a" for n in names), *(f"{n}_b" for n in names)).mapInArrow(run, "a long, b long, exact boolean")


def compared(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int, key: str, text: str, filtered: bool = True) -> DataFrame:
    """a, b, na, nb and both (shared shingles) of the pairs(a, b, slack) that can matter: pivot a, node b.

    Pairs whose sizes or parity bits put them beyond the threshold plus slack are left out, and (filtered) those whose prefixes don't
    share a shingle under every order. Texts are fetched only for what is left; a pivot with many pairs is dealt to several tasks.
    """
    pairs = written(near_enough(pairs, nodes, percent))
    if filtered:
        pairs = written(prefixes_meet(pairs, nodes, docs, width, percent, key, text))
    texts = written(texts_of_nodes(docs, written(_ends_of(pairs, nodes)), key, text).select("node", "text").dropDuplicates(["node"]))
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIVOT_PAIRS).alias("parts"))
    dealt = written(pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts"))).drop("parts"))
    left = dealt.select("a", "part").distinct().join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    rows = dealt.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(left, ["a", "part"]).select("a", "b", "ta", "tb")
    none = np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes | None, np.ndarray] = (None, none)
        one = lambda t: next((v for _, _, v, _ in shingle_sets([t], width)), none)
        for batch in batches:
            out: list[tuple] = []
            for i, (ta, tb) in enumerate(zip(texts_of(batch, "ta"), texts_of(batch, "tb"), strict=True)):
                if ta != last[0]:
                    last = (ta, one(ta))
                x, y = last[1], one(tb)
                out.append((i, len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array([o[k] for o in out], pa.int64()) for k in (1, 2, 3))], ["a", "b", "na", "nb", "both"])

    return written(rows.mapInArrow(run, "a long, b long, na long, nb long, both long").distinct())


def prefixes(docs: DataFrame, width: int, percent: int, frequent: np.ndarray, key: str, text: str) -> DataFrame:
    """key, node and the shingles of the prefix of each document that has shingles."""
    held = docs.sparkSession.sparkContext.broadcast(np.sort(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, nodes, found, ends = [], [], [], [0]
            for first, last, value, at in shingle_sets(texts_of(batch), width):
                rank = _ranks(value, 0, held.value)
                n = np.diff(at)
                if (n > 0).any():
                    nodes.append(node_hash(value, at[:-1][n > 0], n[n > 0]))
                for i in range(last - first):
                    a, b = at[i], at[i + 1]
                    if a == b:
                        continue
                    m = prefix_size(int(b - a), percent)
                    chosen = np.argpartition(rank[a:b], m - 1)[:m]
                    rows.append(first + i)
                    found.append(value[a:b][chosen])
                    ends.append(ends[-1] + m)
            node = np.concatenate(nodes).view(np.int64) if nodes else np.zeros(0, np.int64)
            flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(node), lists], [key, "node", "shingles"])

    return docs.select(key, F.col(text).alias("text")).mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, node long, shingles array<long>")


def most(counts: DataFrame, name: str, least: int) -> np.ndarray:
    """Short shingles with at least least and with at least a FREQUENT-th of all counts, which at most FREQUENT can have."""
    counts = written(counts.where(F.col("n") >= least))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") >= total / FREQUENT).select(name).toPandas()[name].to_numpy(np.int64).astype(np.uint32)


def _shared_prefixes(docs: DataFrame, labels: DataFrame, width: int, percent: int, frequent: np.ndarray, key: str, text: str) -> DataFrame:
    """node, shingle, grp, n: of the shingles in prefixes of sets of different groups."""
    taken = prefixes(docs, width, percent, frequent, key, text)
    named = labels.select(F.col("node").alias("_node"), F.col("doc").alias("_doc"), "grp")
    named = F.broadcast(named) if named.count() <= SENT_IDS else named
    dealt = taken.join(named, (F.col(key) == F.col("_doc")) & (F.col("node") == F.col("_node"))).select(F.explode("shingles").alias("shingle"), "node", "grp").repartition("shingle")
    # Both sides need the same columns, so that they share one exchange.
    both = F.struct("grp", "node")
    mixed = dealt.groupBy("shingle").agg(F.min(both).alias("_l"), F.max(both).alias("_h")).where("_l.grp <> _h.grp").select("shingle")
    return written(dealt.join(mixed, "shingle").distinct().join(labels.select("node", "n"), "node"))


def _joins(label: np.ndarray, sets: list[np.ndarray], bits: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of left with right places that join what isn't connected yet: a set is compared only with those of other labels."""
    found = []
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    for i in left.tolist():
        other = right[label[right] != label[i]]
        differ = np.bitwise_count(bits[other] ^ bits[i]).sum(axis=1, dtype=np.int64)
        total = n[other] + n[i]
        near = (100 * (total - differ) >= percent * (total + differ)) & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))
        for j in other[near][np.argsort(differ[near], kind="stable")].tolist():
            if label[j] != label[i]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (n[i] + n[j] - both):
                    found.append((i, j))
                    label[label == label[j]] = label[i]
    return found


def _with_facts(rows: DataFrame, facts: DataFrame, on: str, node: str = "node") -> DataFrame:
    """rows joined with facts about their key on; the rows of a key are dealt to several tasks."""
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(node), F.lit(SALTS)).cast("int")).join(salted, [on, "_salt"]).drop("_salt")


def group_links(labels: DataFrame, docs: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """Links a, b inside groups that hold several components: blocks of the sets outside the largest one meet blocks of all sets, no pairs are made."""
    parts = labels.groupBy("grp", "component").agg(F.sum("n").alias("n"))
    sums = parts.groupBy("grp").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    sums = written(sums.select("grp", "main", F.ceil((F.col("all") - F.col("most")) / BLOCK_SHINGLES).cast("int").alias("few"), F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("many")))
    wanted = written(_with_facts(labels.select("node", "doc", "text_hash", "component", "grp"), sums, "grp"))
    members = written(texts_of_nodes(docs, wanted, key, text).dropDuplicates(["node"]))
    mine = F.xxhash64("node")
    outside = members.where(F.col("component") != F.col("main")).withColumn("i", F.pmod(mine, F.col("few")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("many") - 1))).withColumn("left", F.lit(True))
    every = members.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("few") - 1))).withColumn("j", F.pmod(mine, F.col("many")).cast("int")).withColumn("left", F.lit(False))
    rows = outside.unionByName(every).select("grp", "i", "j", "left", "node", "component", "text")

    def run(part: pa.Table) -> pa.Table:
        texts = part.column("text").cast(pa.large_binary()).to_pylist()
        sets = [v[a:b] for _, _, v, at in shingle_sets(texts, width) for a, b in zip(at[:-1], at[1:], strict=True)]
        size = 1 << (4 * max(map(len, sets))).bit_length()
        bits = np.stack([np.frombuffer(parity_bits(v, size), np.uint64) for v in sets])
        label = np.unique(part.column("component").to_numpy(), return_inverse=True)[1].copy()
        left, node = part.column("left").to_numpy(), part.column("node").to_numpy()
        links = _joins(label, sets, bits, np.flatnonzero(left), np.flatnonzero(~left), percent)
        return pa.table({"a": node[np.array([x for x, _ in links], np.int64)], "b": node[np.array([y for _, y in links], np.int64)]})

    return written(rows.groupBy("grp", "i", "j").applyInArrow(run, "a long, b long"))


def long_lists(lists: DataFrame) -> DataFrame:
    """Shingles that more than LONG_LIST sets share: shingle, their main group, and blocks of the sets outside it (few) and of all (many)."""
    parts = lists.groupBy("shingle", "grp").agg(F.count(F.lit(1)).alias("m"))
    sums = parts.groupBy("shingle").agg(F.max(F.struct("m", "grp"))["grp"].alias("main"), F.sum("m").alias("all"), F.max("m").alias("most")).where(F.col("all") > LONG_LIST)
    return sums.select("shingle", "main", F.ceil((F.col("all") - F.col("most")) / LIST_BLOCK).cast("int").alias("few"), F.ceil(F.col("all") / LIST_BLOCK).cast("int").alias("many"))


def long_list_pairs(lists: DataFrame, nodes: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """a, b of sets of different groups on a long list (shingle, node, grp, n) that sizes and parity bits allow: blocks of the sets outside its main group meet blocks of all in tasks, no pairs are made before."""
    rows = _with_facts(lists, long, "shingle").join(nodes.select("node", "bits"), "node")
    mine = F.xxhash64("node")
    outside = rows.where(F.col("grp") != F.col("main")).withColumn("i", F.pmod(mine, F.col("few")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("many") - 1))).withColumn("left", F.lit(True))
    every = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("few") - 1))).withColumn("j", F.pmod(mine, F.col("many")).cast("int")).withColumn("left", F.lit(False))
    dealt = outside.unionByName(every).select("shingle", "i", "j", "left", "node", "grp", "n", "bits")

    def run(part: pa.Table) -> pa.Table:
        left, node, grp, n = (part.column(c).to_numpy() for c in ("left", "node", "grp", "n"))
        bits = part.column("bits").to_pylist()
        size = min(map(len, bits)) // 8
        # Longer bits are folded to the length of the shortest.
        bits = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, size), axis=0) for x in bits])
        right, found = np.flatnonzero(~left), [np.zeros((2, 0), np.int64)]
        for x in np.flatnonzero(left).tolist():
            other = right[(grp[right] != grp[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            differ = np.bitwise_count(bits[other] ^ bits[x]).sum(axis=1, dtype=np.int64)
            other = other[100 * (n[other] + n[x] - differ) >= percent * (n[other] + n[x] + differ)]
            found.append(np.stack([np.minimum(node[other], node[x]), np.maximum(node[other], node[x])]))
        a, b = np.concatenate(found, axis=1)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("shingle", "i", "j").applyInArrow(run, "a long, b long")


def link_components(docs: DataFrame, width: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id of every row of docs.

    A row's set is its distinct shingles of width words (lower-cased A-Z; with fewer words the whole sequence). Rows link when
    100 times the shared shingles are at least percent times all of both; component_id is the least key that links
    reach, the own one included. Null and empty texts have no shingles and are linked with nothing; rows with a null key get
    a null component and link nothing; repeated rows each give a row; an empty table gives none. Other columns are not read.
    Shingles and sets are told apart by 64-bit hashes.
    """
    known = written(profile(bounded(docs), width, key, text))
    rows = known.where(~F.col("named"))
    usable = rows.where(F.col("node").isNotNull() & F.col(key).isNotNull())
    kept = [F.min(F.struct(F.col(key).alias("doc"), "text_hash")).alias("_d"), *(F.first(c).alias(c) for c in ("n", "firsts", "bits")), F.max("standing").alias("standing")]
    nodes = written(usable.groupBy("node").agg(*kept).select("node", "_d.*", "n", "firsts", "bits", "standing"))
    frequent = most(known.where("named").groupBy("node").agg(F.sum("n").alias("n")), "node", 1)

    # One pivot for each first shingle under each order: the set of highest standing.
    starts = nodes.select("node", "standing", F.posexplode("firsts").alias("k", "first"))
    pivots = starts.groupBy("k", "first").agg(F.max(F.struct("standing", "node"))["node"].alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    slack = (percent - GROUP_PERCENT) / 100
    stars = starts.join(pivots, ["k", "first"]).where(F.col("a") != F.col("node")).select("a", F.col("node").alias("b"), F.lit(slack).alias("slack")).distinct()
    seen = compared(stars, nodes, docs, width, percent, key, text, filtered=False)
    alike, edges = seen.where(linked(GROUP_PERCENT)).select("a", "b"), [seen.where(linked(percent)).select("a", "b")]
    connected, grouped = components(edges[0]), components(alike).withColumnRenamed("component", "grp")
    labels = nodes.select("node", "doc", "text_hash", "n").join(connected, "node", "left").join(grouped, "node", "left")
    labels = written(labels.withColumn("component", F.coalesce("component", "node")).withColumn("grp", F.coalesce("grp", "node")))
    edges.append(group_links(labels, docs, width, percent, key, text))

    for turn in range(AGAIN + 1):
        lists = _shared_prefixes(docs, labels, width, percent, frequent, key, text)
        if turn == AGAIN:
            break
        longer = most(lists.groupBy(F.shiftrightunsigned("shingle", 32).alias("shingle")).agg(F.countDistinct("grp").alias("n")), "shingle", LONG_LIST + 1)
        if not len(np.setdiff1d(longer, frequent)):
            break
        frequent = np.union1d(frequent, longer)
    long = written(long_lists(lists))
    few = lists.join(long, "shingle", "left_anti")
    one, two = (few.select("shingle", F.col("node").alias(p), F.col("grp").alias(f"g{p}"), F.col("n").alias(f"n{p}")) for p in ("a", "b"))
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    meet = one.join(two, "shingle").where(sizes & F.expr("a < b and ga <> gb")).select("a", "b").union(long_list_pairs(lists, nodes, long, percent)).withColumn("slack", F.lit(0.0)).distinct()
    edges.append(compared(meet, nodes, docs, width, percent, key, text).where(linked(percent)).select("a", "b"))

    whole = components(reduce(DataFrame.union, edges))
    reached = nodes.select("node", "doc").join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = reached.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_node = written(reached.join(least, "component").select(F.col("node").alias("_node"), "component_id"))
    with_set = usable.join(of_node, F.col("node") == F.col("_node"), "left").select(key, F.col("n").alias("n_shingles"), "component_id")
    others = rows.where(F.col("node").isNull() | F.col(key).isNull()).select(key, F.col("n").alias("n_shingles"), F.col(key).alias("component_id"))
    return with_set.union(others)
