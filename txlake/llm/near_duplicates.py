"""Near-duplicates by SetSketch registers over word shingles.

A document's set is its distinct shingles of ``size`` lower-cased words (A-Z only), as 64-bit hashes. Documents with
the same set form a class; the rest works on one document per class. A class has ``BANDS * ROWS`` SetSketch
registers: minima of exponential variables, floored on a logarithmic scale to base ``SCALE`` and truncated to 16 bits.
Registers are mergeable by maximum, and equal ones are at least as likely as the Jaccard similarity.

Candidates share all registers of a band. Every member of a bucket is paired with the bucket's smallest class
only; the pair's likelihood over greater, smaller and equal registers, with the exact set sizes, estimates the
similarity, and what lies more than ``MARGIN`` below the threshold (eight standard deviations) is let go. Buckets with
members unlike their leader are gone through in blocks of bounded size, by registers. What likely pairs join is a
cluster, and the members of a cluster are compared on their full sets, again in blocks, which return only the links
that join components. So no link that bands can show is lost: at the threshold, a pair shares no band with
probability (1 - 0.8 ** 4) ** 40, below 1e-9.

Defined cases: null, empty and wordless texts have an empty set and stand alone; a text with fewer words than a
shingle has its whole sequence as the one shingle; a null doc_id belongs to its text's component, and is kept only if
no id is in it; rows that repeat a doc_id are documents of their own, also for ``survivors``; extra columns are ignored by ``groups`` and
kept by ``survivors``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget_process_cache, stored
from .graph import components
from .textops import BASE, SpanHasher, mix, slices, text_buffer, window_hashes, word_spans
from .wordids import gathered

BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
SCALE, RATE, TOP = 1.001, 20.0, 65535
MARGIN = 0.25
#: Members of a block, and shingles where its members' sets are compared.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
CHUNK = 256
U64 = np.uint64


def shingle_sets(part: pa.RecordBatch, size: int, hasher: SpanHasher) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text of a slice."""
    data, offs = text_buffer(part.column("text"))
    starts, ends, first = word_spans(data, offs)
    words = hasher(data, starts, ends)
    windows, _ = window_hashes(words, first, size)
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            whole = U64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    whole = whole * U64(BASE) + w
            yield mix(np.array([whole]) ^ U64(BASE))
        else:
            yield np.zeros(0, U64)


def class_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class Sketcher:
    def __init__(self):
        seed = mix(np.arange(1, 2 * REGISTERS + 1, dtype=U64) * U64(BASE))
        self.flip, self.factor = seed[:REGISTERS], seed[REGISTERS:] | U64(1)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """The registers (unsigned 16 bits) of a set that is not empty."""
        least = np.full(REGISTERS, np.iinfo(U64).max, U64)
        for i in range(0, len(shingles), CHUNK):
            np.minimum(least, ((shingles[i : i + CHUNK, None] ^ self.flip) * self.factor).min(axis=0), out=least)
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
        return np.clip(np.floor(1 - np.log(exponential / RATE) / np.log(SCALE)), 0, TOP).astype("<u2")


def registers_of(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u2").reshape(-1, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    packed = registers.astype(U64).reshape(-1, BANDS, ROWS)
    key = np.zeros(packed.shape[:2], U64)
    for r in range(ROWS):
        key = (key << U64(16)) | packed[:, :, r]
    return mix(key ^ mix(np.arange(1, BANDS + 1, dtype=U64))).view(np.int64)


def estimated(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of most likelihood for pairs of registers, given the sizes of the sets."""
    above, below = (left > right).sum(axis=1), (left < right).sum(axis=1)
    equal = left.shape[1] - above - below
    u = (n_left / (n_left + n_right))[:, None]
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / (1 - u), (1 - u) / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (SCALE - 1) / SCALE) / np.log(SCALE)

    with np.errstate(divide="ignore", invalid="ignore"):
        greater, smaller = p(u - (1 - u) * grid), p((1 - u) - u * grid)

        def term(n, q):
            return np.where(n[:, None] > 0, n[:, None] * np.log(np.maximum(q, 1e-300)), 0.0)

        likelihood = term(above, greater) + term(below, smaller) + term(equal, 1 - greater - smaller)
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def row_of(docs: DataFrame) -> Column:
    """Tells rows with the same doc_id apart by their texts."""
    return F.xxhash64(docs["text"].cast("string"))


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, row (a hash of the text), n_shingles, the class (digest of the set) and its registers; one pass, no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_process_cache()
        hasher, sketcher = SpanHasher(fold=True), Sketcher()
        for part in slices(batches):
            sets = list(shingle_sets(part, size, hasher))
            digests = [class_of(s) for s in sets]
            known: dict[bytes, bytes] = {}
            for s, d in zip(sets, digests):
                if len(s) and d not in known:
                    known[d] = sketcher(s).tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array([known.get(d) for d in digests], pa.binary())],
                ["doc_id", "row", "n_shingles", "class", "registers"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), row_of(docs).alias("row"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, row long, n_shingles long, class binary, registers binary")


def banded(classes: DataFrame) -> DataFrame:
    """class, key: one row per class and band."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(registers_of(batch.column("registers")))
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), keys.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("class"), lists], ["class", "keys"])

    return classes.select("class", "registers").mapInArrow(run, "class binary, keys array<long>").select("class", F.explode("keys").alias("key"))


def likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of classes whose registers do not rule the threshold out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = estimated(
                    registers_of(batch.column("registers_a")), registers_of(batch.column("registers_b")), batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                )
                yield batch.select(["a", "b"]).filter(pa.array(found >= threshold - MARGIN))

    def side(s: str) -> DataFrame:
        return classes.select(F.col("class").alias(s), F.col("registers").alias(f"registers_{s}"), F.col("n_shingles").alias(f"n_{s}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a binary, b binary")


def sets_of(asked: DataFrame, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """class, shingles array<long> (the full set) for the distinct classes of ``asked``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(fold=True)
        for part in slices(batches):
            sets, kept = [], []
            for s, asked_for in zip(shingle_sets(part, size, hasher), part.column("class").to_pylist()):
                kept.append(class_of(s) == asked_for)  # else another text under the same doc_id
                if kept[-1]:
                    sets.append(s)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, U64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("class").filter(pa.array(kept, pa.bool_())), pa.ListArray.from_arrays(offsets, flat)], ["class", "shingles"])

    asked = asked.distinct().join(classes.select("class", "first_id"), "class")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    sets = texts.join(asked, texts["id"].eqNullSafe(asked["first_id"])).select("class", "text").mapInArrow(run, "class binary, shingles array<long>")
    return sets.dropDuplicates(["class"])


class Forest:
    """Collects the pairs that join what earlier pairs have not joined yet."""

    def __init__(self, group: pa.Table):
        self.name = group.column("class").to_pylist()
        self.root = np.unique(np.array(group.column("label").to_pylist(), object), return_inverse=True)[1]
        self.pairs: list[tuple[bytes, bytes]] = []

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return others[self.root[others] != self.root[i]]

    def join(self, i: int, others: np.ndarray) -> None:
        for root in np.unique(self.root[others]):
            j = others[self.root[others] == root][0]
            self.pairs.append((self.name[i], self.name[j]))
            self.root[self.root == root] = self.root[i]

    def table(self) -> pa.Table:
        return pa.table({"a": pa.array([a for a, _ in self.pairs], pa.binary()), "b": pa.array([b for _, b in self.pairs], pa.binary())})


def in_blocks(members: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Deals the members of each ``group`` to ``blocks`` blocks, and each member to all pairs of blocks (low, high) that
    its block is in. A pair of blocks is a group of bounded size."""
    blocks = F.ceil(blocks).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select(group, "class", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def bucket_forest(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Likely pairs (a, b) that join, inside each pair of blocks of each bucket, all that likely pairs join."""

    def run(group: pa.Table) -> pa.Table:
        registers, n = registers_of(group.column("registers")), group.column("n_shingles").to_numpy()
        block, low, high = group.column("block").to_numpy(), group.column("low")[0].as_py(), group.column("high")[0].as_py()
        forest, those = Forest(group), np.flatnonzero(block == high)
        for i in np.flatnonzero(block == low):
            j = forest.apart(i, those)
            # Far fewer equal registers than any pair at the threshold has; spares the likelihood.
            j = j[(registers[j] == registers[i]).sum(axis=1) >= (threshold - MARGIN - 0.1) * REGISTERS]
            if len(j):
                near = estimated(np.repeat(registers[i : i + 1], len(j), axis=0), registers[j], np.repeat(n[i], len(j)), n[j])
                forest.join(i, j[near >= threshold - MARGIN])
        return forest.table()

    dealt = in_blocks(members, "key", F.col("n") / BLOCK).join(classes.select("class", "registers", "n_shingles"), "class")
    return dealt.groupBy("key", "low", "high").applyInArrow(run, "a binary, b binary").distinct()


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed pairs (a, b) that join, inside each pair of blocks of each cluster, all that confirmed pairs join."""

    def run(group: pa.Table) -> pa.Table:
        block, low, high = group.column("block").to_numpy(), group.column("low")[0].as_py(), group.column("high")[0].as_py()
        lists = group.column("shingles").combine_chunks()
        n = np.diff(lists.offsets.to_numpy())
        start = np.concatenate([[0], np.cumsum(n)])
        owner = np.repeat(np.arange(len(n)), n)
        shingle = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
        there = np.flatnonzero(block[owner] == high)
        there = there[np.argsort(shingle[there], kind="stable")]
        posted, bounds = owner[there], np.searchsorted(shingle[there], np.arange(shingle.max(initial=0) + 2))
        forest, those = Forest(group), np.flatnonzero(block == high)
        for i in np.flatnonzero(block == low):
            if len(forest.apart(i, those)):
                mine = shingle[start[i] : start[i + 1]]
                common = np.bincount(gathered(posted, bounds[mine], bounds[mine + 1] - bounds[mine]), minlength=len(n))
                forest.join(i, forest.apart(i, np.flatnonzero(100 * common >= percent * (n[i] + n - common))))
        return forest.table()

    blocks = F.greatest(F.col("n") / BLOCK, F.col("n_shingles") / BLOCK_SHINGLES)
    dealt = in_blocks(members, "cluster", blocks).join(sets, "class")
    return dealt.groupBy("cluster", "low", "high").applyInArrow(run, "a binary, b binary").distinct()


def labelled(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the sketched rows, the classes of those with words, class and label: the least class reachable over links)."""
    rows = stored(sketched(docs, size))
    classes = rows.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n_shingles"), F.min("registers").alias("registers")
    )
    classes = stored(classes, rows.count())
    bands = banded(classes)
    leaders = bands.groupBy("key").agg(F.min("class").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stored(bands.join(leaders, "key"), BANDS * classes.count())

    spokes = buckets.where("class <> leader").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    spokes = stored(likely(spokes, classes, percent / 100), buckets.count())

    # Leaders have met all others of their bucket; where some are unlike the leader, they may be like each other.
    alike = spokes.select(F.col("a").alias("leader"), F.col("b").alias("class"), F.lit(True).alias("alike"))
    met = buckets.where("class <> leader and n > 2").join(alike, ["leader", "class"], "left")
    open_ = met.groupBy("key").agg(F.count_if(F.col("alike").isNull()).alias("unlike")).where("unlike > 0").select("key")
    members = met.join(open_, "key").withColumn("label", F.when(F.col("alike"), F.col("leader")).otherwise(F.col("class")))
    clusters = components(spokes.union(bucket_forest(members, classes, percent / 100)))

    clusters = clusters.select(F.col("node").alias("class"), F.col("label").alias("cluster"), F.col("node").alias("label"))
    sizes = clusters.join(classes.select("class", "n_shingles"), "class").groupBy("cluster")
    members = clusters.join(sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("n_shingles")), "cluster")
    labels = components(block_links(members, sets_of(clusters.select("class"), docs, classes, size), percent))
    labels = classes.select("class").join(labels.withColumnRenamed("node", "class"), "class", "left").select("class", F.coalesce("label", "class").alias("label"))
    return rows, classes, labels


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept, for every row."""
    rows, classes, labels = labelled(docs, size, percent)
    smallest = labels.join(classes, "class").groupBy("label").agg(F.min("first_id").alias("component_id"))
    ids = labels.join(smallest, "label").select(F.col("class").alias("of"), "component_id")
    named = rows.join(ids, F.col("class") == F.col("of"), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def survivors(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one with the smallest doc_id, without an id the
    last; where a doc_id repeats, the one with the least class and hash of its text. Rows without words all stay. Decided
    by row: a row goes only if the row that stays is linked with it over its own text."""
    rows, _, labels = labelled(docs, size, percent)
    copies = rows.groupBy("doc_id", "row", "n_shingles", "class").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "class", "row", "copies")
    first = copies.join(labels, "class").groupBy("label").agg(F.min(place).alias("first")).select("first.doc_id", "first.row", "first.copies")
    bare = copies.where("n_shingles = 0").select("doc_id", "row", F.lit(1).alias("copies"))
    staying = first.union(bare).select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("copies").alias("__copies"))
    told = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (row_of(docs) == F.col("__row"))
    kept = docs.join(staying, told)
    # Rows equal in id and text are one row; only those are brought together.
    once = kept.where("__copies > 1").dropDuplicates(["__id", "__row"])
    return kept.where("__copies = 1").union(once).drop("__id", "__row", "__copies")
