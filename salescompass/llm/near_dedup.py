"""MinHash near-dedup with BagMinHash signatures of weighted word shingles.

A document is the multiset of its five-word shingles.  Every unit of a shingle's weight
has a Poisson process for each register, and a register holds the first point of all the
processes of the document, so two documents agree in a register with the probability of
their weighted Jaccard similarity.  The weights are cut into the levels (0, 1], (1, 2],
(2, 4], (4, 8], …; one process stands for a whole level at all registers, its points carry
the register and the unit of weight they belong to, and points above the weight are passed
over.  Points come in order of time, and a process ends once it is later than the
document's last register: most shingles need one or two points instead of one per register.

Registers are cut into bands; documents that agree in a band are candidates.  Candidates
are verified on their whole multisets, and verified links make the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescompass.llm.components import components, connected, joining
from salescompass.llm.storage import stored
from salescompass.llm.words import Words, byte_texts, lists, mix, pieces, unit

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 6  # a pair of similarity 0.8 shares no band with a probability of 5e-6
SMALL_BAND = 8  # members that are compared as pairs
ROUNDS = 3  # times that members outside their bands' largest components are compared with one member of it
PIECE = 500_000  # bytes of text whose shingles a task holds at once
BLOCK = 256  # documents on each side that are compared in one task
VERIFIED = 300  # pairs whose texts a task holds besides the batch they come in
PAIRS_AT_ONCE = 200_000  # pairs of equal shingles that a comparison of blocks holds
BATCH_BYTES = 8_000_000  # texts that come to a task at once


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight of the distinct shingles, sorted by text and shingle.

    A text of fewer than ``size`` words is one shingle.
    """
    counts = words.counts
    found = []
    for length in range(1, size + 1):
        at, hashes = words.windows(length)
        text = np.searchsorted(words.first, at, side="right") - 1
        keep = slice(None) if length == size else counts[text] == length
        found.append((text[keep], hashes[keep]))
    text, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    return text[begin], hashes[begin], np.diff(np.append(begin, len(text)))


def bag_min_hash(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """n x registers: the first point of each register, as a number that identifies the point."""
    seeds, of, width, allowed = [], [], [], []
    level, low = 0, 0
    while True:  # the level (low, high] of all shingles that reach it
        high = max(1, 2 * low)
        reach = weights > low
        if not reach.any():
            break
        seeds.append(mix(hashes[reach], 101 + level))
        of.append(text[reach])
        width.append(np.full(len(of[-1]), high - low))
        allowed.append(np.minimum(weights[reach], high) - low)
        level, low = level + 1, high
    first = np.full(n * registers, np.inf)
    point = np.zeros(n * registers, np.uint64)
    if not seeds:
        return point.reshape(n, registers)
    seeds, of, width, allowed = (np.concatenate(x) for x in (seeds, of, width, allowed))
    time = np.zeros(len(seeds))
    turn = 0
    while len(seeds):
        raw = mix(seeds + np.uint64(turn * 0xD6E8FEB86659FD93 % 2**64))
        time = time - np.log(unit(raw)) / (registers * width)
        which = mix(raw, 211)
        place = of * registers + (which % np.uint64(registers)).astype(np.int64)
        ours = ((which >> np.uint64(32)) % width.astype(np.uint64)).astype(np.int64) < allowed
        better = np.flatnonzero(ours & (time < first[place]))
        np.minimum.at(first, place[better], time[better])
        won = better[time[better] == first[place[better]]]
        point[place[won]] = which[won]
        turn += 1
        if turn < 4 or turn % 8 == 0:
            alive = time < first.reshape(n, registers).max(axis=1)[of]
            seeds, of, width, allowed, time = (x[alive] for x in (seeds, of, width, allowed, time))
    return point.reshape(n, registers)


def _sketch(bands: int, rows: int, size: int):
    def sketch(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for low, high in pieces(texts, PIECE):
                words = Words(texts[low:high])
                n = high - low
                text, hashes, weights = shingles(words, size)
                points = bag_min_hash(text, hashes, weights, n, bands * rows)
                keys = np.empty((n, bands), np.uint64)
                for b in range(bands):
                    key = np.full(n, b, np.uint64)
                    for column in points[:, b * rows : (b + 1) * rows].T:
                        key = mix(key ^ column, 307)
                    keys[:, b] = key
                total = np.bincount(text, weights, minlength=n).astype(np.int64)
                full = total > 0  # a text without words has no bands
                sums = []
                for seed in (401, 409):  # order-free 128-bit identity of the multiset
                    sums.append(np.zeros(n, np.uint64))
                    np.add.at(sums[-1], text, mix(hashes, seed) * weights.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[low:high], batch.column("text_hash")[low:high],
                        *[pa.array(s.view(np.int64), pa.int64()) for s in sums], pa.array(total, pa.int64()),
                        lists(keys[full].ravel().view(np.int64), np.concatenate([[0], np.cumsum(full * bands)]), pa.int64()),
                    ],
                    names=["doc_id", "text_hash", "content_1", "content_2", "size", "bands"],
                )

    return sketch


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, each as sorted keys and weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 1.0


def _verify(similarity: float, size: int):
    def verify(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for begin in range(0, batch.num_rows, VERIFIED):
                some = batch.slice(begin, VERIFIED)
                left, right = byte_texts(some.column("text_a")), byte_texts(some.column("text_b"))
                for low, high in pieces(left, PIECE):
                    distinct = list({t or b"": None for t in left[low:high] + right[low:high]})
                    bags = dict(zip(distinct, _bags(distinct, size), strict=True))
                    for i in range(low, high):
                        keep[begin + i] = overlap(bags[left[i] or b""], bags[right[i] or b""]) >= similarity
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return verify


def _links_of_blocks(similarity: float, size: int):
    def bags(table: pa.Table):
        found = [(low, shingles(Words(texts[low:high]), size)) for texts in [byte_texts(table.column("text"))] for low, high in pieces(texts, PIECE)]
        return tuple(np.concatenate(x) for x in zip(*((low + text, hashes, weights) for low, (text, hashes, weights) in found), strict=True))

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """Shared weight of all pairs of the two blocks, by looking up one side's shingles in the other's."""
        a, b = [], []
        if left.num_rows and right.num_rows:
            text, hashes, weights = bags(left)
            other, other_hashes, other_weights = bags(right)
            order = np.argsort(hashes, kind="stable")
            text, hashes, weights = text[order], hashes[order], weights[order]
            low, high = np.searchsorted(hashes, other_hashes), np.searchsorted(hashes, other_hashes, side="right")
            n = high - low
            shape = (left.num_rows, right.num_rows)
            shared = np.zeros(shape[0] * shape[1], np.int64)
            reached = np.cumsum(n)
            begin = 0
            while begin < len(n):  # near copies share most shingles: pairs of equal ones are taken in bounded steps
                end = max(begin + 1, int(np.searchsorted(reached, (reached[begin - 1] if begin else 0) + PAIRS_AT_ONCE, side="right")))
                source = np.repeat(np.arange(begin, end), n[begin:end])
                entry = low[source] + np.arange(len(source)) - np.repeat(reached[begin:end] - n[begin:end] - (reached[begin - 1] if begin else 0), n[begin:end])
                both = np.minimum(weights[entry], other_weights[source])
                shared += np.bincount(text[entry] * shape[1] + other[source], both, minlength=len(shared)).astype(np.int64)
                begin = end
            shared = shared.reshape(shape)
            sizes = np.bincount(text, weights, minlength=shape[0]), np.bincount(other, other_weights, minlength=shape[1])
            total = sizes[0][:, None] + sizes[1] - shared
            label, other_label = left.column("label").to_numpy(), right.column("label").to_numpy()
            node, other_node = left.column("node").to_numpy(), right.column("node").to_numpy()
            i, j = np.nonzero((shared >= similarity * total) & (label[:, None] != other_label))
            keep = joining(label[i], other_label[j])
            a, b = np.minimum(node[i[keep]], other_node[j[keep]]), np.maximum(node[i[keep]], other_node[j[keep]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _shingle_rows(size: int):
    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, texts = batch.column("node").to_numpy(), byte_texts(batch.column("text"))
            for low, high in pieces(texts, PIECE):
                text, hashes, weights = shingles(Words(texts[low:high]), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[low:high][text]), pa.array(hashes.view(np.int64)), pa.array(weights.astype(np.int64))], names=["node", "shingle", "weight"]
                )

    return rows


def _bags(texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for low, high in pieces(texts, PIECE):
        text, hashes, weights = shingles(Words(texts[low:high]), size)
        edge = np.searchsorted(text, np.arange(high - low + 1))
        for begin, end in zip(edge[:-1], edge[1:], strict=True):
            yield hashes[begin:end], weights[begin:end]


class NearDuplicates:
    """Classes of near-duplicate documents of ``docs (doc_id, text)``.

    Words are runs of bytes other than blanks; similarity is the weighted Jaccard similarity
    of the multisets of ``size``-word shingles.  Documents of equal multisets are one node.
    Null and empty texts have no shingles and equal each other only.  Rows that repeat a
    doc_id, or have none, are documents of their own.  Other columns are ignored.
    """

    def __init__(self, docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS):
        self.similarity, self.size = similarity, size
        text = F.col("text")
        self.texts = docs.select("doc_id", text, F.xxhash64(text).alias("text_hash"))
        kinds = (
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, "
            "content_1 long, content_2 long, size long, bands array<long>"
        )
        self.sketches = stored(self.texts.mapInArrow(_sketch(bands, rows, size), kinds), "sketches", BATCH_BYTES)
        nodes = self.sketches.groupBy("content_1", "content_2", "size").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("sample"), F.any_value("bands").alias("bands")
        )
        # numbered in a stored table, so that a node keeps its number
        self.nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        self.labels = self._labels()

    def _labels(self) -> DataFrame:
        """``node, label`` of the nodes that have a link.

        Every member is compared with one other, the centre of one of its bands; nearly all
        copies of a text join one component so.  From then on only bands that hold several
        components matter: their members outside the largest component are compared with one
        member of it.  What is left is compared completely, but for members of one component:
        pairs in small bands, blocks of members in larger ones, of which only links leave a task.
        """
        in_bands = self.nodes.select("node", "size", F.explode("bands").alias("key"))
        # stored, so that both sides of the join are plain exchanges, of which AQE can split a crowded key
        shared = stored(in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bands")
        members = stored(in_bands.join(shared, "key"), "members")
        texts = self._member_texts(members)
        # stored, so that a task does not hold one Python process to compare texts and another to join the links
        labels = components(stored(self._linked(self._pairs_with_centre(members, members, 0), texts), "verified", BATCH_BYTES))
        open_ = members.withColumn("own", F.lit(0).cast("long"))
        for turn in range(ROUNDS):
            open_ = stored(self._open(open_.select("key", "node", "size", "n", "own"), labels), "open")
            if open_.isEmpty():
                return labels
            if not turn:
                open_ = stored(open_.drop("own").join(self._own_weights(open_, texts), "node"), "open")
            pairs = self._pairs_with_centre(open_.filter("outside"), open_.filter("label = largest"), turn + 1)
            labels = connected(labels, self._linked(pairs, texts))
        open_ = stored(self._open(open_.select("key", "node", "size", "n", "own"), labels), "open")
        if open_.isEmpty():
            return labels
        small = self._linked(self._small_pairs(open_.filter(F.col("n") <= SMALL_BAND)), texts)
        return connected(labels, small.union(self._links_outside(open_.filter(F.col("n") > SMALL_BAND), texts)))

    def _member_texts(self, members: DataFrame) -> DataFrame:
        """``node, text`` of all candidates, once; copies of a row count once."""
        wanted = self.nodes.join(members.select("node").distinct(), "node").select(
            "node", F.col("sample.doc_id").alias("id"), F.col("sample.text_hash").alias("hash")
        )
        same = self.texts["doc_id"].eqNullSafe(wanted["id"]) & self.texts["text_hash"].eqNullSafe(wanted["hash"])
        held = self.texts.join(wanted, same).groupBy("id", "hash", "node").agg(F.first("text").alias("text"))
        return stored(held.select("node", "text"), "texts")

    def _open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of bands that are not yet settled, marked ``outside`` if they are not in their
        band's largest component and could still be similar to some member.

        ``own`` is the weight of a member's shingles that no other open member has.  What it
        shares is at most the rest, so by size it cannot reach the similarity with any
        member of a band if it cannot with the smallest one.
        """
        labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        sizes = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.min("size").alias("least"))
        bands = sizes.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.min("least").alias("least"), F.count(F.lit(1)).alias("parts"))
        bands = bands.filter("parts > 1").select("key", F.col("top.label").alias("largest"), "least")
        least = F.greatest(F.col("least"), F.col("size") * self.similarity)
        marked = labelled.join(bands, "key").withColumn("outside", (F.col("label") != F.col("largest")) & self._enough("size", "own", least))
        unsettled = marked.groupBy("key").agg(F.max("outside").alias("any")).filter("any").select("key")
        return marked.join(unsettled, "key").select("key", "node", "size", "n", "own", "label", "largest", "outside")

    def _enough(self, size: str, own: str, other) -> Column:
        """Whether what a document can share suffices for the similarity with one of size ``other``."""
        return F.col(size) - F.col(own) >= self.similarity / (1 + self.similarity) * (F.col(size) + other) - 1e-6

    def _own_weights(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """``node, own``: weight of the shingles that occur in no other of the members."""
        held = texts.join(members.select("node").distinct(), "node")
        rows = held.mapInArrow(_shingle_rows(self.size), "node long, shingle long, weight long")
        single = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight")).filter("n = 1")
        own = single.groupBy("node").agg(F.sum("weight").alias("own"))
        return held.select("node").join(own, "node", "left").select("node", F.coalesce("own", F.lit(0)).cast("long").alias("own"))

    def _near(self) -> Column:
        return F.least("size", "size_b") >= self.similarity * F.greatest("size", "size_b") - 1e-6

    def _small_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs of different components in a band, one of them outside the largest."""
        other = members.select("key", F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("label").alias("label_b"), F.col("outside").alias("outside_b"))
        apart = (F.col("node") < F.col("b")) & (F.col("label") != F.col("label_b")) & (F.col("outside") | F.col("outside_b"))
        return members.join(other, "key").filter(apart & self._near()).select(F.col("node").alias("a"), "b").distinct()

    def _pairs_with_centre(self, some: DataFrame, members: DataFrame, turn: int) -> DataFrame:
        """Each of some members with the centre of one of its bands; the centre is the member of the turn's smallest hash."""
        least = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("hash"), F.col("node").alias("b"), F.col("size").alias("size_b")))
        centres = stored(members.groupBy("key").agg(least.alias("c")).select("key", "c.*"), "centres")
        pairs = some.join(centres, "key").filter((F.col("node") != F.col("b")) & self._near())
        one = pairs.groupBy("node").agg(F.min(F.struct("hash", "b")).alias("c")).select("node", "c.b")
        return one.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()

    def _links_outside(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Links of the members outside the largest component of their band to members of other
        components: one to each component suffices.

        Both sides of a band are cut into blocks; a task compares two blocks, so a band of any
        size is spread and no pair is ever a row.
        """
        counts = members.groupBy("key").agg(F.count_if("outside").alias("o"), F.count(F.lit(1)).alias("m"))
        blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
        own = lambda c: F.pmod(F.xxhash64("node"), blocks(c)).cast("int")
        every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
        open_ = members.join(counts.filter("o > 0"), "key").join(texts, "node")
        columns = ["key", "node", "label", "text"]
        left = open_.filter("outside").select(*columns, own("o").alias("ob"), every("m").alias("mb"))
        # names given anew, as both sides come from one table
        right = open_.select(*columns, own("m").alias("mb"), every("o").alias("ob")).toDF(*columns, "mb", "ob")
        by = ["key", "ob", "mb"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_links_of_blocks(self.similarity, self.size), "a long, b long")

    def _linked(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "text_a", "text_b").mapInArrow(
            _verify(self.similarity, self.size), "a long, b long"
        )

    def _known(self) -> DataFrame:
        """Nodes with the number of their class."""
        return self.nodes.drop("bands").join(self.labels, "node", "left").withColumn("class", F.coalesce("label", "node"))

    def classes(self) -> DataFrame:
        """A row per document: ``doc_id, class_id``, the smallest doc_id of its class."""
        known = self._known()
        first = known.groupBy("class").agg(F.min("sample.doc_id").alias("class_id"))
        # stored, so that a crowded content can be split by AQE
        of_node = stored(known.select("content_1", "content_2", "size", "class").join(first, "class"), "class-ids")
        return self.sketches.join(of_node, ["content_1", "content_2", "size"]).select("doc_id", "class_id")

    def kept(self) -> DataFrame:
        """``doc_id, text_hash`` of the document that stays of each class, the one of the smallest doc_id."""
        least = F.min("sample").alias("sample")
        return self._known().groupBy("class").agg(least).select("sample.doc_id", "sample.text_hash")


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class, with its own columns."""
    kept = NearDuplicates(docs.select("doc_id", "text"), **settings).kept().select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")
    )
    # all own columns in one, so that none can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(kept["id"]) & F.xxhash64("doc.text").eqNullSafe(kept["hash"])
    # rows that repeat both doc_id and text: the first stays
    return rows.join(kept, same).groupBy("id", "hash").agg(F.first("doc").alias("doc")).select("doc.*")
