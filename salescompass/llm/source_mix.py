"""Mixing sources to target weights, with DataFrame operations only.

Each source's words form one stream in document order, cut into blocks of fixed length.
The mix is a number of output shards.  How many blocks it takes of a source is fixed by the
target; how many of them a shard holds is drawn, a multinomial count.  The slots of a source are
numbered over all shards, and slot j takes block ``permutation(j mod blocks)`` of pass
``j div blocks``, so a source is used up once in random order before any of its blocks comes again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescompass.llm.permute import with_permuted
from salescompass.llm.storage import stored, unused
from salescompass.operators.rows import number_rows

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # by code point order of the sources, repeating
DRAWS_PER_ROW = 4096  # draws that one row stands for until they are spread over tasks


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each source: its share by weight of ``budget`` times all words, no more than
    ``most`` times its own; what is cut off goes to the others by weight.

    ``sizes`` has a row per ``source`` with its ``source_size``.  The answer is
    min(most x size, level x weight) with one level for all.  The shares' total as a
    function of the level is concave and made of straight pieces, one for each number of
    sources that are cut off (in the order of size / weight); the level sought is therefore the largest at
    which any piece reaches the budget.  Sources are numbered and summed up in range partitions,
    whatever their number; one task holds a row per part.
    """
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("no"), F.lit(len(weights))))
    limit = most * F.col("source_size")
    last = unused("_last", sizes)
    numbered = number_rows(sizes.withColumn(last, F.col("source").isNull()), last, "source", name="no").drop(last)
    ranked = numbered.withColumn("no", F.col("no").cast("int")).withColumn("weight", weight).withColumn("ratio", limit / F.col("weight"))
    ranked = stored(sums_before(ranked, ["ratio", "no"], cut=limit, passed=F.col("weight")), "mix-ranked")
    words, heavy = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    piece = (budget * F.lit(words or 0) - F.col("cut")) / (F.lit(heavy or 0.0) - F.col("passed"))
    level = ranked.agg(F.max(piece)).first()[0] or 0.0
    return ranked.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")).cast("double")).select(
        "no", "source", "source_size", "weight", "target"
    )


def sums_before(df: DataFrame, order: list[str], **sums: Column) -> DataFrame:
    """Adds the sum of each column over all rows before, in the order of ``order``.

    Range partitions are summed on their own and shifted by the parts before them, as in
    ``stream_positions``; only a row per part goes into one task.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-order")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    shift = totals.select("_part", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    out = parts.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}).join(F.broadcast(shift), "_part")
    return out.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_part", *[f"_{n}" for n in sums])


def source_draws(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Blocks that the whole mix takes from each source: ``no, total``.

    The target divided by the mean words of the source's blocks (the last may be short); the
    fraction left gives one draw more with its probability.  So no draw lies beyond the passes
    that the target allows.
    """
    blocks = F.ceil(F.col("source_size") / block)
    draws = F.coalesce(F.col("target") * blocks / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    uniform = F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), F.col("no")), F.lit(1 << 52)) / float(1 << 52)
    whole = F.floor(F.col("draws") + 1e-9)
    total = (whole + (uniform < F.col("draws") - whole).cast("int")).cast("long")
    return sources.withColumn("draws", draws).select("no", total.alias("total"))


def _each(rows: DataFrame, count: str) -> DataFrame:
    """Rows with a number below their ``count`` as ``draw``: in chunks, so that many tasks share a large source."""
    chunks = F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / DRAWS_PER_ROW).cast("long") - 1)
    low = F.col("chunk") * DRAWS_PER_ROW
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.filter(F.col(count) > 0).withColumn("chunk", F.explode(chunks))
    # a number given keeps AQE from joining these few bytes, each of which makes many rows
    spread = spread.repartition(partitions, *[c for c in ("no", "chunk", "shard") if c in spread.columns])
    return spread.withColumn("draw", F.explode(F.sequence(low, F.least(F.col(count), low + DRAWS_PER_ROW) - 1))).drop("chunk")


def shard_counts(draws: DataFrame, shards: int, seed: int) -> DataFrame:
    """Multinomial counts ``no, shard, count`` of a source's draws in the output shards.

    Every draw falls on a shard by a hashed uniform number of its own, and only the counts leave a task.
    """
    uniform = F.xxhash64(F.lit(seed), F.lit("shard"), F.col("no"), F.col("draw"))
    return _each(draws, "total").groupBy("no", F.pmod(uniform, F.lit(shards)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("count"))


def stream_positions(docs: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``start``: words of the same source (``no``) before the document.

    Range partitions by source and order cut a large source into many parts; each part is
    summed on its own and shifted by the parts before it.
    """
    keys = ["no", *order]
    parts = stored(docs.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "mix-parts")
    before = Window.partitionBy("no").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("no", "_part").agg(F.sum("size").alias("_sum"))
    shift = sums.select("no", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("no", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(shift, ["no", "_part"])
        .withColumn("start", F.col("_shift") + F.col("_inside"))
        .drop("_part", "_inside", "_shift")
    )


class Mix:
    """A mix of ``docs``: what it takes of each document, and the plan of its shards.

    docs         ``doc_id``, ``text``, ``source``; any further columns are ignored here
    block        words of a block
    shards       output shards
    row          a number that identifies each row (default: one given here)

    Null texts have no words.  A null source is a source of its own, ordered last.  Rows
    that repeat a doc_id are documents of their own; equal rows are interchangeable.  An
    empty table, or one without words, takes nothing.
    """

    def __init__(self, docs: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: float = 2.0, block: int = 32, shards: int = 8, seed: int = 0, row: Column | None = None):
        self.block, self.seed = block, seed
        sized = stored(
            docs.select(
                "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"),
                (F.monotonically_increasing_id() if row is None else row).alias("row"),
            ),
            "mix-sizes",
        )
        sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
        # a row per source, so small that Spark broadcasts it by its file size
        self.sources = stored(source_targets(sources, weights, budget, most), "mix-sources")
        known = sized.join(self.sources, sized["source"].eqNullSafe(self.sources["source"])).drop(self.sources["source"])
        self.docs = stored(stream_positions(known, ["doc_id", "tie"]), "mix-docs")
        counts = stored(shard_counts(source_draws(self.sources, block, seed), shards, seed), "mix-counts")
        self.plan = self._plan(counts)

    def _plan(self, counts: DataFrame) -> DataFrame:
        """``no, shard, draw, pass, block``: a row per drawn block."""
        earlier = Window.partitionBy("no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        blocks = self.sources.select("no", F.ceil(F.col("source_size") / self.block).cast("long").alias("blocks")).filter("blocks > 0")
        slots = counts.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0))).join(blocks, "no")  # a row per source and shard
        draws = _each(slots, "count").withColumn("draw", F.col("first") + F.col("draw"))
        draws = draws.withColumn("pass", F.floor(F.col("draw") / F.col("blocks")).cast("int"))
        slot = F.pmod("draw", "blocks")
        return with_permuted(draws, "block", slot, F.col("blocks"), F.lit(self.seed), F.col("no"), F.col("pass")).select("no", "shard", "draw", "pass", "block")

    def pieces(self) -> DataFrame:
        """The words taken: ``row, pass, low, high`` counted within the document, ``high`` excluded."""
        last = F.floor((F.col("start") + F.col("size") - 1) / self.block)
        of = self.docs.filter("size > 0").select(
            "row", "no", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / self.block), last)).alias("block")
        )
        low = F.greatest(F.col("block") * self.block - F.col("start"), F.lit(0))
        high = F.least((F.col("block") + 1) * self.block - F.col("start"), F.col("size"))
        # the plan's rows come from few bytes, which must not be taken for a small table
        return of.join(self.plan.hint("merge"), ["no", "block"]).select("row", "pass", low.alias("low"), high.alias("high"))

    def taken(self) -> DataFrame:
        """A row per document: ``doc_id, source, size, source_size, target, taken``."""
        taken = self.pieces().groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
        return self.docs.join(taken, "row", "left").select(
            "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
        )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as documents: a row for each pass that takes words of a document.

    A row holds the words that its pass takes, or the text unchanged if that is all of
    them.  ``n_chars``, where there is one, follows the text.  Other columns are kept.
    """
    # all own columns in one, so that none can clash
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = stored(docs.select(own.alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-input")
    mix = Mix(marked.select("row", "doc.doc_id", "doc.source", "doc.text"), row=F.col("row"), **settings)
    spans = mix.pieces().groupBy("row", "pass").agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"), F.sum(F.col("high") - F.col("low")).alias("taken")
    )
    cut = F.flatten(F.transform("spans", lambda s: F.slice("words", (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int"))))
    out = (
        marked.join(spans, "row")
        .withColumn("words", F.regexp_extract_all("doc.text", F.lit(WORD), F.lit(0)))
        .withColumn("mixed", F.when(F.col("taken") == F.size("words"), F.col("doc.text")).otherwise(F.array_join(cut, " ")))
    )
    new = {"text": F.col("mixed"), "n_chars": F.length("mixed")}
    return out.select(
        *[
            (new[f.name].cast(f.dataType) if f.name in new else F.col("doc").getField(f.name)).alias(f.name)
            for f in docs.schema.fields
        ]
    )
