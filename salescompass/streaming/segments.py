"""A search index that follows its documents: immutable segments, tombstones, merged statistics.

Every batch of changes is a segment of its own, and no file of an earlier one is touched:

    documents/segment=low-high   the indexed documents that came or changed
    dead/segment=low-high        ids that the batch changed or deleted: their rows in earlier segments no longer count
    terms/segment=low-high       documents gained and lost by each term
    corpus/segment=low-high      documents and words gained and lost, and the end of the segment

The statistics of the index are the sums over its segments.  A segment counts once its ``corpus`` is
written; a batch that is run again replaces its own.  When there are more than ``most`` segments
they are merged into one, named by the batches it covers; it replaces the others when it is
finished, and they are deleted with the next batch, when no reader can be left that planned with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salescompass.operators.search import Index, index_documents
from salescompass.streaming.refresh import _delete, _finished, _folders

MOST_SEGMENTS = 8
PARTS = ("documents", "dead", "terms", "corpus")


class SegmentedIndex:
    """Search index of documents (``doc_id``, ``text``, attributes) in folder ``root``.

    Changes are rows of these columns, with ``deleted`` (boolean) and ``at``, which orders the
    changes of one document; the last one in a batch counts.  A deletion of an unknown document
    does nothing.  Rows without an id are ignored.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, most: int = MOST_SEGMENTS):
        self.spark, self.root, self.most = spark, root, most
        self.columns = [f.name for f in schema if f.name not in ("deleted", "at")]
        self.id_type = schema["doc_id"].dataType
        self.indexed = index_documents(spark.createDataFrame([], T.StructType([schema[c] for c in self.columns]))).schema

    # -- segments --------------------------------------------------------------------
    def _path(self, part: str, name: str) -> str:
        return f"{self.root}/{part}/segment={name}"

    def segments(self, below: int = 2**62) -> list[str]:
        """Names of the finished segments that stand for the batches below, oldest first."""
        done = [n for n, path in _folders(self.spark, f"{self.root}/corpus", "segment").items() if _finished(self.spark, path)]
        spans = sorted((tuple(map(int, n.split("-"))) for n in done), key=lambda s: (s[0], -s[1]))
        out: list[tuple[int, int]] = []
        for low, high in spans:
            if high < below and (not out or high > out[-1][1]):  # one inside another is replaced by it
                out.append((low, high))
        return [f"{low:09d}-{high:09d}" for low, high in out]

    def _read(self, part: str, names: list[str], schema: T.StructType) -> DataFrame:
        """A part of some segments, with ``high``, the last batch of each row's segment."""
        if not names:
            return self.spark.createDataFrame([], schema).withColumn("high", F.lit(0).cast("long"))
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("segment", T.StringType())])).option("basePath", f"{self.root}/{part}")
        rows = rows.parquet(*[self._path(part, n) for n in names])
        return rows.withColumn("high", F.substring_index("segment", "-", -1).cast("long")).drop("segment")

    def live(self, names: list[str]) -> DataFrame:
        """The documents that no later segment has changed or deleted."""
        ids = T.StructType([T.StructField("doc_id", self.id_type)])
        dead = self._read("dead", names, ids).groupBy("doc_id").agg(F.max("high").alias("killed"))
        rows = self._read("documents", names, self.indexed).join(dead, "doc_id", "left")
        return rows.filter(F.col("killed").isNull() | (F.col("high") >= F.col("killed"))).select(*self.indexed.names)

    def _terms(self, names: list[str]) -> DataFrame:
        terms = T.StructType([T.StructField("term", T.StringType()), T.StructField("df", T.LongType())])
        return self._read("terms", names, terms).groupBy("term").agg(F.sum("df").alias("df")).filter("df <> 0")

    def _corpus(self, names: list[str]) -> DataFrame:
        corpus = T.StructType([T.StructField("docs", T.LongType()), T.StructField("words", T.LongType())])
        return self._read("corpus", names, corpus).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in corpus.names])

    def view(self) -> Index:
        """The index as of the newest finished segment."""
        names = self.segments()
        corpus = self._corpus(names).select("docs", (F.col("words").cast("double") / F.nullif("docs", F.lit(0))).alias("avg_len"))
        return Index(self.live(names), self._terms(names), corpus)

    # -- changes ---------------------------------------------------------------------
    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Take a batch of changes as a segment of its own."""
        earlier, name = self.segments(below=batch_id), f"{batch_id:09d}-{batch_id:09d}"
        rest = [c for c in changes.columns if c not in ("doc_id", "at")]
        last = changes.filter("doc_id is not null").groupBy("doc_id").agg(F.max_by(F.struct(*rest), "at").alias("c"))
        last = last.select("doc_id", "c.*")
        last.select("doc_id").write.mode("overwrite").parquet(self._path("dead", name))
        new = index_documents(last.filter(~F.col("deleted")).select(*self.columns))
        new.write.mode("overwrite").parquet(self._path("documents", name))
        gained = self._read("documents", [name], self.indexed)
        touched = self.spark.read.schema(T.StructType([T.StructField("doc_id", self.id_type)])).parquet(self._path("dead", name))
        lost = self.live(earlier).join(touched, "doc_id", "left_semi")
        counted = gained.select("terms", "doc_len", F.lit(1).alias("by")).union(lost.select("terms", "doc_len", F.lit(-1).alias("by")))
        terms = counted.select(F.explode("terms").alias("term"), "by").groupBy("term").agg(F.sum("by").cast("long").alias("df")).filter("df <> 0")
        terms.write.mode("overwrite").parquet(self._path("terms", name))
        corpus = counted.agg(
            F.coalesce(F.sum("by"), F.lit(0)).cast("long").alias("docs"), F.coalesce(F.sum(F.col("by") * F.col("doc_len")), F.lit(0)).cast("long").alias("words")
        )
        corpus.write.mode("overwrite").parquet(self._path("corpus", name))
        self._drop_replaced(batch_id)
        if len(self.segments()) > self.most:
            self.compact()

    def compact(self) -> None:
        """Merge the segments into one: live documents only, no tombstones, summed statistics."""
        names = self.segments()
        if len(names) < 2:
            return
        name = f"{names[0].partition('-')[0]}-{names[-1].partition('-')[2]}"
        self.live(names).write.mode("overwrite").parquet(self._path("documents", name))
        ids = T.StructType([T.StructField("doc_id", self.id_type)])
        self.spark.createDataFrame([], ids).write.mode("overwrite").parquet(self._path("dead", name))
        self._terms(names).write.mode("overwrite").parquet(self._path("terms", name))
        self._corpus(names).write.mode("overwrite").parquet(self._path("corpus", name))

    def _drop_replaced(self, batch_id: int) -> None:
        """Delete segments that lie within a merged one of earlier batches; the end marks go first."""
        kept = self.segments()
        for part in reversed(PARTS):
            for name, path in _folders(self.spark, f"{self.root}/{part}", "segment").items():
                if name not in kept and int(name.partition("-")[2]) < batch_id:
                    _delete(self.spark, path)


def index_stream(changes: DataFrame, index: SegmentedIndex, checkpoint: str, lag: str | None = None) -> StreamingQuery:
    """Keep an index over a stream of changes, at most once per ``lag``; without one the query takes what is there and stops."""
    trigger = {"processingTime": lag} if lag else {"availableNow": True}
    return changes.writeStream.foreachBatch(index.apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()
