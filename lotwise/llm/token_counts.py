"""Token counts kept as a rollup of signed changes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete, filesystem
from .textkit import BLANKS, batches, word_pieces, words_of

KEYS = ("source", "lang", "tokenizer")


COUNTS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


class TokenRollup:
    """Totals of documents and tokens by source, language and tokenizer version, in a folder of the shared store.

    A batch of changes has a row (source, lang, tokenizer, n_tokens, sign) per change: sign 1 inserts a document's count,
    -1 takes it back, and a revised count is one row of each. `commit` sums a batch to one row per key (partly before the
    shuffle, so a source with most rows is one row per task), writes it beside the store and moves it to the batch's name
    in one step that fails where the name is taken. So a batch counts once, whole or not at all: a failed attempt leaves
    nothing that `totals` reads, and of two writers of one batch the later changes nothing.

    `compact` maintains the totals: it adds all batches that the newest totals lack to them and moves sums and the names of
    what they hold, as one folder, to the next number, again exclusively. Batches go only after that, so one that dies
    anywhere loses nothing and counts nothing twice; and they go one compaction later, with the totals before, so a
    result of `totals` can be read while and after the rollup is compacted once. Names of batches ever held are a table
    that is only asked about the batches at hand. Null keys are groups of their own; a null count is zero tokens; an
    empty batch is valid and changes nothing. Batch names are those of folders."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _names(self, kind: str) -> list[str]:
        fs, p = filesystem(self.spark, f"{self.path}/{kind}=*")
        return sorted(x.getPath().getName().split("=", 1)[1] for x in fs.globStatus(p) or [])

    def _move(self, attempt: str, name: str) -> bool:
        """True if the attempt's folder has got the name; false, and the attempt is deleted, if another had it before."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        hadoop = jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(attempt), hadoop.Path(f"{self.path}/{name}")
        options = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            hadoop.FileContext.getFileContext(source.toUri(), conf).rename(source, target, options)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            delete(self.spark, attempt)
            return False

    def _number(self) -> int:
        """Of the newest totals; 0 without any."""
        return max(map(int, self._names("total")), default=0)

    def _names_in(self, number: int) -> DataFrame:
        """Names of the batches in totals."""
        rows = self.spark.read.schema("batch string")
        return rows.parquet(f"{self.path}/total={number}/batches") if number else self.spark.createDataFrame([], "batch string")

    def _held(self, number: int, names: list[str]) -> set[str]:
        """Those of the batches that totals hold."""
        return {r.batch for r in self._names_in(number).filter(F.col("batch").isin(names)).collect()} if number and names else set()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """True if the batch was new."""
        if batch_id in self._names("batch") or self._held(self._number(), [batch_id]):
            return False
        attempt = f"{self.path}/attempt-{uuid.uuid4().hex}"
        delta = changes.groupBy(*KEYS).agg(F.sum(F.col("sign").cast("long")).alias("n_docs"), F.sum(F.coalesce(F.col("n_tokens"), F.lit(0)) * F.col("sign")).cast("long").alias("n_tokens"))
        delta.write.parquet(attempt)
        return self._move(attempt, f"batch={batch_id}")

    def _summed(self, number: int, batches: list[str]) -> DataFrame:
        paths = [f"{self.path}/batch={b}" for b in batches] + ([f"{self.path}/total={number}/sums"] if number else [])
        rows = self.spark.read.schema(COUNTS).parquet(*paths) if paths else self.spark.createDataFrame([], COUNTS)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """True if the totals have been brought up to the batches committed so far."""
        number, names = self._number(), self._names("batch")
        held = self._held(number, names)
        new = [b for b in names if b not in held]
        if new:
            attempt = f"{self.path}/attempt-{uuid.uuid4().hex}"
            self._summed(number, new).write.parquet(f"{attempt}/sums")
            added = self.spark.createDataFrame([(b,) for b in new], "batch string")
            self._names_in(number).unionByName(added).hint("rebalance").write.parquet(f"{attempt}/batches")
            if not self._move(attempt, f"total={number + 1}"):
                return False
            number += 1
        # What the totals before these held already is read by no result that was asked for since.
        for name in [f"batch={b}" for b in held] + [f"total={n}" for n in self._names("total") if int(n) < number - 1]:
            delete(self.spark, f"{self.path}/{name}")
        return True

    def totals(self) -> DataFrame:
        """The newest totals and the batches committed since. Keys whose documents are all taken back are left out."""
        number, names = self._number(), self._names("batch")
        held = self._held(number, names)
        return self._summed(number, [b for b in names if b not in held])


def changes(new: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Signed changes from an old to a new table of counts: every row of `new` is inserted and every row of `old` taken
    back, so rows in both cancel out and a revised one leaves its difference. Other columns are not read. A document that
    stands twice in a table counts twice; null keys and counts go through as they are."""
    cols = ["source", "lang", "tokenizer", "n_tokens"]
    insert = new.select(*cols, F.lit(1).alias("sign"))
    if old is None:
        return insert
    return insert.unionByName(old.select(*cols, F.lit(-1).alias("sign")))


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, lang, digest, n_words, n_pieces) of every whole text: white-space words and ids of the tokenizer.
    A null text has no words; `digest` tells texts apart."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_pieces(tokenizer)
        for batch in batches(it):
            text = batch.column("text")
            _, _, _, first = words_of(text, BLANKS)
            _, at = encoder.encode(text)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "source", "lang", "digest")] + [pa.array(np.diff(first)), pa.array(np.diff(at))], ["doc_id", "source", "lang", "digest", "n_words", "n_pieces"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "source", "lang", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"), "text").mapInArrow(run, f"doc_id {kind}, source string, lang string, digest string, n_words long, n_pieces long")
