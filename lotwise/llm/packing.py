"""Packing: all documents' tokens are laid end to end and cut every `window` tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Staged
from .textkit import batches, word_pieces

#: Partition totals of 16 bytes each are broadcast up to this many partitions; beyond it they are joined by a shuffle.
MAX_BROADCAST_PARTS = 1_000_000


def tokenised(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, eos_id: int) -> DataFrame:
    """Rows of (doc_id, part, before, n_tokens, ids): `ids` is a document's token ids with `eos_id` at its end, as
    little-endian unsigned 32-bit numbers, and `before` the tokens that its own task has already emitted."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = word_pieces(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches(it):
            ids, at = encoder.encode(batch.column("text"))
            n = np.diff(at) + 1
            whole = np.insert(ids, at[1:], eos_id).astype("<u4")
            stops = np.concatenate([[0], np.cumsum(n)])
            blobs = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(stops * 4), pa.py_buffer(whole)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.full(len(n), part, np.int64)), pa.array(before + stops[:-1]), pa.array(n), blobs], ["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(stops[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, part long, before long, n_tokens long, ids binary")


def pack(docs: DataFrame, *, window: int = 2048, tokenizer: str | None = None, eos_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of sequences of `window` tokens.

    Pass one tokenises each document once, where it is read, into a table in the shared folder, with the tokens before it
    in its task. Pass two sums the tasks' totals into offsets and cuts: token p of the corpus is at p % window of
    sequence p // window, so only the last sequence is not full. Documents that cross a cut give a piece on either side.

    Every row gives its own pieces, whatever its id (null and repeated ids too). A null or empty text is one token, `eos_id`.
    An empty table gives no piece. Other columns are not read."""
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    table = Staged(spark, "packing").write("tokens", tokenised(docs, id_col, text_col, tokenizer, eos_id))
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    offsets = totals.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("offset"))
    offsets = F.broadcast(offsets) if totals.count() <= MAX_BROADCAST_PARTS else offsets
    begin = F.col("offset") + F.col("before")
    placed = table.join(offsets, "part").select("doc_id", "n_tokens", "ids", begin.alias("begin"))

    def piece(k):
        lo = F.greatest(k * window, F.col("begin"))
        hi = F.least((k + 1) * window, F.col("begin") + F.col("n_tokens"))
        start = lo - F.col("begin")
        ids = F.substring("ids", (start * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int"))
        return F.struct(start.alias("start"), (hi - lo).alias("length"), F.col("n_tokens").alias("doc_tokens"), k.alias("sequence_id"), (lo - k * window).alias("offset"), ids.alias("ids"))

    windows = F.sequence(F.expr(f"begin div {window}"), F.expr(f"(begin + n_tokens - 1) div {window}"))
    return placed.select("doc_id", F.explode(F.transform(windows, piece)).alias("piece")).select("doc_id", "piece.*")
