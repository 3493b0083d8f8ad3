"""Repeated passages by level-wise doubling: windows that repeat between documents at one length are the only ones looked at
at twice that length, until the wanted length is reached or none is left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged
from .textkit import BLANKS, batches, hash_words, mix, window_hashes, words_of

#: Levels begin at the least half of half ... of the wanted length that has this many words or more.
SHORTEST = 6
_SECOND = np.uint64(0xD1B54A32D192ED03)
_ROW = np.uint64(0x9E3779B97F4A7C15)


def lengths(words: int) -> list[int]:
    """Window lengths of the levels, the shortest first. Each is twice the one before it, or twice less one word."""
    out = [words]
    while (out[0] + 1) // 2 >= SHORTEST:
        out.insert(0, (out[0] + 1) // 2)
    return out


def least_of(values: np.ndarray, size: int) -> np.ndarray:
    """For each place, that of a least of the `size` values from it on, which depends on these values alone."""
    least, at, step = values, np.arange(len(values)), 1
    while step < size:
        more = min(step, size - step)
        right = least[more:] < least[: len(least) - more]
        least, at = np.where(right, least[more:], least[: len(right)]), np.where(right, at[more:], at[: len(right)])
        step += more
    return at


class _Words:
    """Word hashes of a batch of texts, and windows that lie inside one text."""

    def __init__(self, text: pa.Array):
        self.data, self.starts, self.ends, self.first = words_of(text, BLANKS, lower=False)
        self.hashes = hash_words(self.data, self.starts, self.ends)

    def inside(self, size: int) -> np.ndarray:
        """Places where a window of `size` words begins."""
        lo, hi = self.first[:-1], self.first[1:] - size + 1
        edge = np.zeros(len(self.hashes) + 1, np.int64)
        fits = hi > lo
        np.add.at(edge, lo[fits], 1)
        np.add.at(edge, hi[fits], -1)
        return np.flatnonzero(np.cumsum(edge)[:-1] > 0)

    def row(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1

    def second(self, size: int) -> np.ndarray:
        """Another 64 bits of each window's hash."""
        return window_hashes(mix(self.hashes + _SECOND), size)


def _own(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Values of different rows made different, so that one look-up serves a whole batch."""
    return mix(values ^ (row.astype(np.uint64) + np.uint64(1)) * _ROW)


def _listed(batch: pa.RecordBatch, values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether each value stands in the list `alive` of its row."""
    alive = batch.column("alive")
    known = _own(alive.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), np.repeat(np.arange(batch.num_rows), alive.value_lengths().fill_null(0).to_numpy()))
    return np.isin(_own(values, row), known)


def _rows(batch: pa.RecordBatch, row: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """(h1, h2, doc_id) once for each value and row."""
    _, once = np.unique(_own(values[0], row), return_index=True)
    once.sort()
    cols = [pa.array(v[once].view(np.int64)) for v in values]
    return pa.RecordBatch.from_arrays([*cols, batch.column("doc_id").take(pa.array(row[once]))], [*[f"h{k + 1}" for k in range(len(cols))], "doc_id"])


def seeds(docs: DataFrame, size: int, within: int) -> DataFrame:
    """(h1, doc_id): windows of `size` words at content-selected places, one at least in each window of `within` words."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            words = _Words(batch.column("text"))
            grams, at = window_hashes(words.hashes, size), words.inside(within)
            places = np.unique(least_of(grams, within - size + 1)[at]) if len(at) else at
            yield _rows(batch, words.row(places), grams[places])

    return docs.select("doc_id", "text").mapInArrow(run, "h1 long, doc_id long")


def extended(docs: DataFrame, size: int, twice: int, seeded: bool) -> DataFrame:
    """(h1, h2, doc_id): windows of `twice` words whose parts of `size` words are `alive`, the hashes of their document's
    windows that repeat: both halves, or, on the first level (`seeded`), the part at the content-selected place."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            words = _Words(batch.column("text"))
            grams, at = window_hashes(words.hashes, size), words.inside(twice)
            if not len(at):
                continue
            row = words.row(at)
            chosen = least_of(grams, twice - size + 1) if seeded else None
            for offset in [0] if seeded else [0, twice - size]:
                again = _listed(batch, grams[chosen[at] if seeded else at + offset], row)
                at, row = at[again], row[again]
            yield _rows(batch, row, window_hashes(words.hashes, twice)[at], words.second(twice)[at])

    return docs.select("doc_id", "text", "alive").mapInArrow(run, "h1 long, h2 long, doc_id long")


def repeated(windows: DataFrame) -> DataFrame:
    """Rows of windows that stand in two documents or more, with `later`: whether one of these has a smaller id. Minima and
    maxima are taken before the shuffle, so a window that a third of all documents hold is a row a task."""
    key = [c for c in ("h1", "h2") if c in windows.columns]
    spread = windows.groupBy(*key).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).filter("_first < _last").drop("_last")
    return windows.join(spread, key).select("doc_id", "h1", (F.col("doc_id") > F.col("_first")).alias("later"))


def without_repeats(docs: DataFrame, words: int = 13, longest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, text): `text` is the words left, joined by one space, after each word in a window of
    `words` words that also begins in a document with a smaller id is gone. Windows are judged on the texts as they come.

    Words are runs of anything but ASCII white space. Null, empty and blank texts have none. Rows that share an id are one
    document, never repeats of each other. A row without an id repeats nothing, is repeated by none, and keeps its text.
    Every row gives a row. An empty table gives none. Other columns are not read.

    Texts equal to that of a smaller id are settled first by their digests and go no further. The first level takes
    windows of half the length at content-selected places (one in four words); a window of the next can only repeat if the
    part at its own such place does. All further levels test both halves of each window. A level reads texts, keeps hashes of
    64 bits to pass over windows, and 128 bits to decide.

    With `longest`, levels go on beyond `words` until no window repeats, and a column `longest` gives the greatest length
    among words, 2 * words, 4 * words, ... at which a window of the document, as a whole, also begins in one of smaller id
    (0: none)."""
    spark = docs.sparkSession
    staged = Staged(spark, "substring-dedup")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter("doc_id is not null").withColumn("digest", F.md5(F.col("text").cast("binary")))
    texts = known.select("doc_id", "digest").distinct()
    texts = staged.write("texts", texts.join(texts.groupBy("digest").agg(F.min("doc_id").alias("_first")), "digest").select("doc_id", "digest", (F.col("doc_id") > F.col("_first")).alias("copy")))

    steps = lengths(words)
    if len(steps) == 1:
        steps.insert(0, max(1, (words + 1) // 2))
    found = repeated(seeds(known, steps[0], steps[1]))
    hits = None
    beyond = None
    for level in range(1, 64):
        size = steps[level - 1]
        if level == len(steps):
            if not longest:
                break
            steps.append(2 * size)
        twice = steps[level]
        alive = staged.write(f"alive-{level}", found.groupBy("doc_id").agg(F.collect_list("h1").alias("alive")).join(texts.filter("not copy"), "doc_id"))
        staged.drop(f"alive-{level - 1}", f"windows-{level - 1}")
        if alive.isEmpty():
            break
        found = repeated(staged.write(f"windows-{level}", extended(known.join(alive, ["doc_id", "digest"]), size, twice, level == 1)))
        if twice >= words:
            found = staged.write(f"found-{level}", found)
            staged.drop(f"alive-{level}", f"windows-{level}")
        if twice == words:
            hits = found.filter("later").groupBy("doc_id").agg(F.collect_list("h1").alias("alive"))
        elif twice > words:
            reached = found.filter("later").select("doc_id").distinct().withColumn("longest", F.lit(twice))
            beyond = reached if beyond is None else beyond.unionByName(reached)
    if hits is None:
        hits = spark.createDataFrame([], "doc_id long, alive array<long>")
    verdict = texts.join(hits, "doc_id", "left").filter("copy or alive is not null")
    out = rows.withColumn("digest", F.md5(F.col("text").cast("binary"))).join(verdict, ["doc_id", "digest"], "left")
    out = _cut(out, words)
    if longest:
        reached = hits.select("doc_id", F.lit(words).alias("longest"))
        out = _with_longest(out, reached if beyond is None else reached.unionByName(beyond), words)
    return out.drop("copy")


def _with_longest(out: DataFrame, reached: DataFrame, words: int) -> DataFrame:
    """A copy repeats as a whole: the greatest level that it has words for."""
    size = F.col("n_words")
    whole = F.when(size >= words, words * F.pow(F.lit(2), F.floor(F.log2(size / words)))).otherwise(0).cast("int")
    copies = out.filter("copy").select("doc_id", whole.alias("longest"))
    most = reached.unionByName(copies).groupBy("doc_id").agg(F.max("longest").alias("longest"))
    return out.join(most, "doc_id", "left").withColumn("longest", F.coalesce("longest", F.lit(0)))


def _cut(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_words, n_removed, text, copy) of (doc_id, text, copy, alive): a copy loses all it has in windows, any other text
    what its listed windows cover."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            words = _Words(batch.column("text"))
            n = len(words.hashes)
            at = words.inside(size)
            row = words.row(at)
            copy = batch.column("copy").fill_null(False).to_numpy(zero_copy_only=False)
            gone = at[copy[row] | _listed(batch, window_hashes(words.hashes, size)[at], row)] if len(at) else at
            edge = np.bincount(gone, minlength=n + 1)[: n + 1] - np.bincount(gone + size, minlength=n + 1)[: n + 1]
            keep = np.cumsum(edge)[:n] == 0
            count = np.concatenate([[0], np.cumsum(keep)])[words.first]
            # Kept words and a blank behind each; a text ends before its last blank.
            starts, ends = words.starts[keep], words.ends[keep]
            stops = np.concatenate([[0], np.cumsum(ends - starts + 1)])
            padded = np.append(words.data, np.uint8(0x20))
            raw = padded[np.repeat(starts - stops[:-1], np.diff(stops)) + np.arange(stops[-1])]
            raw[stops[1:] - 1] = 0x20
            lo, hi = stops[count[:-1]], stops[count[1:]]
            whole = raw.tobytes()
            kept = [whole[a : max(a, b - 1)] for a, b in zip(lo.tolist(), hi.tolist())]
            total = np.diff(words.first)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total), pa.array(total - np.diff(count)), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(copy, pa.bool_())], ["doc_id", "n_words", "n_removed", "text", "copy"])

    return docs.select("doc_id", "text", "copy", "alive").mapInArrow(run, "doc_id long, n_words long, n_removed long, text string, copy boolean")
