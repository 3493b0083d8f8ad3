"""Repeated passages by a sparse suffix array: suffixes at minimiser positions are sorted across the cluster, first by the
block of words that equal passages must share, then, where that ties, word by word; neighbours are compared and matches
extended to the right and left."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged
from .decontaminate import cut_spans
from .textkit import BLANKS, batches, hash_words, mix, span_hashes, text_bytes, window_hashes, words_of

GRAM = 8
#: A suffix is kept where its first gram has the least hash of STRIDE consecutive grams.
STRIDE = 16
#: Words before a suffix, and behind its first block, that a window which it belongs to can hold.
MARGIN = STRIDE - 1
#: Bits of a text's fingerprint, which tells rows apart that share an id; a suffix's shape takes the 8 bits below.
PRINT = 0xFFFFFF


def groups(grams: np.ndarray, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, begin, n): windows of `words` words inside one document, grouped by the first least of the STRIDE grams at
    their start. Each group is n windows in a row from `begin`, and which gram it is depends on the window alone."""
    if len(grams) < STRIDE:
        return (np.zeros(0, np.int64),) * 3
    least, at, step = grams, np.arange(len(grams)), 1
    while step < STRIDE:
        right = least[step:] < least[:-step]
        least, at = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
        step *= 2
    fits = np.zeros(len(least) + 1, np.int64)
    lo, hi = first[:-1], np.minimum(first[1:] - words + 1, len(least))
    long_enough = hi > lo
    np.add.at(fits, lo[long_enough], 1)
    np.add.at(fits, hi[long_enough], -1)
    window = np.flatnonzero(np.cumsum(fits)[:-1] > 0)
    suffix = at[window]
    begin = np.flatnonzero(np.concatenate([[True], suffix[1:] != suffix[:-1]])) if len(suffix) else np.zeros(0, np.int64)
    return suffix[begin], window[begin], np.diff(np.append(begin, len(suffix)))


def _shape(n: np.ndarray, back: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """A suffix's windows in one number: n of them, the first of which begins `back` words before it, in a text of that print."""
    return (prints.astype(np.int64) << 8 | (n - 1) << 4 | back).astype(np.uint32).view(np.int32)


def _unshape(shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    shape = shape.view(np.uint32).astype(np.int64)
    return (shape >> 4 & 15) + 1, shape & 15, shape >> 8


def suffixes(docs: DataFrame, words: int) -> DataFrame:
    """(block, whole, doc_id, begin, shape): a kept suffix by the hash of its first block of words, which all windows of
    `words` words that belong to it share, the hash of all words of these windows, and where they are."""
    length = words - MARGIN

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            data, starts, ends, first = words_of(batch.column("text"), BLANKS)
            hashes = hash_words(data, starts, ends)
            at, begin, n = groups(window_hashes(hashes, GRAM), first, words)
            both = span_hashes(hashes, np.concatenate([at, begin]), np.concatenate([at + length, begin + n - 1 + words])).view(np.int64)
            doc = np.searchsorted(first, begin, side="right") - 1
            shape = _shape(n, at - begin, batch.column("print").to_numpy()[doc])
            yield pa.RecordBatch.from_arrays([pa.array(both[: len(at)]), pa.array(both[len(at) :]), batch.column("doc_id").take(pa.array(doc)), pa.array((begin - first[doc]).astype(np.int32)), pa.array(shape)], ["block", "whole", "doc_id", "begin", "shape"])

    return docs.mapInArrow(run, "block long, whole long, doc_id long, begin int, shape int")


def _in_ranges(table: DataFrame, *order: str) -> DataFrame:
    """Sorted across the cluster: partitions hold ranges of the whole order, so a key that many rows share spreads over them."""
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartitionByRange(n, *order).sortWithinPartitions(*order)


def first_blocks(table: DataFrame) -> DataFrame:
    """(doc_id, begin, shape, source): suffixes whose windows, as they are, all stand earlier, with the document of an
    earlier place; and, with a null source, those that other suffixes tie with in their first block but not in all words.

    The order is (block, whole, doc_id, begin), so equals are neighbours. The first row of a `whole` has no equal before it
    in its partition; it is left open where its block has other rows, or may have them in another partition."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first place of the `whole`s at both ends of a block that may go on
        opened = None
        for batch in it:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("block", "whole", "doc_id", "begin", "shape")])
            told = 0  # rows held over that are given out already
            if held is None:
                opened, old = rows[0, 0], 0
            else:
                old = held.shape[1]
                told = old if old == 2 or held[0, 0] == opened else 0
                rows = np.concatenate([held, rows], axis=1)
            block, whole = rows[:2]
            new_block = np.concatenate([[True], block[1:] != block[:-1]])
            new = new_block | np.concatenate([[True], whole[1:] != whole[:-1]])
            of_block = np.cumsum(new_block) - 1
            several = np.bincount(of_block[new])[of_block] > 1
            open_ = new & (several | (block == opened))
            open_[:told] = False
            head = np.maximum.accumulate(np.where(new, np.arange(len(block)), 0))
            again = ~new & (rows[2:] != rows[2:, head]).any(axis=0)  # rows that share an id and text are one place
            again[:old] = False
            yield _places(rows[2:, open_])
            yield _places(rows[2:, again], rows[2, head[again]])
            last = np.flatnonzero(new & (of_block == of_block[-1]))
            held = rows[:, last[[0, -1]] if len(last) > 1 else last]
        if held is not None and held.shape[1] == 1 and held[0, 0] != opened:
            yield _places(held[2:])  # its block may go on in the next partition

    return _in_ranges(table, "block", "whole", "doc_id", "begin", "shape").mapInArrow(run, "doc_id long, begin int, shape int, source long")


def _places(rows: np.ndarray, source: np.ndarray | None = None) -> pa.RecordBatch:
    doc, begin, shape = rows
    sources = pa.nulls(len(doc), pa.int64()) if source is None else pa.array(source)
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(begin.astype(np.int32)), pa.array(shape.astype(np.int32)), sources], ["doc_id", "begin", "shape", "source"])


def contexts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(block, right, left, doc_id, begin, shape): the wanted suffixes with the MARGIN words behind their first block and,
    backwards, those before them, as 32-bit hashes whose bytes sort as the words do."""
    length = words - MARGIN

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            data, starts, ends, first = words_of(batch.column("text"), BLANKS)
            hashes = hash_words(data, starts, ends)
            places = batch.column("places")
            row = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy())
            begin, shape = places.flatten().field("begin").to_numpy(), places.flatten().field("shape").to_numpy()
            mine = _unshape(shape)[2] == batch.column("print").to_numpy()[row]
            row, begin, shape = row[mine], begin[mine], shape[mine]
            at = first[row] + begin + _unshape(shape)[1]
            small = np.concatenate([(hashes >> np.uint64(32)).astype(">u4"), np.zeros(1, ">u4")])
            step = np.arange(MARGIN)
            right, left = at[:, None] + length + step, at[:, None] - 1 - step
            right = small[np.where(right < first[row + 1][:, None], right, -1)]
            left = small[np.where(left >= first[row][:, None], left, -1)]
            raw = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
            block = span_hashes(hashes, at, at + length).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(block), raw(right), raw(left), batch.column("doc_id").take(pa.array(row)), pa.array(begin), pa.array(shape)], ["block", "right", "left", "doc_id", "begin", "shape"])

    # A document has at most one place for each of its suffixes.
    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("begin", "shape")).alias("places"))
    return docs.join(places, "doc_id").select("doc_id", "print", "text", "places").mapInArrow(run, "block long, right binary, left binary, doc_id long, begin int, shape int")


def _prefixes(context: np.ndarray) -> np.ndarray:
    """Hash of the first 0, 1, ... words of each row of a context."""
    out = np.zeros((len(context), MARGIN + 1), np.uint64)
    for k in range(MARGIN):
        out[:, k + 1] = mix(out[:, k] + context[:, k] + np.uint64(k + 1))
    return out


def word_by_word(table: DataFrame) -> DataFrame:
    """(hash, doc_id, begin, n, print, source): runs of n windows that stand earlier too, with the document of an earlier
    place; and, with a null source, windows (by their hash) whose earlier place may lie in another batch of the order.

    In suffix order (block, right, left) a window that holds k words behind the block can only recur among neighbours with
    k words of common prefix. Matches are extended left by the words before the suffix: a window with j words there recurs
    where j words agree. A block that lies inside a batch is settled there. A block at an edge of the batch may go on
    beyond it, but no suffix out there shares more words with one in here than the row at the edge does, so only windows
    within that prefix are open, one for each in the batch."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if not batch.num_rows:
                continue
            block, doc, begin, shape = (batch.column(c).to_numpy() for c in ("block", "doc_id", "begin", "shape"))
            n, back, prints = _unshape(shape)
            right, left = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(len(doc), MARGIN).astype(np.uint64) for c in ("right", "left"))
            j = np.arange(MARGIN + 1)  # words before the suffix; MARGIN - j stand behind the block
            owned = (j <= back[:, None]) & (j > (back - n)[:, None])
            hashes = mix(block.view(np.uint64)[:, None] + mix(_prefixes(right)[:, ::-1] + np.uint64(1)) + mix(_prefixes(left) + np.uint64(2)) * np.uint64(3) + j.astype(np.uint64))
            row, words_before = np.nonzero(owned)
            key, at = hashes[row, words_before], begin[row] + back[row] - words_before
            order = np.lexsort((at, prints[row], doc[row], key))
            row, words_before, key, at = row[order], words_before[order], key[order], at[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            again = (doc[row] != doc[row[head]]) | (prints[row] != prints[row[head]]) | (at != at[head])
            reach = np.full(len(doc), -1)
            for edge in (0, -1):
                common = np.cumprod(right == right[edge], axis=1).sum(axis=1)
                reach = np.maximum(reach, np.where(block == block[edge], common, -1))
            open_ = new & (MARGIN - words_before <= reach[row])
            yield _windows(key[open_], doc[row[open_]], at[open_], np.ones(int(open_.sum()), np.int64), prints[row[open_]])
            found = np.zeros(owned.shape, bool)
            source = np.zeros(owned.shape, np.int64)
            found[row[again], words_before[again]] = True
            source[row[again], words_before[again]] = doc[row[head[again]]]
            found, source = found[:, ::-1], source[:, ::-1]  # by rising place now
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, lo = np.nonzero(edge == 1)
            _, hi = np.nonzero(edge == -1)
            yield _windows(np.zeros(len(row), np.uint64), doc[row], begin[row] + back[row] - MARGIN + lo, hi - lo, prints[row], source[row, lo])

    return _in_ranges(table, "block", "right", "left", "doc_id", "begin").mapInArrow(run, "hash long, doc_id long, begin long, n long, print int, source long")


def _windows(key: np.ndarray, doc: np.ndarray, begin: np.ndarray, n: np.ndarray, prints: np.ndarray, source: np.ndarray | None = None) -> pa.RecordBatch:
    sources = pa.nulls(len(doc), pa.int64()) if source is None else pa.array(source)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), pa.array(begin.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(prints.astype(np.int32)), sources], ["hash", "doc_id", "begin", "n", "print", "source"])


def merged(parts: DataFrame) -> DataFrame:
    """(doc_id, print, begin, end, n_words, source_doc_id): parts of a document that overlap or touch, as one, with the
    source of the first."""
    names = ["doc_id", "print", "begin", "end", "n_words", "source_doc_id"]

    def rows(doc: np.ndarray, prints: np.ndarray, begin: np.ndarray, end: np.ndarray, source: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, prints, begin, end, end - begin, source)], names)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in it:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("doc_id", "print", "begin", "end", "source")]
            doc, prints, begin, end, source = cols if held is None else [np.concatenate([h, x]) for h, x in zip(held, cols)]
            change = np.concatenate([[True], (doc[1:] != doc[:-1]) | (prints[1:] != prints[:-1])])
            up = np.cumsum(change) << 40  # ends of one document stay above those of the documents before it
            reach = np.maximum.accumulate(up + end) - up
            new = change.copy()
            new[1:] |= begin[1:] > reach[:-1]
            at = np.flatnonzero(new)
            doc, prints, begin, end, source = doc[at], prints[at], begin[at], reach[np.append(at[1:], len(reach)) - 1], source[at]
            yield rows(doc[:-1], prints[:-1], begin[:-1], end[:-1], source[:-1])
            held = doc[-1:], prints[-1:], begin[-1:], end[-1:], source[-1:]
        if held is not None:
            yield rows(*held)

    ordered = parts.repartition("doc_id").sortWithinPartitions("doc_id", "print", "begin", "source")
    return ordered.mapInArrow(run, ", ".join(f"{c} {'int' if c == 'print' else 'long'}" for c in names))


def _printed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (F.xxhash64(text_col).bitwiseAND(F.lit(PRINT))).cast("int").alias("print"))


def repeated_passages(docs: DataFrame, *, words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, begin, end, n_words, source_doc_id, print): parts of documents, by word, that occur earlier too.

    Words are cut at white space, with A-Z lower-cased. The earlier of two places is that of the smaller (doc_id, text's
    fingerprint, word); the first place of a window is never listed as a repeat. A word is listed if, and only if, it lies
    in a window of `words` words that stands earlier: passages with different partners never add up to a longer one.
    `source_doc_id` holds the part's first window at an earlier place.

    Each window belongs to one kept suffix within its first STRIDE words. Suffixes that are alone in their first block are
    dropped, those equal to an earlier one in all words of their windows are settled by the first sort; the others are
    sorted word by word and compared with their neighbours. Windows whose block goes on beyond a batch are settled by their
    hash, one row a batch and window. Words are told by 64-bit hashes, those beyond the first block by 32 bits.

    Null, empty and short texts have no passages, nor have rows without an id, or an empty table. Ids are integers. Rows
    that share an id and text are one place and repeat nothing but what the text itself repeats; rows that share an id alone
    are told apart by `print`, a fingerprint of the text."""
    if words - MARGIN < GRAM:
        raise ValueError(f"passages must have at least {GRAM + MARGIN} words")
    staged = Staged(docs.sparkSession, "suffix-dedup")
    docs = _printed(docs, id_col, text_col).filter("doc_id is not null")
    found = staged.write("found", first_blocks(staged.write("suffixes", suffixes(docs, words))))
    staged.drop("suffixes")
    # n windows from `begin` reach to begin + n - 1 + words; `shape` holds n - 1 above 4 bits, and the print above 8.
    whole = found.filter("source is not null").select("doc_id", F.expr("shiftrightunsigned(shape, 8)").alias("print"), F.col("begin").cast("long"), (F.col("begin") + F.expr("shiftright(shape, 4) & 15") + words).cast("long").alias("end"), "source")
    told = staged.write("told", word_by_word(contexts(docs, found.filter("source is null").select("doc_id", "begin", "shape"), words)))
    edges = told.filter("source is null")
    place = F.struct("doc_id", "print", "begin")
    first = edges.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("rows")).filter("rows > 1").select("hash", "first")
    later = edges.join(first, "hash").filter(place != F.col("first")).withColumn("source", F.col("first.doc_id"))
    part = ["doc_id", "print", "begin", (F.col("begin") + F.col("n") - 1 + words).alias("end"), "source"]
    out = staged.write("result", merged(whole.unionByName(told.filter("source is not null").select(*part)).unionByName(later.select(*part))))
    staged.drop(*[name for name in staged.paths if name != "result"])
    return out.select("doc_id", "begin", "end", "n_words", "source_doc_id", "print")


def without_repeats(docs: DataFrame, *, words: int = 50) -> DataFrame:
    """All columns of `docs` (doc_id, text and any others), with every repeated passage but its first place cut out of
    `text`. Rows without one, null texts and rows without an id stay as they are; a text that is a repeat from end to end
    becomes empty. Repeated rows are cut alike, as they are one place; rows that share an id alone each lose their own parts.
    An empty table stays empty."""
    names = ["doc_id" if c == "doc_id" else "text" if c == "text" else f"_c{k}" for k, c in enumerate(docs.columns)]  # no clash with what is found
    plain = docs.toDF(*names)
    found = repeated_passages(plain.select("doc_id", "text"), words=words)
    spans = found.groupBy("doc_id", "print").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    joined = plain.withColumn("print", F.xxhash64("text").bitwiseAND(F.lit(PRINT)).cast("int")).join(spans, ["doc_id", "print"], "left")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            text, spans = batch.column("text"), batch.column("spans").to_pylist()
            cuts: list[list[tuple[int, int]]] = [[] for _ in spans]
            if any(spans):
                _, starts, ends, first = words_of(text, BLANKS)
                _, at = text_bytes(text)
                cuts = [[(int(starts[first[k] + s["begin"]] - at[k]), int(ends[first[k] + s["end"] - 1] - at[k])) for s in found or ()] for k, found in enumerate(spans)]
            yield pa.RecordBatch.from_arrays([pa.array(cut_spans(text, cuts), pa.string()) if c == "text" else batch.column(c) for c in names], names)

    return joined.select(*names, "spans").mapInArrow(run, plain.schema).toDF(*docs.columns)
