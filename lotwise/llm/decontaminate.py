"""Benchmark decontamination: each shard of the corpus gets an FM-index over its words, which test phrases are searched in."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged, delete, scratch
from .textkit import ALNUM, batches, hash_words, mix, span_hashes, text_bytes, words_of

#: Bytes of benchmark text whose phrases are broadcast at once; a larger benchmark is searched in blocks of that size. A
#: byte of text costs some 12 bytes as phrases.
BLOCK_BYTES = 4 << 20
#: Words of one index. A longer document is indexed in overlapping parts.
SHARD_WORDS = 1 << 20
#: One text position in so many is kept for locating.
SAMPLE = 8

SPANS = "array<struct<begin:bigint,end:bigint,from_byte:bigint,to_byte:bigint>>"


@dataclass
class Phrases:
    """A block of distinct test phrases. A symbol is 1 for words that no phrase has, else 2 and up."""

    vocabulary: np.ndarray  # sorted word hashes
    symbols: np.ndarray  # phrases, one a row, filled up with -1 on the right
    lengths: np.ndarray
    ids: np.ndarray  # sorted distinct item ids
    first: np.ndarray  # the items of phrase p: items[first[p] : first[p + 1]], as places in ids
    items: np.ndarray

    @classmethod
    def of(cls, item_ids: Sequence[str], texts: Sequence[str | None], size: int) -> Phrases:
        data, starts, ends, first = words_of(pa.array(texts, pa.string()), ALNUM)
        words = hash_words(data, starts, ends)
        ids, item = np.unique(np.array(item_ids, object), return_inverse=True) if len(item_ids) else (np.zeros(0, object), np.zeros(0, np.int64))
        n = np.diff(first)
        count = np.where(n > 0, np.maximum(1, n - size + 1), 0)  # phrases of each item
        owner = np.repeat(np.arange(len(n)), count)
        begin = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        length = np.minimum(n, size)[owner]
        keys = mix(span_hashes(words, begin, begin + length) + length.astype(np.uint64))
        _, one, phrase = np.unique(keys, return_index=True, return_inverse=True)
        vocabulary, symbol = np.unique(words, return_inverse=True)
        symbols = np.full((len(one), size), -1, np.int32)
        for k in range(size):
            has = length[one] > k
            symbols[has, k] = symbol[begin[one[has]] + k] + 2
        pairs = np.unique(phrase * max(1, len(ids)) + item[owner])
        return cls(vocabulary, symbols, length[one], ids, np.searchsorted(pairs // max(1, len(ids)), np.arange(len(one) + 1)), (pairs % max(1, len(ids))).astype(np.int32))

    def items_of(self, doc: np.ndarray, phrase: np.ndarray, n_docs: int) -> pa.Array:
        """The sorted item ids of each document's phrases."""
        n = self.first[phrase + 1] - self.first[phrase]
        item = self.items[np.repeat(self.first[phrase] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        pairs = np.unique(np.repeat(doc, n) * max(1, len(self.ids)) + item)
        at = np.searchsorted(pairs // max(1, len(self.ids)), np.arange(n_docs + 1))
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(self.ids, pa.string()).take(pa.array(pairs % max(1, len(self.ids)))))


def suffix_array(first: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence whose ends are told apart by unique symbols, by prefix doubling: each round
    sorts only those suffixes that are still equal to another."""
    n = len(first)
    bits = max(1, int(first.max()).bit_length())
    step = max(1, min(62 // bits, 4))
    key = np.zeros(n, np.int64)
    padded = np.concatenate([first, np.zeros(step, np.int64)])
    for j in range(step):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key)
    rank = np.empty(n, np.int64)

    def ranked(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Marks of the rows (of `places`, in sorted order) that share their key with a neighbour; gives each its rank."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(new)
        rank[order[places]] = places[heads][np.cumsum(new) - 1]
        return ~(new & np.append(new[1:], True))

    open_rows = np.flatnonzero(ranked(np.arange(n), key[order]))
    while len(open_rows):
        at = order[open_rows]
        ahead = at + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        by = np.argsort(key)
        order[open_rows] = at[by]
        open_rows = open_rows[ranked(open_rows, key[by])]
        step *= 2
    return order


class FMIndex:
    """Burrows-Wheeler transform of documents' symbols in a wavelet matrix, with sampled suffix positions.

    `symbols` holds whole documents, each ended by a 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        n = len(symbols)
        ends = symbols == 0
        unique = np.where(ends, np.cumsum(ends) - 1, symbols + int(ends.sum()))
        order = suffix_array(unique)
        self.bwt = symbols[order - 1]
        counts = np.bincount(symbols, minlength=n_symbols + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.levels, self.zeros = [], []
        left = self.bwt
        for bit in reversed(range(max(1, int(n_symbols).bit_length()))):
            ones = ((left >> bit) & 1).astype(bool)
            self.levels.append(np.concatenate([[0], np.cumsum(ones, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(n - ones.sum()))
            left = np.concatenate([left[~ones], left[ones]])
        self.blocks = self._down(np.arange(n_symbols + 1), np.zeros(n_symbols + 1, np.int64))
        starts = np.zeros(n, bool)
        starts[0] = True
        starts[1:] = ends[:-1]
        keep = (order % SAMPLE == 0) | starts[order]
        self.sampled, self.positions = np.cumsum(keep) - 1, order[keep]
        self.keep = keep

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        depth = len(self.levels)
        for k, (ones, zeros) in enumerate(zip(self.levels, self.zeros)):
            up = ones[at]
            at = np.where((symbol >> (depth - 1 - k)) & 1 == 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is in the transform before each place."""
        return self._down(symbol, at) - self.blocks[symbol]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases at once: their intervals of rows."""
        lo, hi = np.zeros(len(phrases.lengths), np.int64), np.full(len(phrases.lengths), len(self.bwt), np.int64)
        for back in range(1, phrases.symbols.shape[1] + 1):
            live = np.flatnonzero((hi > lo) & (phrases.lengths >= back))
            if not len(live):
                break
            symbol = phrases.symbols[live, phrases.lengths[live] - back].astype(np.int64)
            base = self.before[symbol]
            lo[live], hi[live] = base + self.rank(symbol, lo[live]), base + self.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back through the text up to a sampled position."""
        out, steps, open_ = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            done = self.keep[rows]
            out[open_[done]] = self.positions[self.sampled[rows[done]]] + steps
            open_, rows = open_[~done], rows[~done]
            symbol = self.bwt[rows]
            rows = self.before[symbol] + self.rank(symbol, rows)
            steps += 1
        return out


def occurrences(symbols: np.ndarray, bounds: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word, phrase) of each occurrence in documents whose words begin at `bounds`, from an index of each shard."""
    places, names = [], []
    most = phrases.symbols.shape[1]
    for lo in range(0, len(symbols), SHARD_WORDS):
        hi = min(len(symbols), lo + SHARD_WORDS + most - 1)
        cuts = np.unique(bounds[(bounds > lo) & (bounds < hi)])
        part = np.append(np.insert(symbols[lo:hi], cuts - lo, 0), 0)
        index = FMIndex(part, len(phrases.vocabulary) + 1)
        a, b = index.search(phrases)
        found = np.flatnonzero(b > a)
        n = (b - a)[found]
        rows = np.repeat(a[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = index.locate(rows)
        ends_before = np.cumsum(part == 0)
        places.append(lo + at - ends_before[at])
        names.append(np.repeat(found, n))
    return (np.concatenate(places), np.concatenate(names)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _search(docs: DataFrame, shared, extra: list[str], cut: bool = False) -> DataFrame:
    """Documents with what the broadcast phrases share with them."""
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra] + ["n_words bigint", f"spans {SPANS}", "items array<string>"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches(it):
            data, starts, ends, first = words_of(batch.column("text"), ALNUM)
            n = batch.num_rows
            hit = np.zeros(len(starts) + 1, np.int64)
            doc_of = phrase_of = np.zeros(0, np.int64)
            if len(starts) and len(phrases.lengths):
                words = hash_words(data, starts, ends)
                near = np.minimum(np.searchsorted(phrases.vocabulary, words), len(phrases.vocabulary) - 1)
                symbols = np.where(phrases.vocabulary[near] == words, near + 2, 1)
                at, phrase = occurrences(symbols, first, phrases)
                np.add.at(hit, at, 1)
                np.add.at(hit, at + phrases.lengths[phrase], -1)
                pairs = np.unique((np.searchsorted(first, at, side="right") - 1) * len(phrases.lengths) + phrase)
                doc_of, phrase_of = pairs // len(phrases.lengths), pairs % len(phrases.lengths)
            inside = np.zeros(len(starts) + 2, bool)
            inside[1:-1] = np.cumsum(hit)[:-1] > 0
            opened = inside[1:] & ~inside[:-1]
            opened[first[:-1]] |= inside[first[:-1] + 1] & (np.diff(first) > 0)
            closed = inside[:-1] & ~inside[1:]
            inner = first[1:-1]
            closed[inner] |= inside[inner]
            begin, end = np.flatnonzero(opened), np.flatnonzero(closed)
            owner = np.searchsorted(first, begin, side="right") - 1
            _, text_at = text_bytes(batch.column("text"))
            spans = pa.StructArray.from_arrays([pa.array(x) for x in (begin - first[owner], end - first[owner], starts[begin] - text_at[owner], ends[end - 1] - text_at[owner])], ["begin", "end", "from_byte", "to_byte"])
            columns = {c: batch.column(c) for c in extra}
            if cut:
                places = [[] for _ in range(n)]
                for d, lo, hi in zip(owner.tolist(), spans.field("from_byte").to_pylist(), spans.field("to_byte").to_pylist()):
                    places[d].append((lo, hi))
                columns["text"] = pa.array(cut_spans(batch.column("text"), places), pa.string())
            yield pa.RecordBatch.from_arrays(
                list(columns.values())
                + [pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), spans), phrases.items_of(doc_of, phrase_of, n)],
                [*extra, "n_words", "spans", "items"],
            )

    return docs.select(*dict.fromkeys([*extra, "text"])).mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, *, size: int = 10, keep: Sequence[str] = ("doc_id",), block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """The columns `keep` (each once, under any names but n_words, spans, items and cut) of every document with n_words, spans
    and items: what a benchmark shares with it.

    A phrase is `size` consecutive words of an item, or a whole shorter item that has words. `spans` are the parts of the
    document inside occurrences of phrases, merged where they overlap or touch, by word and by UTF-8 byte; `items` are the
    ids (as sorted strings) of the items with such phrases. Documents are not shuffled: each task indexes what it reads,
    and phrases go to the tasks in blocks of bounded size, one pass a block; of later blocks only documents with hits go on.

    `cut` takes the spans out of `text` (one of `keep`) in the same pass, where one block holds all phrases, and then adds a
    column `cut`.

    Null and empty texts have no words and no spans. Repeated rows are searched each. With an empty benchmark, or one
    without words, nothing is found. Item ids may repeat or be null (as the string "null")."""
    spark = docs.sparkSession
    staged = Staged(spark, "decontaminate")
    benchmark = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").alias("words"))
    total = benchmark.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    names = list(dict.fromkeys(keep))
    inner = {c: "text" if c == "text" else f"_k{k}" for k, c in enumerate(names)}  # no clash with what is found
    docs = docs.select(*[F.col(c).alias(inner[c]) for c in names], *([] if "text" in names else ["text"]))
    mine = list(inner.values())

    def outer(df: DataFrame, *found: str) -> DataFrame:
        return df.select(*[F.col(inner[c]).alias(c) for c in names], *found)

    if blocks == 1:
        rows = benchmark.collect()
        found = _search(docs, spark.sparkContext.broadcast(Phrases.of([r[0] for r in rows], [r[1] for r in rows], size)), mine, cut)
        return outer(found.withColumn("cut", F.lit(True)) if cut else found, "n_words", "spans", "items", *(["cut"] if cut else []))
    dealt = scratch(spark, "decontaminate-benchmark")
    benchmark.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(dealt)
    numbered = staged.write("docs", docs.withColumn("_row", F.monotonically_increasing_id()))
    rows = None
    for k in range(blocks):  # one block of phrases is in memory at a time
        part = spark.read.schema("item string, words string, block int").parquet(dealt).filter(F.col("block") == k).select("item", "words").collect()
        shared = spark.sparkContext.broadcast(Phrases.of([r[0] for r in part], [r[1] for r in part], size))
        found = staged.write("hits", _search(numbered, shared, ["_row"]).filter("size(spans) > 0" if k else "true"))
        shared.unpersist()
        rows = found if rows is None else rows.unionByName(found)
    one = rows.groupBy("_row").agg(F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    delete(spark, dealt)
    joined = F.expr(
        f"aggregate(spans, cast(array() as {SPANS}), (done, x) -> if(size(done) > 0 and element_at(done, -1).end >= x.begin, "
        "concat(slice(done, 1, size(done) - 1), array(named_struct('begin', element_at(done, -1).begin, 'end', greatest(element_at(done, -1).end, x.end), "
        "'from_byte', element_at(done, -1).from_byte, 'to_byte', greatest(element_at(done, -1).to_byte, x.to_byte)))), concat(done, array(x))))"
    )
    return outer(numbered.join(one.select("_row", "n_words", joined.alias("spans"), "items"), "_row"), "n_words", "spans", "items")


def cut_spans(texts: pa.Array, spans: list) -> list[str | None]:
    """Texts without the bytes of their spans."""
    out = []
    for text, cut in zip(texts.to_pylist(), spans):
        if text is not None and cut:
            raw, at, left = text.encode(), 0, []
            for lo, hi in cut:
                left.append(raw[at:lo])
                at = hi
            text = b"".join([*left, raw[at:]]).decode("utf-8", "ignore")
        out.append(text)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of `docs`, with the words inside the benchmark's phrases cut out of `text`; see `contamination`. With
    one block of phrases, texts are searched and cut in one pass."""
    names = ["text" if c == "text" else f"_c{k}" for k, c in enumerate(docs.columns)]  # no clash with what is found
    found = contamination(docs.toDF(*names), benchmark, size=size, keep=names, block_bytes=block_bytes, cut=True)
    done = found.select(*names) if "cut" in found.columns else without_spans(found.select(*names, "spans"))
    return done.toDF(*docs.columns)


def without_spans(docs: DataFrame, spans_col: str = "spans") -> DataFrame:
    """The documents with the bytes of their spans cut out of `text`; the column of spans goes. Null texts stay null."""
    names = [c for c in docs.columns if c != spans_col]
    schema = docs.select(*names).schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            spans = [[(s["from_byte"], s["to_byte"]) for s in x or ()] for x in batch.column(spans_col).to_pylist()]
            columns = [pa.array(cut_spans(batch.column(c), spans), pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)
