"""Toxicity by nearest labelled examples: exact TF-IDF cosines from a block-max inverted index, and weighted votes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Staged
from .textkit import ALNUM, batches, hash_words, words_of

#: Bounds of what is fitted and broadcast: labelled examples, the first by the hash of their id, and their distinct words
#: in all. Every word of every example is in the index.
MAX_EXAMPLES = 4_096
MAX_POSTINGS = 2_000_000
BLOCK = 128
#: Terms that more than one in so many examples holds are kept as dense columns, in which blocks are multiplied at once.
DENSE = 24
NEIGHBOURS = 20
#: A word's share of label 1 is shrunk towards the share among all examples, as if so many more examples held it.
SHRINK = 10.0
#: Cells of the index that one step of the search gathers, about.
CELLS = 300_000


def learned(column: str = "doc_id"):
    """Rows that may be learned from: the CRC-32 of the id's digits leaves 0 or 2 by 3."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 != 1


def word_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, count) of the distinct words of each text, sorted; words are 64-bit hashes."""
    data, starts, ends, first = words_of(text, ALNUM)
    words = hash_words(data, starts, ends)
    doc = np.repeat(np.arange(len(text)), np.diff(first))
    order = np.lexsort((words, doc))
    doc, words = doc[order], words[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (words[1:] != words[:-1])
    at = np.flatnonzero(new)
    return doc[at], words[at], np.diff(np.append(at, len(doc)))


def known_terms(terms: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The place of each word in the sorted terms, -1 for others."""
    if not len(terms):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, at, -1)


def term_weights(n_docs: int, df: np.ndarray, ones: np.ndarray, zeros: np.ndarray, n_ones: int, n_examples: int) -> np.ndarray:
    """Weight of each term: its inverse document frequency over all documents times how far its examples' odds of label 1
    are from those of all examples, as the absolute logarithm (supervised term weighting). With one label alone all are 0."""
    if not 0 < n_ones < n_examples:
        return np.zeros(len(df))
    share = n_ones / n_examples
    odds = (ones + SHRINK * share) / (zeros + SHRINK * (1 - share)) * ((1 - share) / share)
    return np.log((n_docs + 1) / (df + 1)) * np.abs(np.log(odds))


def _runs(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(value, start, end) of the runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[at].tolist(), at.tolist(), [*at[1:].tolist(), len(values)]


@dataclass
class Index:
    """Unit vectors of the examples by term, cut into cells of one term and one block of BLOCK examples, each with its
    largest weight. Examples with the same label and heaviest term stand together, so blocks have tight bounds. The cells
    of frequent terms are columns of a matrix, the others lists of postings."""

    terms: np.ndarray
    weights: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    base: float  # score of texts without any weighted term
    cells: np.ndarray  # cells of term t: cells[t] to cells[t + 1]
    cell_block: np.ndarray
    cell_max: np.ndarray
    cell_at: np.ndarray  # postings of a cell
    posting: np.ndarray  # example
    posting_weight: np.ndarray
    column: np.ndarray  # of each term in the matrix, -1 for others
    matrix: np.ndarray  # frequent terms x examples, filled up to whole blocks
    matrix_max: np.ndarray  # frequent terms x blocks
    block: int  # examples of a block
    knots: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(1), np.zeros(1)))

    @classmethod
    def of(cls, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, labels: np.ndarray, example: np.ndarray, term: np.ndarray, count: np.ndarray) -> Index:
        """From postings (example, term as a place in `terms`, count)."""
        n = len(ids)
        w = (1 + np.log(count)) * weights[term]
        norm = np.sqrt(np.bincount(example, w * w, minlength=n))
        bare = norm == 0
        share = labels.mean() if n else 0.0
        base = (labels[bare].sum() + share) / (bare.sum() + 1)
        keep = w > 0
        example, term, w = example[keep], term[keep], w[keep] / norm[example[keep]]
        heaviest = np.full(n, -1)
        by_weight = np.argsort(w, kind="stable")
        heaviest[example[by_weight]] = term[by_weight]
        order = np.lexsort((ids, heaviest, -labels))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        example = place[example]
        frequent = np.flatnonzero(np.bincount(term, minlength=len(terms)) * DENSE > n)
        column = np.full(len(terms), -1)
        column[frequent] = np.arange(len(frequent))
        blocks = -(-n // BLOCK)
        matrix = np.zeros((len(frequent), blocks * BLOCK))
        dense = column[term] >= 0
        matrix[column[term[dense]], example[dense]] = w[dense]
        example, term, w = example[~dense], term[~dense], w[~dense]
        by_term = np.lexsort((example, term))
        example, term, w = example[by_term], term[by_term], w[by_term]
        cell = np.concatenate([[True], (term[1:] != term[:-1]) | (example[1:] // BLOCK != example[:-1] // BLOCK)]) if len(term) else np.zeros(0, bool)
        at = np.flatnonzero(cell)
        largest = np.maximum.reduceat(w, at) if len(at) else np.zeros(0)
        cells = np.searchsorted(term[at], np.arange(len(terms) + 1))
        small = np.int32
        return cls(terms, weights, ids[order], labels[order].astype(float), float(base), cells.astype(small), (example[at] // BLOCK).astype(small), largest, np.append(at, len(term)).astype(small), example.astype(np.int32), w, column, matrix, matrix.reshape(len(frequent), blocks, BLOCK).max(axis=2, initial=0.0), BLOCK)

    def vectors(self, doc: np.ndarray, word: np.ndarray, count: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, weight) of unit vectors."""
        term = known_terms(self.terms, word)
        doc, term, count = doc[term >= 0], term[term >= 0], count[term >= 0]
        w = (1 + np.log(count)) * self.weights[term]
        norm = np.sqrt(np.bincount(doc, w * w, minlength=n_docs))
        keep = w > 0
        return doc[keep], term[keep], w[keep] / norm[doc[keep]]

    def nearest(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, example, cosine): each document's k examples of largest cosine over 0, nearest first, ties to the
        smaller id. Documents are searched some at a time, so that the gathered cells stay few."""
        found = []
        size = 1000 + np.bincount(doc, self.cells[term + 1] - self.cells[term], minlength=n_docs)
        chunk = np.cumsum(size) // CELLS
        for c in np.unique(chunk):
            lo, hi = np.searchsorted(chunk, [c, c + 1])
            a, b = np.searchsorted(doc, [lo, hi])
            d, e, s = self._some(doc[a:b] - lo, term[a:b], weight[a:b], int(hi - lo), k)
            found.append((d + lo, e, s))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def _some(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks are opened by falling upper bound, until no closed one can hold a cosine as large as the k-th."""
        blocks = -(-len(self.ids) // self.block)
        query = np.zeros((n, len(self.matrix)))
        dense = self.column[term] >= 0
        query[doc[dense], self.column[term[dense]]] = weight[dense]
        doc, term, weight = doc[~dense], term[~dense], weight[~dense]
        count = self.cells[term + 1] - self.cells[term]
        cell = np.repeat(self.cells[term] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        owner, w, block = np.repeat(doc, count), np.repeat(weight, count), self.cell_block[cell]
        bound = query @ self.matrix_max + np.bincount(owner * blocks + block, w * self.cell_max[cell], minlength=n * blocks).reshape(n, blocks)
        order = np.argsort(-bound, axis=1, kind="stable")
        falling = np.take_along_axis(bound, order, 1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(blocks)[None, :], 1)
        rank = rank[owner, block]
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        live, at, step = np.arange(n), 0, 4
        while len(live) and at < blocks:
            upto = min(blocks, at + step)
            row = np.full(n, -1)
            row[live] = np.arange(len(live))
            now = np.flatnonzero((rank < upto) & (row[owner] >= 0))
            size = self.cell_at[cell[now] + 1] - self.cell_at[cell[now]]
            posting = np.repeat(self.cell_at[cell[now]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            example = self.posting[posting].astype(np.int64)
            width = (upto - at) * self.block
            slot = np.repeat(row[owner[now]] * width + (rank[now] - at) * self.block, size) + example % self.block
            score = np.bincount(slot, np.repeat(w[now], size) * self.posting_weight[posting], minlength=len(live) * width).astype(float).reshape(len(live), width)
            self._add_dense(score.reshape(len(live), upto - at, self.block), query[live], order[live, at:upto])
            kth = np.partition(score, width - k, axis=1)[:, width - k] if width > k else np.zeros(len(live))
            r, c = np.nonzero((score > 0) & (score >= kth[:, None] - 1e-12))
            d, e, s = (np.concatenate(x) for x in zip(best, (live[r], order[live[r], at + c // self.block] * self.block + c % self.block, score[r, c])))
            by = np.lexsort((self.ids[e], -s.round(12), d))
            d, e, s = d[by], e[by], s[by]
            place = np.arange(len(d)) - np.searchsorted(d, d)
            best = d[place < k], e[place < k], s[place < k]
            last = np.zeros(n)
            last[d[place == k - 1]] = s[place == k - 1]
            rest = rank >= upto
            owner, w, cell, rank = owner[rest], w[rest], cell[rest], rank[rest]
            if upto < blocks:
                go_on = (falling[live, upto] > 0) & (falling[live, upto] >= last[live] - 1e-12)
                live = live[go_on]
            at, step = upto, step * 2
        return best

    def _add_dense(self, score: np.ndarray, query: np.ndarray, opened: np.ndarray) -> None:
        """Adds the frequent terms' part to scores (document, place, example of the block opened there)."""
        if not len(self.matrix):
            return
        row, place = np.divmod(np.argsort(opened, axis=None, kind="stable"), opened.shape[1])
        block = opened[row, place]
        for b, lo, hi in zip(*_runs(block)):
            r, p = row[lo:hi], place[lo:hi]
            score[r, p] += query[r] @ self.matrix[:, b * self.block : (b + 1) * self.block]

    def votes(self, near: tuple[np.ndarray, np.ndarray, np.ndarray], n_docs: int) -> np.ndarray:
        """Cosine-weighted share of label 1 among each document's neighbours; nan where there are none."""
        doc, example, cosine = near
        total = np.bincount(doc, cosine, minlength=n_docs)
        with np.errstate(invalid="ignore"):
            return np.where(total > 0, np.bincount(doc, cosine * self.labels[example], minlength=n_docs) / total, np.nan)

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """A rising map from votes to the share of label 1, by pooling adjacent violators over the examples' own votes,
        each taken without itself."""
        pools: list[list[float]] = []
        for v, y in sorted(zip(votes.tolist(), labels.tolist())):
            pools.append([y, 1, v, v])
            while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
                y2, n2, _, v2 = pools.pop()
                pools[-1] = [pools[-1][0] + y2, pools[-1][1] + n2, pools[-1][2], v2]
        if pools:
            self.knots = np.array([(p[2] + p[3]) / 2 for p in pools]), np.array([(p[0] + 0.5 * self.base) / (p[1] + 0.5) for p in pools])

    def scores(self, votes: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(votes), self.base, np.interp(np.nan_to_num(votes), *self.knots))


def labelled_examples(docs: DataFrame, labels: DataFrame, staged: Staged) -> DataFrame:
    """(doc_id, toxic, words, counts): the bounded sample of labelled documents, with all their distinct words."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            doc, word, n = word_counts(batch.column("text"))
            at = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, x) for x in (pa.array(word.view(np.int64)), pa.array(n.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *lists], ["doc_id", "toxic", "words", "counts"])

    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = labels.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic")).join(docs.select("doc_id"), "doc_id", "left_semi")
    picked = staged.write("picked", picked.orderBy(*order).limit(MAX_EXAMPLES))
    texts = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    found = staged.write("examples", texts.mapInArrow(run, "doc_id long, toxic long, words array<long>, counts array<int>"))
    room = found.select("doc_id", F.sum(F.size("words")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias("postings"))
    return found.join(F.broadcast(room.filter(F.col("postings") <= MAX_POSTINGS).select("doc_id")), "doc_id")


def document_frequencies(docs: DataFrame, terms) -> tuple[int, np.ndarray]:
    """Rows of `docs`, and how many of them hold each term of the broadcast `terms`. Each task sums its own counts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(len(terms.value) + 1, np.int64), 0
        for batch in batches(it):
            rows += batch.num_rows
            _, word, _ = word_counts(batch.column("text"))
            counts += np.bincount(known_terms(terms.value, word) + 1, minlength=len(counts))
        counts[0] = rows  # place 0 is that of no term
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    found = docs.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms.value) + 1, np.int64)
    df[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return int(df[0]), df[1:]


def toxicity(docs: DataFrame, labels: DataFrame, train=None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, evidence) of every document: the calibrated share of label 1 among its nearest examples, and these
    as (doc_id, cosine, toxic), nearest first.

    Examples are the labelled documents (labels' doc_id, toxic; only rows for which `train` holds) within MAX_EXAMPLES and
    MAX_POSTINGS, by the hash of their id. Every word of an example is a term, weighted by its inverse document frequency
    over all documents and by how far it goes with a label (term_weights); cosines are exact, over all terms. Calibration
    is by the examples' own votes, each without itself, which tasks count. The index is bounded and broadcast; documents
    are not shuffled, so repeated rows each get their row, whatever their ids (integers or null).

    A text without any term, empty and null texts among them, scores the share of label 1 among such examples, with no
    evidence; where there is no label at all or one alone every score is that label's (0 without labels). Null labels are
    left out; of labels that repeat an id the larger counts, of texts that do the greatest is the example. An empty table
    gives no rows."""
    spark = docs.sparkSession
    staged = Staged(spark, "toxicity")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    labels = labels.filter("toxic is not null and doc_id is not null")
    labels = labels.filter(train) if train is not None else labels
    examples = labelled_examples(docs, labels, staged)
    table = examples.toArrow().combine_chunks()
    ids, y = table.column("doc_id").to_numpy(), table.column("toxic").to_numpy()
    words, counts = (np.concatenate([x.flatten().to_numpy() for x in table.column(c).chunks] + [np.zeros(0, np.int64)]) for c in ("words", "counts"))
    example = np.repeat(np.arange(len(ids)), np.array([n for x in table.column("words").chunks for n in x.value_lengths().to_numpy()], np.int64))
    terms, term = np.unique(words.view(np.uint64), return_inverse=True)
    shared = spark.sparkContext.broadcast(terms)
    n_docs, df = document_frequencies(docs, shared)
    ones = np.bincount(term, y[example], minlength=len(terms))
    weights = term_weights(n_docs, df, ones, np.bincount(term, minlength=len(terms)) - ones, int(y.sum()), len(y))
    index = Index.of(terms, weights, ids, y, example, term, counts)
    shared.unpersist()
    draft = spark.sparkContext.broadcast(index)

    def own_votes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = draft.value
        for batch in it:
            n = batch.num_rows
            doc = np.repeat(np.arange(n), batch.column("words").value_lengths().to_numpy())
            vectors = model.vectors(doc, batch.column("words").flatten().to_numpy().view(np.uint64), batch.column("counts").flatten().to_numpy(), n)
            d, e, s = model.nearest(*vectors, n, NEIGHBOURS + 1)
            other = model.ids[e] != batch.column("doc_id").to_numpy()[d]
            d, e, s = d[other], e[other], s[other]
            few = np.arange(len(d)) - np.searchsorted(d, d) < NEIGHBOURS
            yield pa.RecordBatch.from_arrays([pa.array(model.votes((d[few], e[few], s[few]), n)), batch.column("toxic")], ["vote", "toxic"])

    told = examples.mapInArrow(own_votes, "vote double, toxic long").filter("not isnan(vote)").toArrow()
    index.calibrate(told.column("vote").to_numpy(), told.column("toxic").to_numpy())
    draft.unpersist()
    final = spark.sparkContext.broadcast(index)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = final.value
        for batch in batches(it):
            n = batch.num_rows
            near = model.nearest(*model.vectors(*word_counts(batch.column("text")), n), n, NEIGHBOURS)
            doc, e, cosine = near
            evidence = pa.StructArray.from_arrays([pa.array(model.ids[e]), pa.array(cosine), pa.array(model.labels[e].astype(np.int32))], ["doc_id", "cosine", "toxic"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), evidence)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(model.votes(near, n))), lists], ["doc_id", "score", "evidence"])

    staged.drop("picked", "examples")
    return docs.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:bigint,cosine:double,toxic:int>>")
