"""Near duplicates by MinHash bands, with Bayesian pruning of candidates and exact confirmation on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged
from .graph import components
from .textkit import BLANKS, batches, hash_words, mix, window_hashes, words_of

N_HASHES = 192
BATCH = 32
#: Members of one bucket that are compared in one task: so many on a side, and so many bytes of full sets.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Chance that one true link is missed: by all bands together, and by pruning.
MISS = 1e-6

_MULTIPLIERS = np.random.default_rng(4242).integers(1, 2**63, N_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_rows(percent: int) -> int:
    """The most rows a band can have so that a pair of just `percent` similarity shares no band with a chance of at most MISS."""
    t = percent / 100
    return max(r for r in range(1, 33) if r == 1 or (1 - t**r) ** (N_HASHES // r) <= MISS)


def least_matches(percent: int) -> list[int]:
    """For 32, 64, ... compared hashes: matches below which P(similarity >= threshold | matches) < MISS under a uniform prior."""
    t, out = percent / 100, []
    for n in range(BATCH, N_HASHES + 1, BATCH):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= MISS:
                break
        out.append(m)
    return out


def shingle_sets(text: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a text of fewer words is one shingle, one without words has none."""
    data, starts, ends, first = words_of(text, BLANKS)
    hashes = hash_words(data, starts, ends)
    windows = window_hashes(hashes, words)
    out = []
    for lo, hi in zip(first.tolist(), first[1:].tolist()):
        if hi - lo >= words:
            out.append(np.unique(windows[lo : hi - words + 1]))
        elif hi > lo:
            out.append(mix(window_hashes(hashes[lo:hi], hi - lo) + np.uint64(hi - lo)))
        else:
            out.append(hashes[:0])
    return out


def band_keys(mins: np.ndarray, rows: int) -> np.ndarray:
    """The buckets of each signature: a bucket is a band with its values."""
    values = mix(mins.astype(np.uint64) + np.uint64(1))
    n = N_HASHES // rows
    keys = np.zeros((len(mins), n), np.uint64) + np.arange(n, dtype=np.uint64)
    for j in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, j : n * rows : rows])
    return keys


def signed(docs: DataFrame, words: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, key1, key2, buckets, signature): the two keys tell different sets apart, whatever the texts. Buckets
    come from whole hashes of 32 bits. The signature, which is written, moved and compared, holds their lowest 8: equal hashes
    stay equal, and unlike ones that agree there (one in 256) are one match too many, so that no link is lost by it."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            sets = shingle_sets(batch.column("text"), words)
            sizes = np.array([len(s) for s in sets])
            at = np.flatnonzero(sizes)
            flat, starts = np.concatenate([*sets, np.zeros(0, np.uint64)]), (np.cumsum(sizes) - sizes)[at]
            keys = np.zeros((2, len(sets)), np.uint64)
            mins = np.zeros((len(at), N_HASHES), np.uint32)
            if len(at):
                for k in range(2):
                    keys[k, at] = np.add.reduceat(mix(flat + np.uint64(k)), starts)
                for k, a in enumerate(_MULTIPLIERS):
                    mins[:, k] = np.minimum.reduceat(flat * a, starts) >> np.uint64(32)
            signatures = np.empty(len(sets), object)
            signatures[at] = [row.tobytes() for row in mins.astype(np.uint8)]
            buckets = np.empty(len(sets), object)
            buckets[at] = [row.tobytes() for row in band_keys(mins, rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), *(pa.array(k.view(np.int64)) for k in keys), *(pa.array(x.tolist(), pa.binary()) for x in (buckets, signatures))],
                ["doc_id", "n_shingles", "key1", "key2", "buckets", "signature"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key1 long, key2 long, buckets binary, signature binary")


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), N_HASHES)


def bands(firsts: DataFrame, rows: int) -> DataFrame:
    """(bucket, id) of each bucket of each id."""
    n = N_HASHES // rows

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keys = np.frombuffer(b"".join(batch.column("buckets").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column("id").to_numpy(), n))], ["bucket", "id"])

    return firsts.select("id", "buckets").mapInArrow(run, "bucket long, id long")


def likely(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows (i of `left`, j of `right`) that stay likely enough after each batch of compared hashes, and their matches."""
    matches = np.zeros(len(i), np.int64)
    for k, m in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[i, part] == right[j, part]).sum(axis=1)
        live = matches >= m
        i, j, matches = i[live], j[live], matches[live]
    return i, j, matches


def pruned(pairs: DataFrame, unique: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their signatures leave likely enough."""
    least = least_matches(percent)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = np.arange(batch.num_rows)
            live, _, _ = likely(_rows(batch.column("sig_a")), _rows(batch.column("sig_b")), rows, rows, least)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(live)) for c in "ab"], ["a", "b"])

    side = lambda c: unique.select(F.col("id").alias(c), F.col("signature").alias(f"sig_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, ids: DataFrame, words: int, staged: Staged) -> DataFrame:
    """(id, shingles) of the documents with these ids (doc_id): their whole sets of shingle hashes, sorted."""

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = shingle_sets(batch.column("text"), words)
            at = np.cumsum([0, *map(len, found)])
            flat = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))], ["id", "shingles"])

    wanted = docs.join(staged.write("set_ids", ids), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return staged.write("sets", wanted.select("doc_id", "text").mapInArrow(sets, "id long, shingles array<long>"))


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, staged: Staged) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union, told row by row inside the JVM."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    table = full_sets(docs, ids, words, staged)
    side = lambda c: table.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", (F.size("set_a") + F.size("set_b")).alias("n"), F.size(F.array_intersect("set_a", "set_b")).alias("both"))
    return sized.filter(100 * F.col("both") >= percent * (F.col("n") - F.col("both"))).select("a", "b")


def _dealt(members: DataFrame, rows: int, size: str) -> DataFrame:
    """Members (bucket, id, label, outside) as rows of blocks (bucket, i, j): those outside a bucket's largest component in
    the blocks i, all members in the blocks j. A block holds about `rows` members, and BLOCK_BYTES of what `size` measures."""
    blocks = lambda part: F.ceil(F.greatest(F.count_if(part) / rows, F.sum(F.when(part, F.col(size)).otherwise(0)) / BLOCK_BYTES, F.lit(1.0))).cast("int")
    counts = members.groupBy("bucket").agg(blocks(F.col("outside")).alias("n_i"), blocks(F.lit(True)).alias("n_j"))
    found = members.join(counts, "bucket")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = found.filter("outside").select("bucket", block("n_i").alias("i"), every("n_j").alias("j"), "id", "label", F.lit(True).alias("outside"))
    return left.unionByName(found.select("bucket", every("n_i").alias("i"), block("n_j").alias("j"), "id", "label", F.lit(False).alias("outside")))


def _block_pairs(group: pa.Table, least: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Likely pairs (rows of the group, matches) of different components: a member outside the largest one with any other."""
    outside = np.array(group.column("outside").to_pylist(), bool)
    label, signature = group.column("label").to_numpy(), _rows(group.column("signature"))
    left, right = np.flatnonzero(outside), np.flatnonzero(~outside)
    step = max(1, 32_768 // max(1, len(right)))
    for lo in range(0, len(left), step):
        some = left[lo : lo + step]
        i, j = np.nonzero(label[some][:, None] != label[right][None, :])
        yield likely(signature, signature, some[i], right[j], least)


def linked_blocks(members: DataFrame, unique: DataFrame, docs: DataFrame, words: int, percent: int, staged: Staged) -> DataFrame:
    """Links (a, b) between components of buckets that hold several: members (bucket, id, label, outside, n_shingles).

    Signatures are compared first, block by block, and only members that still have a likely partner go on with their full
    sets. There each block verifies its likely pairs, the likeliest first, leaves out those that it has joined already, and
    so gives no more links than it joins components."""
    least = least_matches(percent)

    def mark(group: pa.Table) -> pa.Table:
        rows = [np.concatenate([i, j]) for i, j, _ in _block_pairs(group, least)]
        at = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]))
        return pa.table({c: group.column(c).take(pa.array(at)) for c in ("bucket", "id")})

    def verify(group: pa.Table) -> pa.Table:
        ids, labels = group.column("id").to_numpy(), group.column("label").to_numpy()
        sets = [x.values.to_numpy() for x in group.column("shingles")]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while x in root:
                x = root[x]
            return x

        found = []
        for i, j, matches in _block_pairs(group, least):
            order = np.argsort(-matches, kind="stable")
            for a, b in zip(i[order].tolist(), j[order].tolist()):
                if (x := find(int(labels[a]))) == (y := find(int(labels[b]))):
                    continue
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    root[max(x, y)] = min(x, y)
                    found.append((int(ids[a]), int(ids[b])))
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("ab")})

    signatures = unique.select("id", "signature")
    dealt = _dealt(members.withColumn("bytes", F.lit(N_HASHES)), BLOCK, "bytes").join(signatures, "id")
    marked = staged.write("marked", dealt.groupBy("bucket", "i", "j").applyInArrow(mark, "bucket long, id long").distinct())
    open_ = staged.write("unsettled", members.join(marked, ["bucket", "id"]).withColumn("bytes", 8 * F.col("n_shingles")))
    sets = full_sets(docs, open_.select(F.col("id").alias("doc_id")).distinct(), words, staged)
    rows = _dealt(open_, BLOCK, "bytes").join(signatures, "id").join(sets, "id")
    return rows.groupBy("bucket", "i", "j").applyInArrow(verify, "a long, b long")


def _labels(links: DataFrame, staged: Staged) -> DataFrame:
    staged.drop("sets", "set_ids", "edges", "crossing", "better", "hooked", "likely", "labels")
    return components(links, staged)


def _mixed(members: DataFrame, labels: DataFrame, staged: Staged) -> DataFrame:
    """Members (bucket, id, label, outside, n_shingles) of buckets that hold several components; `outside` are those that are
    not in the bucket's largest. Of buckets with the same members one is enough."""
    known = staged.write("known", members.join(labels, "id", "left").select("bucket", "id", "n_shingles", F.coalesce("label", "id").alias("label")))
    sums = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    mixed = staged.write("mixed", sums.filter("low < high").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"))
    rows = staged.write("several", known.join(mixed, "bucket", "left_semi"))
    largest = rows.groupBy("bucket", "label").count().groupBy("bucket").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
    return rows.join(largest, "bucket").select("bucket", "id", "label", (F.col("label") != F.col("largest")).alias("outside"), "n_shingles")


def near_duplicates(docs: DataFrame, *, percent: int = 80, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document: near-duplicate groups and the one of each that stays.

    A document's set is its distinct shingles of `words` words (A-Z lower-cased, cut at white space); shorter ones are one
    shingle; null, empty and blank texts have no set and are linked with nothing. Documents are linked where their sets'
    Jaccard similarity is at least `percent` / 100; component_id is the smallest id reachable, and that document is kept.

    Documents of equal sets are one class, and only its smallest id goes on. Classes that share a band of MinHash values are
    candidates, but a bucket never emits all its pairs: first all members are compared with its smallest. In buckets, of any
    size, that then hold several components, members outside the largest one are compared with those of the others, block
    by block inside tasks that give links alone. Every comparison prunes by signature batches (posterior similarity at the
    MISS chance) and verifies the survivors on full sets. A link can only be missed by chance, at most MISS each for bands
    and pruning. Members of a bucket that are not linked with each other cost a comparison of signatures each.

    Rows that share an id are one document for linking (a stated case: one of their texts stands for it), and null ids are
    linked with nothing; each row gives its own row. Ids are integers. An empty table gives no rows."""
    spark = docs.sparkSession
    staged = Staged(spark, "near-dedup")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    table = staged.write("signed", signed(docs, words, band_rows(percent)))
    narrow = staged.write("narrow", table.select("doc_id", "n_shingles", "key1", "key2"))
    same = ["n_shingles", "key1", "key2"]
    classes = staged.write("classes", narrow.filter("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")))
    firsts = table.filter("n_shingles > 0").select(F.col("doc_id").alias("id"), "n_shingles", "buckets", "signature").join(classes.select("id"), "id", "left_semi")
    firsts = staged.write("firsts", firsts.dropDuplicates(["id"]))
    staged.drop("signed")
    unique = staged.write("unique", firsts.drop("buckets"))
    banded = staged.write("bands", bands(firsts, band_rows(percent)))
    staged.drop("firsts")
    buckets = staged.write("buckets", banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("size")).filter("size > 1"))
    members = staged.write("members", banded.join(buckets, "bucket"))
    staged.drop("bands", "buckets")

    pairs = staged.write("pairs", members.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct())
    links = staged.write("links", confirmed(staged.write("likely", pruned(pairs, unique, percent)), docs, words, percent, staged))
    labels = _labels(links, staged)
    left = members.filter("size > 2").select("bucket", "id").join(unique.select("id", "n_shingles"), "id")
    left = staged.write("left", _mixed(left, labels, staged))
    if not left.isEmpty():
        links = links.unionByName(staged.write("links", linked_blocks(left, unique, docs, words, percent, staged)))
        labels = _labels(links, staged)

    grown = classes.join(labels, "id", "left").select(*same, F.coalesce("label", "id").alias("component_id"), "id", "copies")
    grown = staged.write("components", grown.filter("copies > 1 or component_id <> id").select(*same, "component_id"))
    out = staged.write("result", narrow.join(grown, same, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    staged.drop(*[name for name in staged.paths if name != "result"])
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
