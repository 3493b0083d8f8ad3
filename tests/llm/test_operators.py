import base64
import hashlib
import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwise.llm import decontaminate, langid, near_dedup, neighbours, packing, sharding, suffix_dedup, token_counts, toxicity, warc
from lotwise.llm.graph import components
from lotwise.llm.common import Staged

from .conftest import WORD, lower, sentence

DOCS = "doc_id long, text string"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def odd_documents():
    """Nulls, empty and blank texts, a very long one, repeated rows and a null id."""
    return [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (3, ""), (4, " \n\t "), (5, "word " * 30_000), (6, "x"), (None, "a b c d e f g"), (7, "é ü ñ")]


# --- sharding


def test_fill_gives_turns():
    table = sharding.fill(["a", "b", "c"], 101)
    counts = Counter(table)
    assert set(counts) == {0, 1, 2} and max(counts.values()) - min(counts.values()) <= 1
    moved = sum(a != b for a, b in zip(table, sharding.fill(["a", "b", "c", "d"], 101)) if b != 3)
    assert moved < 20
    for bad in (([], 101), (["a", "a"], 101), (["a"], 100), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_sharding_rows(spark):
    df = spark.createDataFrame([(*r, 9) for r in odd_documents()], DOCS + ", shard int")
    got = sharding.assign_shards(df, ["doc_id"], ["a", "b", "c"], slots=101)
    assert sorted(got.columns) == ["doc_id", "shard", "shard_name", "slot", "text"] and got.count() == len(odd_documents())
    assert got.filter("doc_id = 1").select("slot").distinct().count() == 1
    assert sharding.assign_shards(df.limit(0), ["doc_id"], ["a"], slots=101).count() == 0
    hot = spark.range(1000).withColumn("key", F.lit("hot"))
    spread = sharding.assign_shards(hot, ["key"], list("abcd"), slots=101, spread=16, spread_by=["id"])
    assert spread.select("shard").distinct().count() > 1


# --- packing


def test_packing_is_gapless_and_exact(spark):
    rows = odd_documents() + [(k, f"tale {k} of the sea " * (k % 7)) for k in range(10, 60)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS).repartition(3), window=64).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter(tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in rows)
    ordered = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    place = 0
    for p in ordered:
        assert (p.sequence_id, p.offset) == divmod(place, 64) and 0 < p.length == len(p.ids) // 4 <= 64 - p.offset
        place += p.length
    got, open_ = Counter(), []
    for p in ordered:
        assert p.start == len(open_)
        open_ += np.frombuffer(p.ids, "<u4").tolist()
        if len(open_) == p.doc_tokens:
            got[tuple(open_)] += 1
            open_ = []
    assert got == want and not open_
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


# --- suffix-array dedup


def covered(rows, docs):
    marks = {d: [0] * len(WORD.findall(lower(t))) for d, t in docs}
    for r in rows:
        marks[r.doc_id][r.begin : r.end] = [1] * (r.end - r.begin)
    return {d: m for d, m in marks.items() if any(m)}


def test_repeats_against_brute_force(spark):
    rng = np.random.default_rng(1)
    passages = [sentence(rng, n) for n in (50, 51, 64, 120, 49)]
    docs = [(k, " ".join([sentence(rng, rng.integers(0, 90)), passages[k % 5], sentence(rng, rng.integers(0, 60)), passages[k % 3] if k % 2 else ""])) for k in range(60)]
    docs += [(100, docs[3][1]), (101, None), (102, ""), (103, "la " * 400), (104, "la " * 300)]
    seen, want = set(), {}
    for d, t in sorted(docs):
        words = WORD.findall(lower(t))
        marks = [0] * len(words)
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            if window in seen:
                marks[k : k + 50] = [1] * 50
            seen.add(window)
        if any(marks):
            want[d] = marks
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    rows = suffix_dedup.repeated_passages(df).collect()
    assert covered(rows, docs) == want
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(df.withColumn("source", F.lit("s"))).collect()}
    for d, t in docs:
        words = WORD.findall(t or "")
        assert WORD.findall(cut[d] or "") == [w for w, m in itertools.zip_longest(words, want.get(d, []), fillvalue=0) if not m]
    assert cut[101] is None and suffix_dedup.repeated_passages(df.limit(0)).count() == 0


def test_repeats_around_a_common_core(spark):
    """Many documents share 40 or 60 words, and two of them a longer passage around these words."""
    rng = np.random.default_rng(3)
    docs = []
    for group in range(12):
        core, left, right = sentence(rng, 60 if group % 3 == 2 else 40), sentence(rng, 6), sentence(rng, 6)
        for k in range(20):
            before, after = (left, right) if k in (7, 15) else (f"a{group} b{k}", f"c{group} d{k}")
            docs.append((20 * group + k, f"{sentence(rng, 20)} {before} {core} {after} {sentence(rng, 20)}"))
    joined = sentence(rng, 85).split()  # two overlapping passages of 45 words, none of 50
    docs += [(k, " ".join([sentence(rng, 30), *joined[lo:hi], sentence(rng, 30)])) for k, (lo, hi) in enumerate([(0, 45), (40, 85), (0, 85), (20, 64)], 300)]
    docs += [(400, None), (401, ""), (402, "la " * 300), (403, "la " * 120), (404, docs[5][1]), (404, docs[5][1])]
    seen, want = {}, {}
    for d, t in sorted(set(docs)):
        words = WORD.findall(lower(t))
        marks = [0] * len(words)
        for k in range(len(words) - 49):
            if seen.setdefault(tuple(words[k : k + 50]), (d, k)) < (d, k):
                marks[k : k + 50] = [1] * 50
        if any(marks):
            want[d] = marks
    rows = suffix_dedup.repeated_passages(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    assert covered(rows, docs) == want
    texts = {d: WORD.findall(lower(t)) for d, t in docs}
    for r in rows:
        passage = " ".join(texts[r.doc_id][r.begin : r.begin + 50])
        assert r.n_words == r.end - r.begin >= 50 and r.source_doc_id <= r.doc_id and passage in " ".join(texts[r.source_doc_id])


def all_windows(docs):
    """Marks of the words inside windows of 50 words that stand earlier, by plain comparison."""
    seen, want = {}, {}
    for d, t in sorted(set(docs)):
        words = WORD.findall(lower(t))
        marks = [0] * len(words)
        for k in range(len(words) - 49):
            if seen.setdefault(tuple(words[k : k + 50]), (d, k)) < (d, k):
                marks[k : k + 50] = [1] * 50
        if any(marks):
            want[d] = marks
    return want


def test_partners_two_documents_apart(spark):
    """Families of four share a passage of 50 words; the first word differs between odd and even members, so each repeat
    stands two documents earlier and the neighbour in between does not hold it."""
    rng = np.random.default_rng(11)
    docs = []
    for family in range(30):
        passage = sentence(rng, 49)
        for k in range(4):
            docs.append((4 * family + k, f"{sentence(rng, 20)} x{family}{k % 2} {passage} {sentence(rng, 20)}"))
    rows = suffix_dedup.repeated_passages(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    assert covered(rows, docs) == all_windows(docs)
    assert sum(r.doc_id % 4 == 3 and r.source_doc_id == r.doc_id - 2 for r in rows) == 30


def test_two_short_repeats_make_no_long_one(spark):
    """Passages of 42 words that overlap, each with another partner: no window of 50 words stands twice."""
    rng = np.random.default_rng(12)
    docs = []
    for k in range(30):
        joined = sentence(rng, 54).split()
        docs += [(3 * k, f"{sentence(rng, 30)} {' '.join(joined[:42])} {sentence(rng, 30)}"), (3 * k + 1, f"{sentence(rng, 30)} {' '.join(joined[12:])} {sentence(rng, 30)}"), (3 * k + 2, f"{sentence(rng, 30)} {' '.join(joined)} {sentence(rng, 30)}")]
    assert suffix_dedup.repeated_passages(spark.createDataFrame(docs, DOCS).repartition(4)).count() == 0


def test_repeats_of_rows_that_share_an_id(spark):
    rng = np.random.default_rng(13)
    passage, other = sentence(rng, 60), sentence(rng, 55)
    docs = [(1, f"{passage} one"), (2, f"two {passage}"), (2, f"{other} tail"), (2, f"{other} tail"), (3, f"start {other}"), (None, passage), (4, None)]
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in docs], DOCS + ", spans int, print int, _spans int").repartition(3)
    cut = suffix_dedup.without_repeats(df)
    assert cut.columns == df.columns
    got = sorted(((r.doc_id, (r.text or "").strip()) for r in cut.collect()), key=str)
    assert got == sorted([(1, f"{passage} one"), (2, "two"), (2, f"{other} tail"), (2, f"{other} tail"), (3, "start"), (None, passage), (4, "")], key=str)
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_hot_block_over_many_batches(spark):
    """A common passage in every document, with other words around it, sorted in batches of 16 rows."""
    rng = np.random.default_rng(14)
    hot, pair = sentence(rng, 58), sentence(rng, 12)
    docs = [(k, f"{sentence(rng, 25)} {pair if k % 40 == 7 else ''} {hot} {'and' if k % 3 else 'or'} {sentence(rng, 25)}") for k in range(200)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        rows = suffix_dedup.repeated_passages(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert covered(rows, docs) == all_windows(docs)


# --- near duplicates


def brute_groups(docs, percent):
    sets = {}
    for d, t in docs:
        w = WORD.findall(lower(t))
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = sentence(rng, 150).split()
    docs = [(k, sentence(rng, int(rng.integers(1, 80)))) for k in range(40)]
    for k in range(100, 190):  # a crowd of copies with up to six changed words, in which not all are linked
        words = list(base)
        for at in rng.choice(150, k % 7, replace=False):
            words[at] = f"new{k}-{at}"
        docs.append((k, " ".join(words)))
    docs += [(300, docs[5][1].upper()), (301, docs[5][1]), (302, None), (303, ""), (304, " \n"), (305, "one two"), (306, "One  TWO"), (307, "x " * 3000), (308, "x " * 4000)]
    for percent in (85, 80):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(3), percent=percent).collect()}
        assert got == brute_groups(docs, percent)


def test_near_duplicates_of_odd_rows(spark):
    got = near_dedup.near_duplicates(spark.createDataFrame(odd_documents(), DOCS)).collect()
    assert len(got) == len(odd_documents()) and all(r.kept for r in got if r.doc_id is None or r.n_shingles == 0)
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long"), Staged(spark, "test")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_bands_and_pruning_meet_their_chance():
    for percent in (80, 85, 95):
        rows, t = near_dedup.band_rows(percent), percent / 100
        assert (1 - t**rows) ** (near_dedup.N_HASHES // rows) <= near_dedup.MISS
        assert near_dedup.least_matches(percent) == sorted(near_dedup.least_matches(percent))


# --- language


def test_languages(spark):
    rng = np.random.default_rng(3)
    letters = {"aa": "abcde", "zz": "vwxyz", "mm": "klmno"}
    word = lambda lang: "".join(rng.choice(list(letters[lang]), 6))
    text = lambda *langs: " ".join(word(lang) for lang in langs for _ in range(40))
    train = [(k, text(lang), lang) for k, lang in enumerate([*letters] * 5)]
    test = [(100, text("aa"), None), (101, text("zz", "zz", "mm"), None), (102, None, "aa"), (103, "", "aa"), (104, "12 34 …", "aa"), (105, "ab " * 20_000, None), (106, "中", None)]
    df = spark.createDataFrame(train + test, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, F.col("doc_id") < 100).collect()}
    assert [got[k].lang_pred for k in range(15)] == [*letters] * 5
    assert [got[k].lang_pred for k in (100, 101, 102, 103, 104, 105)] == ["aa", "zz", "und", "und", "und", "aa"]
    assert set(got[101].shares) == {"zz", "mm"} and abs(got[101].shares["zz"] - 2 / 3) < 0.1 and got[106].lang_pred in letters
    assert {r.lang_pred for r in langid.identify(df, F.lit(False)).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0
    again = {r.doc_id: r for r in langid.identify(df, F.col("doc_id") < 100, block=2).collect()}  # two blocks of languages
    assert {d: r.lang_pred for d, r in again.items()} == {d: r.lang_pred for d, r in got.items()}
    assert again[101].shares == pytest.approx(got[101].shares, abs=1e-4)
    odd = df.unionByName(df.filter("doc_id in (101, 102)")).unionByName(df.filter("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long")))
    assert langid.identify(odd.withColumn("shares", F.lit(1)).withColumn("kept", F.lit(2)), F.col("doc_id") < 100).count() == len(train + test) + 3


def test_more_languages_than_a_block(spark):
    """300 languages of three letters each, in blocks of 64."""
    letters = [chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k) + chr(0x4E02 + 3 * k) for k in range(300)]
    rng = np.random.default_rng(20)
    text = lambda k: " ".join("".join(rng.choice([*letters[k]], 4)) for _ in range(12))
    rows = [(k, text(k), f"l{k:03d}") for k in range(300)] + [(300 + k, text(k), None) for k in range(0, 300, 7)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id") < 300)
    assert all(r.lang_pred == f"l{r.doc_id % 300:03d}" for r in got.collect())


def plain_mixtures(train, texts):
    """Shares by expectation-maximisation over dictionaries, word by word, and the choice of languages by penalised likelihood."""
    from math import exp, log

    def words(text):
        for word in "".join(c if c.isalpha() else " " for c in lower(text)).split(" "):
            if word:
                codes = [ord(c) for c in word] + [32]
                grams = []
                for k, c in enumerate(codes):
                    one = codes[k - 1] if k else 32
                    two = codes[k - 2] if k > 1 else 32
                    grams.append((((c | one << 8 | two << 16) * 0x9E3779B1) % 2**32) >> 15)
                yield grams

    langs = sorted({lang for _, lang in train})
    counts = {x: Counter(g for t, lang in train if lang == x for w in words(t) for g in w) for x in langs}
    total = {x: sum(counts[x].values()) + 0.1 * 2**17 for x in langs}
    out = []
    for text in texts:
        logs = [{x: sum(log((counts[x][g] + 0.1) / total[x]) for g in w) for x in langs} for w in words(text)]
        like = [{x: exp(v - max(one.values())) for x, v in one.items()} for one in logs]

        def em(allowed):
            theta = {x: 1 / len(allowed) for x in allowed}
            for _ in range(1500):  # as good as settled
                new = dict.fromkeys(allowed, 0.0)
                for one in like:
                    sums = sum(theta[x] * one[x] for x in allowed)
                    for x in allowed:
                        new[x] += theta[x] * one[x] / sums / len(like)
                theta = new
            return theta, sum(log(sum(theta[x] * one[x] for x in allowed)) for one in like)

        cost = 2 * log(len(like) + 1)
        theta, fit = em(langs)
        best, score = theta, fit - cost * (len(langs) - 1)
        while len(theta) > 1:
            theta, fit = em(sorted(theta, key=theta.get)[1:])
            if fit - cost * (len(theta) - 1) <= score:
                break
            best, score = theta, fit - cost * (len(theta) - 1)
        out.append({x: v for x, v in best.items() if v > 1e-9})
    return out


def test_shares_reach_their_maximum():
    """4000 plain rounds find nothing better (and, where languages are near, are still short of it); documents of one to thousands of words, near and far languages, sets."""
    rng = np.random.default_rng(8)
    n = np.array([1, 3, 40, 400, 5000])
    first = np.concatenate([[0], np.cumsum(n)])
    logs = -np.abs(rng.normal(size=(n.sum(), 5))) * np.array([1, 1.02, 3, 8, 8])
    logs[:, 1] = logs[:, 0] + rng.normal(size=len(logs)) * 0.01  # hardly to be told apart
    like = np.exp(logs - logs.max(axis=1, keepdims=True))
    allowed = np.ones((5, 5), bool)
    allowed[3, 2] = False
    theta, fit, gap = langid.shares(like, first, allowed)
    assert (gap <= langid.TOLERANCE).all() and np.allclose(theta.sum(axis=1), 1) and theta[3, 2] == 0
    for k in range(5):
        part, share = like[first[k] : first[k + 1]], allowed[k] / allowed[k].sum()
        for _ in range(4000):
            share = share * (part / (part @ share)[:, None]).mean(axis=0)
        best = np.log(part @ share).sum()
        assert fit[k] == pytest.approx(np.log(part @ theta[k]).sum(), abs=1e-6) and fit[k] >= best - langid.TOLERANCE


def test_mixtures_against_plain_expectation_maximisation(spark):
    rng = np.random.default_rng(21)
    shape = {"aa": [8, 6, 4, 2, 1, 1, 1, 1], "bb": [1, 1, 2, 4, 6, 8, 2, 1], "cc": [1, 4, 1, 4, 1, 4, 8, 8]}  # they share all letters
    word = lambda lang: "".join(rng.choice([*"abcdefgh"], 5, p=np.array(shape[lang]) / sum(shape[lang])))
    text = lambda *langs: " ".join(word(lang) for lang in langs for _ in range(30))
    train = [(text(lang), lang) for lang in [*shape] * 6]
    texts = [text("aa"), text("aa", "bb"), text("cc", "bb"), text("aa", "bb", "cc"), text("bb", "bb", "cc"), word("aa"), text("cc")]
    rows = [(k, t, lang) for k, (t, lang) in enumerate(train)] + [(100 + k, t, None) for k, t in enumerate(texts)]
    found = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id") < 100).filter("doc_id >= 100").orderBy("doc_id").collect()
    for r, want in zip(found, plain_mixtures(train, texts), strict=True):
        assert r.shares == pytest.approx(want, abs=2e-3) and r.lang_pred == max(want, key=want.get)


# --- neighbours


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    x[40:60] = x[40]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [1.0] * 5), (None, x[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, k=24).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s.round(12)))[:5].tolist()
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - s[r.vec_id]) < 1e-9 for r in mine)
        hits += len(set(best) & {r.vec_id for r in mine})
    assert hits >= 0.9 * 5 * 30 and len(got) == 150
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 50), key=lambda r: r["rank"])] == [40, 41, 42, 43, 44]
    few = neighbours.nearest(df.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in few] in ([1, 2], [2, 1])
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_of_tiny_and_huge_vectors(spark):
    rng = np.random.default_rng(19)
    x = rng.normal(size=(60, 8))
    scale = np.array([1e-200, 1e200, 1.0, 5e-310])[np.arange(60) % 4]
    rows = [(k, (v * c).tolist()) for k, (v, c) in enumerate(zip(x, scale))]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 10, k=16).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for r in got:
        assert abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-9
    assert len(got) == 50 and all(r.vec_id == sorted(range(60), key=lambda k: -(unit[r.query_id] @ unit[k]))[1] for r in got if r["rank"] == 1)


# --- toxicity


def test_nearest_is_exact(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    monkeypatch.setattr(toxicity, "DENSE", 5)
    held = rng.random((500, 40)) < np.linspace(0.02, 0.5, 40)
    counts = held * rng.integers(1, 4, (500, 40))
    counts[100:130] = counts[100]  # ties
    weights, labels, ids = rng.uniform(1, 5, 40), rng.integers(0, 2, 500), rng.permutation(500)
    example, term = np.nonzero(counts)
    index = toxicity.Index.of(np.arange(40, dtype=np.uint64), weights, ids, labels, example, term, counts[example, term])
    dense = np.where(held | (counts > 0), (1 + np.log(np.maximum(counts, 1))) * weights, 0) * (counts > 0)
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-30)
    vectors = index.vectors(example, term.astype(np.uint64), counts[example, term], 500)
    doc, found, cosine = index.nearest(*vectors, 500, 20)
    for k in range(500):
        s = dense @ dense[k]
        want = np.lexsort((ids, -s.round(12)))[:20]
        mine = doc == k
        assert index.ids[found[mine]].tolist() == ids[want[s[want] > 0]].tolist()
        assert np.allclose(cosine[mine], s[want[s[want] > 0]])


def brute_scores(docs, labels):
    """Scores by plain comparison of every document with every example, over dictionaries of words."""
    import re

    bags = [Counter(re.findall(rb"[0-9a-z\x80-\xff]+", lower(t).encode())) for _, t in docs]
    df = Counter(w for bag in bags for w in bag)
    examples = sorted((d, labels[d], bag) for (d, _), bag in zip(docs, bags) if d in labels)
    share = sum(y for _, y, _ in examples) / len(examples)
    held = [Counter(w for _, y, bag in examples if y == k for w in bag) for k in (0, 1)]

    def weight(w):
        odds = (held[1][w] + 10 * share) / (held[0][w] + 10 * (1 - share)) * (1 - share) / share
        return np.log((len(docs) + 1) / (df[w] + 1)) * abs(np.log(odds)) if held[0][w] + held[1][w] else 0.0

    def unit(bag):
        v = {w: (1 + np.log(n)) * weight(w) for w, n in bag.items()}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items() if x} if norm else {}

    vectors = [(d, y, unit(bag)) for d, y, bag in examples]
    bare = [y for _, y, v in vectors if not v]
    base = (sum(bare) + share) / (len(bare) + 1)

    def vote(v, without=None):
        near = sorted(((-round(sum(x * u.get(w, 0) for w, x in v.items()), 12), d, y) for d, y, u in vectors if d != without))[:20]
        near = [n for n in near if n[0] < 0]
        return sum(n[0] * n[2] for n in near) / sum(n[0] for n in near) if near else None

    points = sorted((vote(v, d), y) for d, y, v in vectors if v and vote(v, d) is not None)
    pools = []
    for v, y in points:
        pools.append([y, 1, v, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    x, y = [(p[2] + p[3]) / 2 for p in pools], [(p[0] + 0.5 * base) / (p[1] + 0.5) for p in pools]
    votes = [vote(unit(bag)) for bag in bags]
    return {d: base if v is None else float(np.interp(v, x, y)) for (d, _), v in zip(docs, votes)}


def test_toxicity_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(16)
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    words = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(words, n, p=np.arange(60, 0, -1) / 1830))
    docs = [(k, text(int(rng.integers(1, 40))) + (" vile" if k % 5 == 0 and k % 7 else "")) for k in range(160)] + [(200, None), (201, ""), (202, "nothing-known"), (203, "Vile, vile")]
    labels = {k: int(k % 5 == 0) for k in range(0, 160) if k % 3} | {202: 0}
    table = spark.createDataFrame([*labels.items()], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity(spark.createDataFrame(docs, DOCS).repartition(3), table).collect()}
    want = brute_scores(docs, labels)
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-9 for d in want)


def test_toxicity(spark):
    rng = np.random.default_rng(6)
    docs = [(k, sentence(rng, 30, "v") + (" vile" if k % 4 == 0 else "")) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(0, 400)] + [(9999, 1), (3, None)], "doc_id long, toxic int")
    df = spark.createDataFrame(docs + [(1000, None), (1001, ""), (1002, "VILE vile"), (1003, "so vile " * 9000)], DOCS)
    got = {r.doc_id: r for r in toxicity.toxicity(df, labels, F.col("doc_id") % 3 != 1).collect()}
    assert len(got) == 404 and all(0 <= r.score <= 1 for r in got.values())
    assert all((got[k].score >= 0.7) == (k % 4 == 0) for k in range(400))
    assert got[1000].score < 0.3 > got[1001].score and got[1002].score >= 0.7 <= got[1003].score
    assert len(got[1002].evidence) == 20 and all(e.toxic for e in got[1002].evidence)
    assert {round(r.score, 3) for r in toxicity.toxicity(df, labels.limit(0)).collect()} == {0.0}
    assert {round(r.score, 3) for r in toxicity.toxicity(df, labels.filter("toxic = 1")).collect()} == {1.0}
    assert toxicity.toxicity(df.limit(0), labels).count() == 0
    again = toxicity.toxicity(df.unionByName(df).withColumn("score", F.lit("x")).withColumn("toxic", F.lit("y")), labels, F.col("doc_id") % 3 != 1)
    assert again.count() == 808 and again.filter("doc_id = 1002").select("score").distinct().count() == 1


# --- WARC


def test_archives_round_trip(spark, tmp_path):
    whole = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:66>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    html = ["<p>a</p>", "<p>a</p>", None, "", f"x{whole}y", f"{whole}", "WARC/1.1\r\n", "WARC/1.1\r\n\r\nContent-Length: 3\r\n", "é" * 100_000, "end\r\n\r\n", f"z{whole * 30}", "\r\nWARC/1.1"]
    rows = [(k, f"http://a.example/{k}\r\nX: y", h) for k, h in enumerate(html)]
    path = f"file://{tmp_path}/w"
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # splits inside records and magic lines
    try:
        got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == list(range(len(html)))
    for k, h in enumerate(html):
        raw = (h or "").encode()
        first = next(j for j, other in enumerate(html) if (other or "") == (h or ""))
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (got[k].record_type, got[k].refers_to) == (("response", None) if first == k else ("revisit", first))


def test_one_archive_of_many_splits(spark, tmp_path):
    """One file, read in some 200 splits: small records, magic lines inside payloads, and payloads longer than a split."""
    rng = np.random.default_rng(17)
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = [f"{k} " + (inner * int(rng.integers(1, 80)) if k % 9 == 0 else "x" * int(rng.integers(0, 3000))) for k in range(300)]
    pages = spark.createDataFrame([(k, f"u{k}", h) for k, h in enumerate(html)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, f"file://{tmp_path}/w")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = {r.page_id: (r.record_type, r.payload_bytes, r.payload_digest) for r in warc.read_archives(spark, f"file://{tmp_path}/w").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: ("response", len(h), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()) for k, h in enumerate(html)}


def test_archives_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(empty, f"file://{tmp_path}/w")
    assert warc.read_archives(spark, f"file://{tmp_path}/w").count() == 0
    small = spark.createDataFrame([(1, None, "ab"), (2, "u", "ab"), (2, "u", "abcd"), (3, "u", "abcd"), (None, "u", "abcd")], empty.schema)
    warc.write_archives(small, f"file://{tmp_path}/v", min_revisit_bytes=3)
    got = [(r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, f"file://{tmp_path}/v").collect()]
    assert sorted(got, key=str) == [(1, "response", None), (2, "response", None), (2, "response", None), (3, "revisit", 2), (None, "revisit", 2)]


# --- token counts


def test_rollup(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, n_tokens long, sign int"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    rollup = token_counts.TokenRollup(spark, f"file://{tmp_path}/r")
    assert rollup.totals().count() == 0
    assert rollup.commit("1", rows(("s", "en", "t1", 5, 1), ("s", "en", "t1", 7, 1), (None, "en", "t1", None, 1)))
    assert rollup.commit("2", rows(("s", "en", "t1", 7, -1), ("s", "en", "t1", 9, 1)))
    assert not rollup.commit("2", rows(("s", "en", "t1", 100, 1)))
    assert rollup.commit("3", rows()) and rollup.commit("4", rows((None, "en", "t1", None, -1)))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t1", 2, 14)]
    assert not rollup.commit("4", rows(("s", "en", "t1", 1, 1)))
    for _ in range(2):  # compaction changes no total, and is lasting
        assert rollup.compact() and not rollup.commit("4", rows(("s", "en", "t1", 1, 1)))
        assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "t1", 2, 14)]
    assert rollup.commit("5", rows(("s", "en", "t1", 1, 1))) and rollup.totals().first().n_tokens == 15
    asked = rollup.totals()
    assert rollup.compact() and asked.first().n_tokens == 15  # a result outlives the compaction after it
    assert rollup.totals().first().n_tokens == 15 and rollup._names("batch") == ["5"]
    assert rollup.compact() and rollup.totals().first().n_tokens == 15 and rollup._names("batch") == [] and not rollup.commit("5", rows())


def test_rollup_of_two_writers_and_crashes(spark, tmp_path, monkeypatch):
    schema = "source string, lang string, tokenizer string, n_tokens long, sign int"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    path = f"file://{tmp_path}/r"
    one, two = token_counts.TokenRollup(spark, path), token_counts.TokenRollup(spark, path)
    with monkeypatch.context() as m:  # both have looked before either has written
        m.setattr(one, "_names", lambda kind: [])
        m.setattr(two, "_names", lambda kind: [])
        assert [one.commit("a", rows(("s", "en", "t", 5, 1))), two.commit("a", rows(("s", "en", "t", 7, 1)))] == [True, False]
    assert two.totals().first().n_tokens == 5
    with monkeypatch.context() as m:  # written, but not yet named
        m.setattr(one, "_move", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            one.commit("b", rows(("s", "en", "t", 9, 1)))
        with pytest.raises(ZeroDivisionError):
            one.compact()
    assert one.totals().first().n_tokens == 5 and one.commit("b", rows(("s", "en", "t", 9, 1)))
    assert one.compact() and two._names("batch") == ["a", "b"]
    with monkeypatch.context() as m:  # totals are named, but the batches have not gone yet
        m.setattr(token_counts, "delete", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            one.compact()
    assert two.totals().first().n_tokens == 14 and two.compact() and two.totals().first().n_tokens == 14
    with monkeypatch.context() as m:  # a compaction that began before another has ended
        m.setattr(one, "_number", lambda: 0)
        m.setattr(one, "_names", lambda kind: ["late"] if kind == "batch" else [])
        two.commit("late", rows(("s", "en", "t", 1, 1)))
        assert not one.compact()
    assert one.totals().first().n_tokens == 15


def test_token_count_query(spark, tmp_path):
    from lotwise.llm.queries import op9_token_counts

    rows = [(1, "One two, three", "en", "a", 14), (2, "One two, three", "en", "b", 14), (3, None, None, "a", None), (4, "", "en", "a", 0), (5, "vier", "de", None, 4)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for _, text, lang, source, _ in [rows[0], rows[2], rows[4]]:  # the second is a copy of the first, the fourth of the third
        for name, n in (("words-1", len((text or "").split())), ("word_bpe_49k-1", len(tokenizer.encode(text or "", add_special_tokens=False).ids))):
            want[(source, lang, name)] += np.array([1, n])
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in op9_token_counts(spark, f"file://{tmp_path}").collect()}
    assert got == {k: tuple(v) for k, v in want.items()}


# --- decontamination


def brute_hits(docs, bench, size=10):
    words = lambda t: [w.decode() for w in __import__("re").findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t).encode())]
    phrases = {}
    for item, t in bench:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            phrases.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    out = {}
    for d, t in docs:
        w = words(t)
        hit, items = [0] * len(w), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if found := phrases.get(tuple(w[k : k + n])):
                    items |= found
                    hit[k : k + n] = [1] * n
        out[d] = (len(w), sum(hit), sorted(items))
    return out


@pytest.mark.parametrize("blocks", [False, True])
def test_contamination_against_brute_force(spark, monkeypatch, blocks):
    rng = np.random.default_rng(7)
    bench = [(k, sentence(rng, n, "b")) for k, n in enumerate((30, 10, 9, 3, 1, 0, 12))] + [(70, None), (71, "!!")]
    bench += [(80, bench[0][1]), (81, bench[0][1][:80])]
    docs = [(k, " ".join([sentence(rng, 20), bench[k % 7][1].upper(), sentence(rng, 10), bench[(k * 3) % 7][1]])) for k in range(40)]
    docs += [(100, None), (101, ""), (102, bench[0][1] * 3), (103, "x " * 30_000 + bench[1][1]), (104, bench[3][1].replace(" ", "-"))]
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 5000)
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    found = decontaminate.contamination(df, spark.createDataFrame(bench, "item_id long, text string"), block_bytes=200 if blocks else 1 << 20).collect()
    assert {r.doc_id: (r.n_words, sum(s.end - s.begin for s in r.spans), list(r["items"])) for r in found} == brute_hits(docs, bench)


def test_cutting_leaves_nothing_of_the_benchmark(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog today ok")], "item_id long, text string")
    df = spark.createDataFrame([(1, "Café: The quick, brown fox jumps over the lazy dog today OK! end", "s"), (2, "clean", None), (3, None, "s")], DOCS + ", source string")
    clash = decontaminate.decontaminated(df.withColumn("spans", F.lit(1)).withColumn("cut", F.lit(2)), bench).filter("doc_id = 1").first()
    assert (clash.spans, clash.cut, clash.text) == (1, 2, "Café: ! end")
    for block_bytes in (1 << 20, 10):
        cut = decontaminate.decontaminated(df, bench, block_bytes=block_bytes)
        assert cut.columns == df.columns
        assert {r.doc_id: (r.text, r.source) for r in cut.collect()} == {1: ("Café: ! end", "s"), 2: ("clean", None), 3: (None, "s")}
    assert decontaminate.contamination(df, bench.limit(0)).filter("size(spans) > 0").count() == 0
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def test_phrases_of_a_large_benchmark_stay_small():
    import tracemalloc

    rng = np.random.default_rng(18)
    texts = [sentence(rng, 15_000) for _ in range(50)]  # some 4 MB
    tracemalloc.start()
    phrases = decontaminate.Phrases.of([str(k) for k in range(50)], texts, 10)
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert len(phrases.lengths) > 700_000 and sum(x.nbytes for x in (phrases.symbols, phrases.lengths, phrases.items, phrases.first)) < 60 << 20


def test_contamination_keeps_names_that_clash(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    df = spark.createDataFrame([(1, "say one two three", 5, 6)], DOCS + ", _row int, _k0 int")
    for block_bytes in (1 << 20, 1):
        got = decontaminate.contamination(df, bench, keep=["doc_id", "_row", "_k0"], block_bytes=block_bytes).first()
        assert (got.doc_id, got._row, got._k0, got.n_words, list(got["items"])) == (1, 5, 6, 4, ["1"])


def test_index_finds_every_phrase():
    rng = np.random.default_rng(8)
    symbols = rng.integers(1, 5, 3000)
    symbols[rng.choice(3000, 40, replace=False)] = 0
    symbols[-1] = 0
    index = decontaminate.FMIndex(symbols, 4)
    table = np.array([[*rng.integers(1, 5, 4)] for _ in range(60)])
    lo, hi = index.search(decontaminate.Phrases(np.zeros(3, np.uint64), table, np.full(60, 4), *[np.zeros(0, np.int64)] * 3))
    for p, a, b in zip(table, lo, hi):
        want = [k for k in range(len(symbols) - 3) if (symbols[k : k + 4] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want
