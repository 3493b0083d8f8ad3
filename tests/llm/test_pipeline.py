import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import queries

from .conftest import WORD, lower, sentence
from .test_operators import all_windows, brute_groups, brute_scores


def write(spark, folder, docs, bench, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages(spark, tmp_path):
    rng = np.random.default_rng(9)
    passage, item = sentence(rng, 60), sentence(rng, 14)
    texts = {k: sentence(rng, 80) for k in range(300)}
    for k in range(0, 300, 5):
        texts[k] += " vile vile"
    texts[301] = texts[1] + " more"
    texts[302], texts[303], texts[304], texts[305] = (f"{sentence(rng, 30)} {x} {sentence(rng, 30)}" for x in (passage, passage, item, "plain"))
    docs = [(k, t, "en", "s", len(t)) for k, t in texts.items()] + [(400, None, None, None, None), (401, "", "en", "s", 0)]
    folder = f"file://{tmp_path}"
    write(spark, folder, docs, [(1, item)], [(k, 1, int(k % 5 == 0)) for k in range(300)])
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{folder}/{name}"
        stage(spark, kept, folder).write.parquet(out)
        kept = seen[name] = spark.read.parquet(out)
    assert [c for c in seen["decontamination"].columns] == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: {r.doc_id for r in seen[name].select("doc_id").collect()}
    clean = {*texts, 400, 401} - {*range(0, 300, 5)}
    assert ids("toxicity") == clean
    assert ids("near_dedup") == clean - {301} == ids("suffix_dedup") == ids("decontamination") == ids("packing")
    text = lambda name: {r.doc_id: r.text for r in seen[name].collect()}
    assert passage in text("suffix_dedup")[302] and passage not in text("suffix_dedup")[303]
    assert item in text("suffix_dedup")[304] and item not in text("decontamination")[304]
    assert text("decontamination")[305] == texts[305]
    assert corpus_pipeline.run(spark, folder).agg({"length": "sum"}).first()[0] == seen["packing"].agg({"length": "sum"}).first()[0]


def without_words(text, pattern, marks):
    """The text without the runs of marked words, what lies between the words of a run included."""
    raw, out, at = text.encode(), b"", 0
    places = [m.span() for m in re.finditer(pattern, lower(text).encode())]
    for k, (lo, hi) in enumerate(places):
        if marks[k]:
            out += b"" if k and marks[k - 1] else raw[at:lo]
            at = hi
    return (out + raw[at:]).decode()


def brute_benchmark(text, items):
    words = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text).encode())
    marks = [0] * len(words)
    for item in items:
        w = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(item).encode())
        for j in range(max(1, len(w) - 9) if w else 0):
            phrase = w[j : j + 10]
            for k in range(len(words) - len(phrase) + 1):
                if words[k : k + len(phrase)] == phrase:
                    marks[k : k + len(phrase)] = [1] * len(phrase)
    return marks


def test_each_stage_against_brute_force(spark, tmp_path):
    """Documents with toxic words, near copies, shared passages, benchmark passages and gaps, through all stages in turn;
    what a stage is given is what the brute-force version of the stage before it leaves."""
    rng = np.random.default_rng(22)
    passage, items = sentence(rng, 70), [sentence(rng, 14, "b"), sentence(rng, 6, "b"), "!!", None]
    texts = {k: sentence(rng, int(rng.integers(5, 60))) + (" vile vile words" if k % 6 == 0 else "") for k in range(150)}
    for k in range(150, 190):
        near = texts[k - 149].split()
        texts[k] = " ".join([*near[: len(near) - k % 3], "tail"])
    for k in range(190, 210):
        texts[k] = f"{sentence(rng, 20)} {passage if k % 3 else passage[:200]} {sentence(rng, 9)}, {(items[k % 2]).upper()}; {sentence(rng, 5)}"
    texts |= {300: None, 301: "", 302: " \n "}
    docs = [(k, t, "en", "s", len(t) if t else None) for k, t in texts.items()]
    labels = {k: int(k % 6 == 0) for k in range(150)}
    folder = f"file://{tmp_path}"
    write(spark, folder, docs, list(enumerate(items)), [(k, 1, y) for k, y in labels.items()])
    stages = dict(corpus_pipeline.STAGES)

    def run(name, rows):
        given = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        return stages[name](spark, given, folder)

    learn = {k: y for k, y in labels.items() if zlib.crc32(str(k).encode()) % 3 != 1}
    scores = brute_scores(list(texts.items()), learn)
    want = {k: t for k, t in texts.items() if scores[k] < 0.7}
    assert 0 < len(texts) - len(want) and {r.doc_id: r.text for r in run("toxicity", texts).collect()} == want

    rows, groups = want, brute_groups(list(want.items()), 80)
    want = {k: t for k, t in rows.items() if groups[k][1] == k}
    assert len(want) < len(rows) and {r.doc_id: r.text for r in run("near_dedup", rows).collect()} == want

    rows, marks = want, all_windows(list(want.items()))
    want = {k: without_words(t, rb"[^\x20\x09-\x0d]+", marks[k]) if k in marks else t for k, t in rows.items()}
    found = run("suffix_dedup", rows)
    assert len(marks) > 5 and {r.doc_id: r.text for r in found.collect()} == want
    assert found.filter("n_chars <> length(text)").count() == 0

    rows = want
    want = {k: without_words(t, rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", brute_benchmark(t, [i for i in items if i])) if t else t for k, t in rows.items()}
    assert want != rows and {r.doc_id: r.text for r in run("decontamination", rows).collect()} == want

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = sorted(run("packing", want).collect(), key=lambda r: (r.sequence_id, r.offset))
    got: dict[int, list[int]] = {}
    for n, r in enumerate(pieces):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
        assert (r.sequence_id * 2048 + r.offset) == sum(x.length for x in pieces[:n])
    assert got == {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in want.items()}


def test_stages_of_empty_tables_and_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = f"file://{tmp_path}"
    odd = [(1, "one two", None, None, None), (1, "one two", None, None, None), (1, "three", None, None, None), (None, "one two", None, None, 1), (2, None, "en", "s", None), (3, "", None, "s", 0), (4, "word " * 30_000, "en", None, 1)]
    write(spark, folder, odd, [], [])
    extra = spark.createDataFrame(odd, schema).withColumns({c: F.lit(7) for c in ("score", "spans", "_spans", "print", "cut", "items", "n_words", "kept", "_row", "id")})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, extra.limit(0), folder).count() == 0, name
        out = stage(spark, extra, folder)
        if name != "packing":
            assert out.columns == extra.columns, name
            assert Counter(r.doc_id for r in out.collect()) == {1: 3, None: 1, 2: 1, 3: 1, 4: 1}, name
        else:
            assert out.filter("doc_id = 4").agg(F.max("doc_tokens")).first()[0] > 30_000 and {r.doc_id for r in out.collect()} == {1, None, 2, 3, 4}


def test_held_out_folds(spark):
    got = queries.op5_language(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == "und" for r in got) < len(got)
