"""Language identification: each document is a mixture of languages whose shares expectation-maximisation finds from the
n-gram likelihoods of its words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged
from .textkit import LOWER, batches, text_bytes

BITS = 17
#: Languages whose 2^BITS counts each are in memory and broadcast at once. More languages are taken block by block.
BLOCK = 64
SMOOTHING = 0.1
#: A language enters a document's set where it raises the log-likelihood by more than PENALTY * log(words).
PENALTY = 2.0
#: What a text's log-likelihood may lack to its maximum when expectation-maximisation ends.
TOLERANCE = 0.01

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram of each letter and each word end, first gram of each word, first word of each text with one bound more).
    A gram is a letter's byte with the two before it, hashed to BITS bits; all that is not a letter is one blank."""
    data, at = text_bytes(column)
    n = len(at) - 1
    room = np.full(len(data) + n + 1, 0x20, np.uint8)  # a blank before each text and at the end
    inside = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(at))
    low = LOWER[data]
    room[inside] = np.where(_LETTER[low], low, 0x20)
    letter = _LETTER[room]
    word_start = letter.copy()
    word_start[1:] &= ~letter[:-1]
    use = letter.copy()
    use[1:] |= letter[:-1]
    wide = room.astype(np.uint32)
    before = np.concatenate([np.full(2, 0x20, np.uint32), wide])
    code = wide | before[1:-1] << np.uint32(8) | np.where(word_start, np.uint32(0x20), before[:-2]) << np.uint32(16)
    hashed = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    places = np.flatnonzero(use)
    starts = np.flatnonzero(word_start)
    first_words = np.searchsorted(starts, at + np.arange(n + 1))
    return hashed[places], np.searchsorted(places, starts), first_words


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log-likelihood of each gram by language

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each word by language, and the first word of each text."""
        gram, start, first = grams(column)
        if not len(start):
            return np.zeros((0, len(self.languages)), np.float32), first
        return np.add.reduceat(self.table[gram], start, axis=0), first


def _likelihoods(logs: np.ndarray) -> np.ndarray:
    """Likelihoods of words, each over its largest."""
    return np.exp(logs - logs.max(axis=1, keepdims=True))


def _of_rows(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of some texts, and the first of each of these with one bound more."""
    n = np.diff(first)[rows]
    return np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.concatenate([[0], np.cumsum(n)])


def shares(like: np.ndarray, first: np.ndarray, allowed: np.ndarray, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's maximum-likelihood shares of its `allowed` languages, the log-likelihood, and a bound on what that lacks
    to its maximum, TOLERANCE at most; all documents have words.

    The log-likelihood is concave in the shares, so what it can still gain is bounded by its steepest slope: for n words,
    n * (the largest mean, over words, of a language's likelihood to the mixture's, less 1). Rounds go on until that is within
    TOLERANCE, however many. The mean ratio is also what a round multiplies a share by; rounds that gain are followed by ones
    that take the ratio to twice the power, and one that loses is taken back to a plain round, which never loses."""
    theta = np.where(allowed, 1.0, 0.0) if begin is None else np.where(allowed, np.maximum(begin, 1e-12), 0.0)
    theta /= theta.sum(axis=1, keepdims=True)
    fit, gap = np.zeros(len(theta)), np.zeros(len(theta))
    open_, like, n = np.arange(len(theta)), like.astype(np.float64), np.diff(first)
    now, before, last, by, power = theta.copy(), theta.copy(), np.full(len(theta), -np.inf), np.ones_like(theta), np.ones(len(theta))
    while len(open_):
        mixed = np.maximum((like * np.repeat(now, n, axis=0)).sum(axis=1), 1e-300)
        ratio = np.add.reduceat(like / mixed[:, None], first[:-1], axis=0) / n[:, None]
        ratio[~allowed[open_]] = 0
        value = np.add.reduceat(np.log(mixed), first[:-1])
        lost = (value < last) & (power > 1)
        left = n * np.maximum(ratio.max(axis=1) - 1, 0)
        done = ~lost & (left <= TOLERANCE)
        theta[open_[done]], fit[open_[done]], gap[open_[done]] = now[done], value[done], left[done]
        power = np.where(lost, 1, np.minimum(2 * power, 1024))
        before, last, by = np.where(lost[:, None], before, now), np.where(lost, last, value), np.where(lost[:, None], by, ratio)
        power[lost] = 1
        step = np.exp(power[:, None] * np.log(np.maximum(by, 1e-300)))
        now = before * np.minimum(step, 1e100)
        now = np.where(allowed[open_], np.maximum(now / now.sum(axis=1, keepdims=True), 1e-200), 0)
        if done.any():
            picked, bounds = _of_rows(first, np.flatnonzero(~done))
            like, first, n = like[picked], bounds, n[~done]
            open_, now, before, last, by, power = (x[~done] for x in (open_, now, before, last, by, power))
    return theta, fit, gap


def mixtures(like: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Shares after selection: languages go one by one, the least first, while the penalised likelihood rises. A document is of
    one language where no larger set can be worth its cost: the likelihood of all words each in its best language (which
    is 1 here), or that of the best mixture of all languages, bounds what any set can reach."""
    n_docs, n_lang = len(first) - 1, like.shape[1]
    cost = PENALTY * np.log(np.diff(first) + 1.0)
    alone = np.add.reduceat(np.log(np.maximum(like.astype(np.float64), 1e-30)), first[:-1], axis=0)
    top = alone.argmax(axis=1)
    out = np.zeros((n_docs, n_lang))
    single = alone.max(axis=1) >= -cost
    open_ = np.flatnonzero(~single)
    if len(open_):
        picked, bounds = _of_rows(first, open_)
        theta, fit, gap = shares(like[picked], bounds, np.ones((len(open_), n_lang), bool))
        one = alone[open_].max(axis=1) >= fit + gap - cost[open_]
        single[open_[one]] = True
        open_, theta, fit = open_[~one], theta[~one], fit[~one]
    out[single, top[single]] = 1
    allowed = np.ones((len(open_), n_lang), bool)
    score = fit - cost[open_] * (n_lang - 1) if len(open_) else np.zeros(0)
    if len(open_):
        out[open_] = theta
    while len(open_):
        smaller = allowed.copy()
        smaller[np.arange(len(open_)), np.where(allowed, theta, np.inf).argmin(axis=1)] = False
        picked, bounds = _of_rows(first, open_)
        theta, fit, _ = shares(like[picked], bounds, smaller, theta)
        new = fit - cost[open_] * (smaller.sum(axis=1) - 1)
        better = new > score
        out[open_[better]] = theta[better]
        go_on = better & (smaller.sum(axis=1) > 1)
        open_, theta, allowed, score = open_[go_on], theta[go_on], smaller[go_on], new[go_on]
    return out


def learn(docs: DataFrame, staged: Staged, block: int = BLOCK) -> list[Model]:
    """Gram counts of every given document (text, lang), by language: a model for each block of languages."""
    names = sorted(r.lang for r in docs.select("lang").distinct().collect())
    place = {x: k for k, x in enumerate(names)}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches(it):
            gram, start, first = grams(batch.column("text"))
            lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            bounds = np.append(start, len(gram))[first]
            new, count = np.unique(np.repeat(lang, np.diff(bounds)) << BITS | gram[: bounds[-1]], return_counts=True)
            at, both = np.unique(np.concatenate([at, new]), return_inverse=True)
            n = np.bincount(both, np.concatenate([n, count]), minlength=len(at)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["at", "n"])

    counted = staged.write("counts", docs.select("text", "lang").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")))
    models = []
    for lo in range(0, len(names), block):
        some = names[lo : lo + block]
        rows = counted.filter((F.col("at") >= lo << BITS) & (F.col("at") < lo + len(some) << BITS)).toArrow()
        counts = np.full(len(some) << BITS, SMOOTHING)
        counts[rows.column("at").to_numpy() - (lo << BITS)] += rows.column("n").to_numpy()
        counts = counts.reshape(len(some), -1)
        models.append(Model(some, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()))
    return models


def _has_letter(text: pa.Array) -> np.ndarray:
    data, at = text_bytes(text)
    some, wide = (np.concatenate([[0], np.cumsum(x)]) for x in ((LOWER[data] >= 0x61) & (LOWER[data] < 0x7B), data >= 0x80))
    has = some[at[1:]] > some[at[:-1]]
    for k in np.flatnonzero(~has & (wide[at[1:]] > wide[at[:-1]])):
        has[k] = any(map(str.isalpha, text[int(k)].as_py()))
    return has


def _decided(doc_ids: pa.Array, rows: np.ndarray, theta: np.ndarray, names: list[list[str]]) -> pa.RecordBatch:
    """Rows of the result; `names` are the languages of theta's columns for each of `rows`, the other texts are "und"."""
    pred, score, found = ["und"] * len(doc_ids), np.zeros(len(doc_ids)), [[] for _ in range(len(doc_ids))]
    for k, share, langs in zip(rows.tolist(), theta, names):
        order = [j for j in np.argsort(-share, kind="stable").tolist() if share[j] > 0]
        found[k] = [(langs[j], float(share[j])) for j in order]
        pred[k], score[k] = langs[order[0]], min(1.0, float(share[order[0]]))
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(pred), pa.array(score), pa.array(found, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "shares"])


KEPT = "array<struct<lang:string,logs:binary>>"


def identify(docs: DataFrame, train=None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", block: int = BLOCK) -> DataFrame:
    """(doc_id, lang_pred, score, shares) of every whole text: its main language, that language's share of the words, and
    the shares of all languages in the set that is left when none can go without loss of penalised likelihood (see `mixtures`).
    Shares are those of the maximum likelihood: expectation-maximisation goes on until it lacks TOLERANCE at most.

    Grams are counted over all documents with a language for which `train` holds (sums of each task go to the shuffle,
    so a language that most documents have is one row of it a gram and task); the model's size depends on the languages
    alone. With more than `block` languages, each block of them gives the set that it would choose, and the mixture over
    these sets' languages is inferred at the end; no language is left out. Prediction reads nothing but the text.

    A null text, one without a letter, and any text where nothing could be learned are "und" with score 0 and no shares.
    Repeated and null ids give a row each; an empty table gives none."""
    spark = docs.sparkSession
    staged = Staged(spark, "language")
    source = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    source = source.filter(train) if train is not None else source
    models = learn(source.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), staged, block)
    staged.drop("counts")
    kind = docs.schema[id_col].dataType.simpleString()
    result = f"doc_id {kind}, lang_pred string, score double, shares map<string,double>"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if len(models) < 2:
        shared = spark.sparkContext.broadcast(models[0] if models else None)

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches(it):
                rows, theta, names = np.zeros(0, np.int64), np.zeros((0, 0)), []
                if model:
                    logs, first = model.words(batch.column("text"))
                    rows = np.flatnonzero(_has_letter(batch.column("text")) & (np.diff(first) > 0))
                    if len(rows):
                        picked, bounds = _of_rows(first, rows)
                        theta, names = mixtures(_likelihoods(logs[picked]), bounds), [model.languages] * len(rows)
                yield _decided(batch.column("doc_id"), rows, theta, names)

        return texts.mapInArrow(run, result)

    def one_block(shared):
        """Adds the languages that a block would choose, with the log-likelihoods of all words."""

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches(it):
                logs, first = model.words(batch.column("text"))
                kept = [x or [] for x in batch.column("kept").to_pylist()]
                rows = np.flatnonzero(_has_letter(batch.column("text")) & (np.diff(first) > 0))
                if len(rows):
                    picked, bounds = _of_rows(first, rows)
                    for k, share in zip(rows.tolist(), mixtures(_likelihoods(logs[picked]), bounds)):
                        kept[k] += [{"lang": model.languages[j], "logs": logs[first[k] : first[k + 1], j].tobytes()} for j in np.flatnonzero(share)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(kept, pa.list_(pa.struct([("lang", pa.string()), ("logs", pa.binary())])))], ["doc_id", "text", "kept"])

        return run

    def final(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows, theta, names = [], [], []
            for k, kept in enumerate(batch.column("kept").to_pylist()):
                if kept:
                    logs = np.stack([np.frombuffer(x["logs"], np.float32) for x in kept], axis=1)
                    rows.append(k)
                    theta.append(mixtures(_likelihoods(logs), np.array([0, len(logs)]))[0])
                    names.append([x["lang"] for x in kept])
            yield _decided(batch.column("doc_id"), np.array(rows, np.int64), theta, names)

    found = texts.withColumn("kept", F.lit(None).cast(KEPT))
    for model in models:
        found = found.mapInArrow(one_block(spark.sparkContext.broadcast(model)), f"doc_id {kind}, text string, kept {KEPT}")
    return found.select("doc_id", "kept").mapInArrow(final, result)
