"""Substring dedup, whitening and conversation repair against brute force."""

import hashlib
import heapq
import itertools
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm import conversations, substring_dedup, whitening

from .conftest import WORD

DOCS = "doc_id long, text string"


# --- substring dedup


def brute_cut(rows, size, levels=False):
    """Per row: (doc_id, n_words, n_removed, kept text), and the longest level of repeats with a smaller id."""
    words = [WORD.findall(t or "") for _, t in rows]

    def firsts(n):
        out = {}
        for (d, _), w in zip(rows, words):
            for k in range(len(w) - n + 1) if d is not None else ():
                key = tuple(w[k : k + n])
                out[key] = min(d, out.get(key, d))
        return out

    first = firsts(size)
    longest = defaultdict(int)
    n = size
    while levels and n <= max(map(len, words), default=0):
        seen = firsts(n)
        for (d, _), w in zip(rows, words):
            if d is not None and any(seen[tuple(w[k : k + n])] < d for k in range(len(w) - n + 1)):
                longest[d] = n
        n *= 2
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1) if d is not None else ():
            if first[tuple(w[k : k + size])] < d:
                gone |= set(range(k, k + size))
        out.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone), longest[d]))
    return out


def passages(seed, n_docs=60, vocabulary=12):
    """Documents of few words, so that windows tie and overlap; copies, shared passages, odd rows."""
    rng = random.Random(seed)
    some = [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([5, 13, 14, 30, 70]))) for _ in range(8)]
    rows = [(None, some[3]), (3, None), (4, ""), (5, " \n\t "), (6, "x " * 300), (7, "x " * 13), (8, "É b " * 9)]
    for k in range(10, n_docs):
        parts = [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.choice([0, 3, 20])))]
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(some))
        rows.append((rng.randrange(10, n_docs), ("\n" if k % 2 else "  ").join(parts)))
    return rows + rows[-4:]


@pytest.mark.parametrize(("seed", "size"), [(1, 13), (2, 13), (3, 4), (4, 25)])
def test_substring_dedup_is_brute_force(spark, seed, size):
    rows = passages(seed)
    docs = spark.createDataFrame([(*r, "clash", 1, None) for r in rows], DOCS + ", digest string, n_words int, alive string").repartition(5)
    got = sorted(map(tuple, substring_dedup.without_repeats(docs, size, longest=True).select("doc_id", "n_words", "n_removed", "text", "longest").collect()), key=repr)
    assert got == sorted(brute_cut(rows, size, True), key=repr)
    plain = sorted(map(tuple, substring_dedup.without_repeats(docs, size).select("doc_id", "n_words", "n_removed", "text").collect()), key=repr)
    assert plain == [r[:4] for r in got]


def test_substring_dedup_levels_and_empty_tables(spark):
    assert substring_dedup.lengths(13) == [7, 13] and substring_dedup.lengths(50) == [7, 13, 25, 50] and substring_dedup.lengths(4) == [4]
    values = np.array([5, 3, 3, 9, 1, 1, 7, 0], np.uint64)
    assert substring_dedup.least_of(values, 3).tolist() == [1, 1, 4, 4, 4, 7]
    assert substring_dedup.without_repeats(spark.createDataFrame([], DOCS)).count() == 0
    alone = [(k, " ".join(f"{k}-{j}" for j in range(40))) for k in range(5)]
    assert substring_dedup.without_repeats(spark.createDataFrame(alone, DOCS)).filter("n_removed > 0").count() == 0


def test_substring_dedup_of_a_common_passage(spark):
    """A passage in every document goes from all but the first, wherever it stands."""
    shared = " ".join(f"s{k}" for k in range(40))
    rows = [(k, " ".join([f"own{k}-{j}" for j in range(k % 9)] + [shared] + [f"end{k}"])) for k in range(400)]
    got = {r.doc_id: r.text for r in substring_dedup.without_repeats(spark.createDataFrame(rows, DOCS).repartition(7)).collect()}
    assert got[0] == rows[0][1] and all(got[k] == " ".join([f"own{k}-{j}" for j in range(k % 9)] + [f"end{k}"]) for k in range(1, 400))


# --- whitening


def plain_whitening(rows, scale=256):
    """Exact integers by Python, the rest by numpy."""
    fine = lambda v: bool(v) and all(c is not None and np.isfinite(c) for c in v)
    x = [(i, [int(np.floor(float(c) * scale)) for c in v]) for i, v in rows if fine(v)]
    distinct = sorted({tuple(v) for _, v in x})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(v[k] for v in distinct) for k in range(d)]
    centred = [[Fraction(v[k]) - Fraction(sums[k], n) for k in range(d)] for v in distinct]
    cov = np.array([[float(sum(v[i] * v[j] for v in centred) / n) for j in range(d)] for i in range(d)])
    values, columns = np.linalg.eigh(cov)
    deviations = [(i, sum((n * v[k] - sums[k]) ** 2 for k in range(d))) for i, v in x]
    return x, n, sums, cov, values[::-1], columns[:, ::-1], deviations


def vectors(seed=3, n=120, d=6):
    rng = np.random.default_rng(seed)
    made = (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + np.arange(d)).astype(np.float32)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(made)]
    rows += [(1000 + k, rows[7][1]) for k in range(60)]  # a hot vector counts once
    rows += [(2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [float("nan")] * d), (2004, [float("inf")] + [0.0] * 5), (2005, [1.0]), (7, rows[7][1])]
    return rows


def test_whitening_is_exact(spark):
    rows = vectors()
    table = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "vec_id long, embedding array<float>, x double, component string").repartition(5)
    got = whitening.whiten(table).collect()
    x, n, sums, cov, values, columns, deviations = plain_whitening([r for r in rows if r[0] != 2005])
    assert {r.n for r in got} == {n} and sorted((r.vec_id, r.deviation) for r in got) == sorted(d for d in deviations for _ in range(4))
    for c in range(4):
        mine = sorted((r.vec_id, r.whitened, r.explained) for r in got if r.component == c + 1)
        want = sorted((i, float((np.array(v) - np.array(sums) / n) @ columns[:, c] / np.sqrt(values[c]))) for i, v in x)
        sign = np.sign(mine[0][1] * want[0][1])
        assert [m[0] for m in mine] == [w[0] for w in want] and np.allclose([m[1] for m in mine], [sign * w[1] for w in want], atol=1e-9)
        assert all(abs(m[2] - values[c] / np.trace(cov)) < 1e-12 for m in mine)
    assert {r.identity_error for r in got} < {min(r.identity_error for r in got)} | {1.0} and got[0].identity_error < 1e-9


def test_cross_products_on_bit_planes(spark):
    """Wide, narrow and constant dimensions, negative numbers, blocks of other sizes than a word."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(-(2**40), 2**40, 333), rng.integers(-3, 4, 333), np.full(333, -9), rng.integers(0, 2, 333)])
    frame = spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>").repartition(6)
    low = x.min(axis=0).tolist()
    bits = [int(v).bit_length() for v in x.max(axis=0) - x.min(axis=0)]
    got = {(r.i, r.j): sum(int(r[f"p{k}"]) << 40 * k for k in range(4)) for r in whitening.cross_products(frame, low, bits).collect()}
    y = (x - x.min(axis=0)).astype(object)
    assert all(got.get((i, j), 0) == (y[:, i] * y[:, j]).sum() for i, j in itertools.combinations_with_replacement(range(4), 2))


def test_whitening_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 3.0]) for k in range(5)], schema)).collect()
    assert sorted((r.component, r.explained) for r in flat) == [(1, 1.0)] * 5 + [(2, 0.0)] * 5
    assert {r.whitened is None for r in flat if r.component == 2} == {True} and {r.whitened is None for r in flat if r.component == 1} == {False}
    huge = whitening.whiten(spark.createDataFrame([(k, [k * 2.0**45, float(k)]) for k in range(9)], schema)).collect()
    assert len(huge) == 18 and all((r.deviation is None) == (r.vec_id != 4) for r in huge)
    assert whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0])], schema)).count() == 0


# --- conversation repair


def cheapest(rows):
    """Least (cost, edits) of (role, must go, truncated), by trying ways in order of cost and string."""
    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best, heap = None, [(0, "", 0, 0)]
    while heap:
        cost, edits, k, state = heapq.heappop(heap)
        if best and cost > best[0] or len(edits) > 2 * len(rows) + 4:
            continue
        if k == len(rows) and state in (0, 3):
            best = min(best or (cost, edits), (cost, edits))
        put = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        heapq.heappush(heap, (cost + 2, edits + "I", k, put))
        if k < len(rows):
            role, gone, cut = rows[k]
            heapq.heappush(heap, (cost + 3, edits + "D", k + 1, state))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, edits + "R", k + 1, put))
                if (role[:1], state) in keep:
                    heapq.heappush(heap, (cost + cut, edits + "K", k + 1, keep[role[:1], state]))
    return best


def edits_of(rows):
    repair, told = conversations.Repair(), []
    for role, gone, cut in rows:
        repair.step(role, "x", 0, gone, cut)
        told += [e for e, _ in repair.told()]
    cost, rest = repair.end()
    return cost, "".join(told + [e for e, _ in rest])


def test_repair_is_the_cheapest_and_least():
    rng = random.Random(11)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "user", "tool", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 6))]
        assert edits_of(rows) == cheapest(rows)


def test_repair_holds_what_is_unresolved_alone():
    repair, most = conversations.Repair(), 0
    rng = random.Random(2)
    for k in range(20_000):
        repair.step(["user", "assistant"][k % 2] if rng.random() < 0.9 else "tool", "x", k, rng.random() < 0.05, rng.random() < 0.2)
        list(repair.told())
        most = max(most, repair.open())
    assert most < 200
    tied = conversations.Repair()  # users alone: two ways tie to the end, and none of them may be told
    for k in range(3000):
        tied.step("user", "x", k, False, False)
        list(tied.told())
    assert tied.open() > 3000 and edits_of([("user", False, False)] * 6) == cheapest([("user", False, False)] * 6)


def brute_conversations(rows):
    out = {}
    groups = defaultdict(list)
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, space(role), space(text)))
    for conv, turns in groups.items():
        after = []
        for turn, role, text in turns:
            code = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
            if code:
                text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
                after += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, flags, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for turn, role, text in after:
            said = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            flags.append(fault)
            if fault:
                n[fault] += 1
        known = [t for t, _, _ in after if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit = cheapest([(r, f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(after, flags)])
        lines, state, left = [], "", iter(after)
        for e in audit:
            role, text = next(left)[1:] if e != "I" else ("", "")
            if e in "RI":
                role = "assistant" if state == "u" else "user"
            if e != "D":
                state = role[:1]
                lines.append(f"{role}:{text}")
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk(seed, n=40):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        turns = sorted(rng.sample(range(12), rng.randint(1, 6))) + [None] * rng.randrange(2)
        for turn in turns:
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rng.choice([None, "", " \t", "Well.", "Well", "So? ", "No!\n", f"t{turn} x", "a ", "é."])))
    return rows + rows[5:8]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_conversations_are_brute_force(spark, seed):
    rows = talk(seed)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, edit string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in conversations.audited(frame, conversations.damaged(frame)).collect()}
    assert got == brute_conversations(rows)


def test_conversations_give_turns_and_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hm"), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "Yes.")]
    got = conversations.repaired(spark.createDataFrame(rows, schema)).collect()
    assert [(r.edit, r.role, r.text) for r in got[:-1]] == [("K", "user", "Hi."), ("D", "user", "Hm"), ("K", "assistant", "Yes."), ("D", "assistant", "Yes.")] and got[-1].cost == 6
    assert got[-1].edit is None and (got[-1].duplicate, got[-1].truncated, got[-1].illegal) == (1, 1, 2)
    empty = spark.createDataFrame([], schema)
    assert conversations.audited(empty, conversations.damaged(empty)).count() == 0 and conversations.repaired(empty).count() == 0
    gone = conversations.audited(spark.createDataFrame(rows, schema), empty).collect()
    assert [tuple(r) for r in gone] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    long = [(1, k, ["user", "assistant"][k % 2], "word " * (200_000 if k == 3 else 3) + f"{k}.") for k in range(3000)]
    last = conversations.digests(conversations.repaired(spark.createDataFrame(long, schema))).collect()
    assert last[0].audit == "K" * 3000 and last[0].cost == 0
