"""Conversation structure: cheapest repairs to a role grammar by a Viterbi search that streams."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged

#: States of the grammar (s?(ua)+)?: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn's initial leads from each state, and whose turn may be put in, or named anew, there.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
PUT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

WHITE = " \t\n\v\f\r"


class _Node:
    """An edit in the tree of backpointers. It lives while a survivor ends in it or another edit follows it. `order` tells its
    whole string of edits from those of the others that have taken in the same turns: a rank, and edits since."""

    __slots__ = ("parent", "edit", "item", "kids", "heads", "order")

    def __init__(self, parent, edit, item, order=(0, "")):
        self.parent, self.edit, self.item, self.kids, self.heads, self.order = parent, edit, item, set(), 0, order
        if parent is not None:
            parent.kids.add(self)

    def then(self, edit: str) -> tuple[int, str]:
        return self.order[0], self.order[1] + edit


class Repair:
    """The cheapest edits of one conversation's turns, told as soon as all survivors agree on them.

    A survivor is the cheapest way into a state and, of equally cheap ones, that with the least string of edits not told yet.
    Strings that have taken in the same turns and end in one's own edit are never one another's beginning, so their order
    is final: it is kept as a rank, and ties over unresolved suffixes of any length are settled by rank and the few edits
    since. Nor can a tie in cost and state be one string going on from another, whose inserts would cost more. A state is
    given up when another can do whatever it can for strictly less, so that it doesn't keep the others from a common root."""

    def __init__(self):
        self.root = _Node(None, "", None)
        self.best: dict[int, tuple[int, _Node]] = {}
        self._settle({START: (0, self.root)})

    def _settle(self, found: dict[int, tuple[int, _Node]]) -> None:
        """Inserts after a turn's own edits; the survivors; and an end to what none of them holds. An assistant's turn is put
        in last, as nothing but a user's leads to it and that may itself have been put in."""
        lost = [head for _, head in self.best.values()]
        for rank, head in enumerate(sorted((head for _, head in found.values()), key=lambda head: head.order)):
            head.order = rank, ""
        for state in (START, SYSTEM, ASSISTANT, USER):
            if state in found:
                cost, head = found[state]
                to, role = PUT[state]
                if self._better(found.get(to), cost + INSERT, head.then("I")):
                    lost += [found[to][1]] if to in found else []
                    found[to] = (cost + INSERT, _Node(head, "I", (role, "", None), head.then("I")))
        if ASSISTANT in found:
            least = found[ASSISTANT][0]
            # From the start one can keep a system turn that the assistant's state must delete; after it, nothing more.
            for state, most in ((START, least + DELETE), (SYSTEM, least)):
                if state in found and found[state][0] > most:
                    lost.append(found.pop(state)[1])
        for _, head in self.best.values():
            head.heads -= 1
        self.best = found
        for _, head in found.values():
            head.heads += 1
        for head in lost:
            self._free(head)

    @staticmethod
    def _better(old: tuple[int, _Node] | None, cost: int, order: tuple[int, str]) -> bool:
        return old is None or (cost, order) < (old[0], old[1].order)

    def _free(self, node: _Node) -> None:
        while not node.heads and not node.kids and node.parent is not None:
            parent, node.parent = node.parent, None
            parent.kids.discard(node)
            node = parent

    def step(self, role: str, text: str, turn, must_go: bool, truncated: bool) -> None:
        """One turn more: every survivor deletes it, or keeps or renames it where it may."""
        found: dict[int, tuple[int, _Node]] = {}
        for state, (cost, head) in self.best.items():
            ways = [(state, cost + DELETE, "D", role)]
            if not must_go:
                if (to := NEXT.get(role[:1], {}).get(state)) is not None:
                    ways.append((to, cost + TRUNCATED * truncated, "K", role))
                to, named = PUT[state]
                ways.append((to, cost + REROLE + TRUNCATED * truncated, "R", named))
            for to, total, edit, said in ways:
                if self._better(found.get(to), total, head.then(edit)):
                    if to in found:
                        self._free(found[to][1])
                    found[to] = (total, _Node(head, edit, (said, text, turn), head.then(edit)))
        self._settle(found)

    def told(self) -> Iterator[tuple[str, tuple]]:
        """Edits that all survivors share and that were not told before."""
        while not self.root.heads and len(self.root.kids) == 1:
            (self.root,) = self.root.kids
            self.root.parent = None
            edit, self.root.edit = self.root.edit, ""
            yield edit, self.root.item
            self.root.item = None

    def end(self) -> tuple[int, list[tuple[str, tuple]]]:
        """The cost, and the edits not told yet."""
        cost, head = min((self.best[state] for state in (START, ASSISTANT) if state in self.best), key=lambda x: (x[0], x[1].order))
        rest = []
        while head is not self.root:
            rest.append((head.edit, head.item))
            head = head.parent
        return cost, rest[::-1]

    def open(self) -> int:
        """Edits in the tree."""
        n, todo = 0, [self.root]
        while todo:
            todo += (kids := todo.pop().kids)
            n += len(kids)
        return n


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with faults put in by the CRC of `conv_id:turn`: dropped, emptied, without their
    sentence ends, doubled, or said by the user. A null is one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), code.alias("_code")).filter("_code <> 0")
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_code") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("_copy")


def _flagged(turns: DataFrame, staged: Staged) -> DataFrame:
    """Turns with `again`: role and text stand earlier in the conversation. The first of equal turns is found by minima that
    are taken before the shuffle, so one turn said a million times is a row a task."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    same = F.sha2(F.concat_ws("\x00", F.length(space("role")).cast("string"), space("role"), space("text")).cast("binary"), 256)
    rows = staged.write("turns", turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), same.alias("_same"), F.monotonically_increasing_id().alias("_at")))
    place = F.struct("turn", "_at")  # a null turn is the least
    first = rows.groupBy("conv_id", "_same").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select(F.col("conv_id").alias("_conv"), F.col("_same").alias("_it"), F.col("_first._at").alias("_first"))
    on = rows["conv_id"].eqNullSafe(first["_conv"]) & (rows["_same"] == first["_it"])
    return rows.join(first, on, "left").select("conv_id", "turn", "role", "text", "_at", F.coalesce(F.col("_at") != F.col("_first"), F.lit(False)).alias("again"))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired(turns: DataFrame, keep_staged: Staged | None = None) -> DataFrame:
    """Edits of each conversation in order: (conv_id, turn, edit, role, text, and, in a last row whose edit is null, counts of
    gaps, blank, duplicate, truncated and illegal turns and the cost).

    `turns` are (conv_id, turn, role, text), by turn with nulls first; turns that tie go by role and text. Null roles and texts
    count as one space. Edits are K(eep), R(erole to user or assistant, 2), D(elete, 3, a must for blank and duplicate
    turns) and I(nsert an empty user's or assistant's turn, 2); a truncated turn that stays costs 1. They make the roles'
    initials (s?(ua)+)? at the least cost, and of equal costs have the least string. Role and text of a row are those
    after the edit; deleted turns show what they were. Rows of a conversation follow each other inside one partition.

    Null ids are a conversation of their own. Repeated rows are duplicates. An empty table gives no rows; extra columns are
    not read. A task streams its sorted turns and holds, of any conversation, the edits on which survivors differ."""
    staged = keep_staged or Staged(turns.sparkSession, "conversations")
    flagged = _flagged(turns, staged)
    kind, number = turns.schema["conv_id"].dataType.simpleString(), turns.schema["turn"].dataType.simpleString()
    schema = f"conv_id {kind}, turn {number}, edit string, role string, text string, " + ", ".join(f"{c} long" for c in COUNTS)
    names = ["conv_id", "turn", "edit", "role", "text", *COUNTS]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        types = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        state = None
        for batch in it:
            types = types or [batch.schema.field("conv_id").type, batch.schema.field("turn").type, pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS)]
            for conv, turn, role, text, again in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "again"))):
                if state is None or state.conv != conv:
                    if state is not None:
                        out += state.end()
                    state = _Stream(conv)
                out += state.take(turn, role, text, again)
                size += len(text)
                if len(out) >= 4096 or size > 1 << 20:
                    if out:
                        yield batch_of(out)
                    out, size = [], 0
        if state is not None:
            out += state.end()
        if out:
            yield batch_of(out)

    ordered = flagged.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_at")
    return ordered.select("conv_id", "turn", "role", "text", "again").mapInArrow(run, schema)


class _Stream:
    """One conversation's turns as they come."""

    def __init__(self, conv):
        self.conv, self.repair, self.counts, self.last = conv, Repair(), dict.fromkeys(COUNTS, 0), None
        self.low = self.high = self.turn = None
        self.distinct = 0

    def _rows(self, edits) -> list[tuple]:
        return [(self.conv, turn, edit, role, text, *[None] * len(COUNTS)) for edit, (role, text, turn) in edits]

    def take(self, turn, role: str, text: str, again: bool) -> list[tuple]:
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn, self.distinct = turn if self.low is None else self.low, turn, turn, self.distinct + 1
        said = text.rstrip(WHITE)
        fault = "blank" if not said else "duplicate" if again else "truncated" if said[-1] not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.last = role[:1]
        self.repair.step(role, text, turn, fault in ("blank", "duplicate"), fault == "truncated")
        return self._rows(self.repair.told())

    def end(self) -> list[tuple]:
        self.counts["cost"], rest = self.repair.end()
        if self.distinct:
            self.counts["gaps"] = self.high - self.low + 1 - self.distinct
        return [*self._rows(rest), (self.conv, None, None, None, None, *self.counts.values())]


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, counts, audit, repaired_sha256) of the rows that `repaired` gives: the string of edits, and the digest of what
    is left as lines `role:text`. Rows are read in their order, and a conversation's text is hashed as it passes by."""
    kind = edits.schema["conv_id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, mark = [], hashlib.sha256(), b""
        for batch in it:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text", *COUNTS)]
            for conv, edit, role, text, *counts in zip(*columns):
                if edit is None:
                    done.append((conv, *counts, "".join(audit), digest.hexdigest()))
                    audit, digest, mark = [], hashlib.sha256(), b""
                    continue
                audit.append(edit)
                if edit != "D":
                    digest.update(mark + f"{role}:{text}".encode())
                    mark = b"\n"
            if done:
                types = [batch.schema.field("conv_id").type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], ["conv_id", *COUNTS, "audit", "repaired_sha256"])

    return edits.select("conv_id", "edit", "role", "text", *COUNTS).mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")


def audited(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """`digests` of repaired `turns` for every conv_id of `conversations`; one without turns has zeros, no edits and the digest of
    an empty text."""
    found = digests(repaired(turns))
    all_ids = conversations.select("conv_id").distinct()
    found = found.withColumnRenamed("conv_id", "_conv")
    joined = all_ids.join(found, all_ids["conv_id"].eqNullSafe(found["_conv"]), "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS]
    return joined.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
