"""Conversation structure repair by a Viterbi search with survivor coalescence.

A conversation is read in order of turn (nulls first). Every row may be kept (0), given
the role user or assistant (1) or deleted (2), and an empty row of one of these roles
may be inserted anywhere (5). A blank row, or one whose role and text stood earlier,
must be deleted; a truncated row (its last character is none of . ! ?) costs 5 more
unless deleted. What stays must have the role initials ``(s?(ua)+)?``. Of the cheapest
edits those whose initials (K, R, D, I in order) are least in ASCII are taken.

The search keeps one survivor for each state of that pattern. Survivors are leaves of a
tree of back pointers whose nodes count their references: a node that nothing refers to
goes, and as long as the root has one child only, and is no survivor, all survivors
share that edit, so it is sent out and the root moves on. Survivors of equal cost are
compared by their whole unresolved suffixes, back to where they part. (Equal costs
in one state after the same rows mean that no suffix is the start of the other, so the
least one stays least with whatever follows.) A survivor that another undercuts by more
than any future can make up for goes as well, so that an unused start state does not
hold the root. Memory is the unresolved rows, not the conversation.

Scale: rows are dealt by ``conv_id`` once, sorted within the partitions (Spark spills),
and pass through the search as a stream; nothing is gathered per conversation. The
order within one conversation, and so one digest over its text, is sequential by nature:
a giant conversation is one stream in one task, in bounded memory.

Defined cases: a null ``conv_id`` is one conversation, a null turn comes first; null
roles and texts are one space, and an empty role has no initial, so it cannot be kept;
rows of equal turn go by role, then text; repeated rows
are duplicates; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.common import ready, slices

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)                  # states: the last initial that stays
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# (state, better state, slack): whatever may follow the first may follow the second at
# ``slack`` more at most: a kept system row is deleted, a missing assistant row inserted
DOMINATED = ((START, ASSISTANT, DELETE), (SYSTEM, ASSISTANT, 0), (START, USER, DELETE + INSERT), (SYSTEM, USER, INSERT))
LEGAL = {"su", "ua", "au"}
FAULTS = ("blank", "duplicate", "truncated")


class Node:
    """An edit on the way to a survivor; ``row`` is what it leaves: (role, text) or None."""
    __slots__ = ("parent", "kids", "heads", "depth", "edit", "row", "turn", "fault")

    def __init__(self, parent, edit, row, turn=None, fault=None):
        self.parent, self.edit, self.row, self.turn, self.fault = parent, edit, row, turn, fault
        self.kids, self.heads = set(), 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.kids.add(self)


def _release(node: Node) -> None:
    """Drop a node that no survivor and no other node refers to, and so on upwards."""
    while node.parent is not None and not node.heads and not node.kids:
        parent = node.parent
        parent.kids.discard(node)
        node.parent = None
        node = parent


def _before(a: Node, b: Node) -> bool:
    """Whether the unresolved suffix of ``a`` is less than that of ``b``."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Repair:
    """The search over one conversation: rows go in, resolved edits come out."""

    def __init__(self):
        self.root = Node(None, "", None)
        self.live: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.root.heads = 1

    def _offer(self, new: dict, state: int, cost: int, parent: Node, *edit) -> None:
        have = new.get(state)
        if have is not None and have[0] < cost:
            return
        node = Node(parent, *edit)
        if have is not None and have[0] == cost and not _before(node, have[1]):
            _release(node)
            return
        node.heads += 1
        new[state] = (cost, node)
        if have is not None:
            have[1].heads -= 1
            _release(have[1])

    def _insert(self, live: dict) -> None:
        """Rows that may be put in here: at most one lap through user and assistant."""
        for state, after in ((START, "u"), (SYSTEM, "u"), (ASSISTANT, "u"), (USER, "a"), (ASSISTANT, "u")):
            if state in live:
                cost, node = live[state]
                self._offer(live, NEXT[state][after], cost + INSERT, node, "I", (ROLES[after], ""))

    def step(self, role: str, text: str, turn, fault: str | None) -> Iterator[Node]:
        """Take the next row; give the edits that are now certain."""
        self._insert(self.live)
        new: dict[int, tuple[int, Node]] = {}
        extra = TRUNCATED if fault == "truncated" else 0
        for state, (cost, node) in self.live.items():
            self._offer(new, state, cost + DELETE, node, "D", None, turn, fault)
            if fault in ("blank", "duplicate"):
                continue
            for initial, to in NEXT[state].items():
                if role[:1] == initial:
                    self._offer(new, to, cost + extra, node, "K", (role, text), turn, fault)
                elif initial in ROLES:
                    self._offer(new, to, cost + extra + REROLE, node, "R", (ROLES[initial], text), turn, fault)
        for _, node in self.live.values():
            node.heads -= 1
            _release(node)
        self.live = new
        for state, better, slack in DOMINATED:
            if state in new and better in new and new[better][0] + slack < new[state][0]:
                _, node = new.pop(state)
                node.heads -= 1
                _release(node)
        return self._settled()

    def _settled(self) -> Iterator[Node]:
        while not self.root.heads and len(self.root.kids) == 1:
            node = self.root.kids.pop()
            self.root, node.parent = node, None
            yield node

    def end(self) -> tuple[int, list[Node]]:
        """(cost, the edits left) when the conversation is over."""
        self._insert(self.live)
        cost, node = None, None
        for state in (START, ASSISTANT):
            if state in self.live:
                c, n = self.live[state]
                if cost is None or c < cost or c == cost and _before(n, node):
                    cost, node = c, n
        rest = []
        while node is not self.root:
            rest.append(node)
            node = node.parent
        return cost, rest[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by crc32 of ``conv_id:turn`` modulo 20: 0 is dropped (kept here
    with ``gone``, as its conversation must be known), 1 loses its text, 2 its . ! ?, 3
    stands twice and 4 has the role user."""
    own = conversations.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    own = own.withColumn("kind", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return own.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                      text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, gone) dealt by conversation, with ``fault``, the
    first of FAULTS that holds; each conversation in order."""
    ready(rows.sparkSession)
    rows = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    solid = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(solid == "", FAULTS[0]).when(F.row_number().over(same) > 1, FAULTS[1]) \
        .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), FAULTS[2])
    return rows.withColumn("fault", fault).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


class _Counts:
    """What a conversation's rows show before repair."""

    def __init__(self):
        self.low = self.high = self.last = None
        self.turns, self.illegal, self.initial = 0, 0, None
        self.faults = dict.fromkeys(FAULTS, 0)

    def add(self, turn, role, fault):
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.last:
                self.turns += 1
            self.high = self.last = turn
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if fault:
            self.faults[fault] += 1

    def values(self, cost):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, cost


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
OUT = 1024                     # edits, or about this many KB of text, sent on at once


def _edits(id_type: pa.DataType):
    names = ["conv_id", "nr", "edit", "turn", "role", "text", "fault", *COUNTS]
    types = [id_type, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 3, *[pa.int64()] * len(COUNTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, out, held = (None,) * len(COUNTS), [], 0
        search = counts = conv = None
        nr = 0

        def edit(node):
            nonlocal nr, held
            nr += 1
            role, text = node.row or (None, None)
            held += 64 + len(text or "")
            out.append((conv, nr - 1, node.edit, node.turn, role, text, node.fault, *none))

        def close():
            cost, rest = search.end()
            for node in rest:
                edit(node)
            out.append((conv, nr, None, None, None, None, None, *counts.values(cost)))

        def flush():
            nonlocal out, held
            columns = zip(*out)
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            out, held = [], 0
            return batch
        for batch in slices(batches, limit=1 << 20):
            for this, turn, role, text, gone, fault in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "turn", "role", "text", "gone", "fault"))):
                if search is None or this != conv:
                    if search is not None:
                        close()
                    search, counts, conv, nr = Repair(), _Counts(), this, 0
                if not gone:
                    counts.add(turn, role, fault)
                    for node in search.step(role, text, turn, fault):
                        edit(node)
                if len(out) >= OUT or held >= OUT << 10:
                    yield flush()
        if search is not None:
            close()
        if out:
            yield flush()
    return run


def repair(rows: DataFrame) -> DataFrame:
    """The edits of every conversation of ``rows`` (conv_id, turn, role, text and ``gone``,
    rows that only make their conversation known): conv_id, nr, edit (K, R, D or I), the
    row's turn and fault, and the role and text that stay (null if deleted). A last row
    per conversation has a null edit and the counts COUNTS. The rows of a conversation
    follow each other within a partition; filter on role for the repaired conversations."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = rows.schema["conv_id"].dataType
    rows = with_faults(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone"))
    return rows.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(
        _edits(to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, nr long, edit string, turn long, role string, text string, fault string, "
        + ", ".join(f"{c} long" for c in COUNTS))


def _digests(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, sha, empty = [], hashlib.sha256(), True
        for batch in batches:
            rows = {c: [] for c in ("conv_id", *COUNTS, "audit", "repaired_sha256")}
            columns = {c: batch.column(c) for c in batch.schema.names}
            edits = columns["edit"].to_pylist()
            for i, edit in enumerate(edits):
                if edit is not None:
                    audit.append(edit)
                    if columns["role"][i].is_valid:
                        sha.update(f"{'' if empty else chr(10)}{columns['role'][i].as_py()}:{columns['text'][i].as_py()}".encode())
                        empty = False
                    continue
                for c in ("conv_id", *COUNTS):
                    rows[c].append(columns[c][i].as_py())
                rows["audit"].append("".join(audit))
                rows["repaired_sha256"].append(sha.hexdigest())
                audit, sha, empty = [], hashlib.sha256(), True
            yield pa.record_batch([pa.array(rows["conv_id"], id_type), *(pa.array(rows[c], pa.int64()) for c in COUNTS),
                                   pa.array(rows["audit"], pa.string()), pa.array(rows["repaired_sha256"], pa.string())],
                                  names=list(rows))
    return run


def report(conversations: DataFrame) -> DataFrame:
    """One row per conversation after damage and repair: the counts, the edits' initials
    and the SHA-256 of the repaired conversation (``role:text`` by line). The edits of a
    conversation follow each other, so they are folded where they are, without a shuffle."""
    from pyspark.sql.pandas.types import to_arrow_type
    edits = repair(damaged(conversations))
    kind = conversations.schema["conv_id"].dataType
    return edits.select("conv_id", "edit", "role", "text", *COUNTS).mapInArrow(
        _digests(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, "
        "audit string, repaired_sha256 string")
