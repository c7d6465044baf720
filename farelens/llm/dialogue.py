"""Conversation repair by a Viterbi search whose survivors coalesce.

Spark lays every conversation out in order in one task (one shuffle on its id,
spilling sorts) and marks each row's fault. A task then streams over the rows: for
each state of the role grammar ``(s?(ua)+)?`` the cheapest edits so far survive, as
the leaves of a tree of back-pointers whose nodes count their references. A survivor
that another one can always match for less is cut; as soon as all survivors share an
ancestor, the edits up to it are settled, handed on and forgotten. So memory holds the
unsettled rows only, a few of a conversation however long; only where the cheapest
start depends on the end (say, user rows alone) do they wait for it. Survivors of equal
cost are told apart by their complete unsettled edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, DELETE, REROLE, INSERT = "K", "D", "R", "I"
#: Cost of an edit, and of a truncated row that is not deleted.
COST = {KEEP: 0, DELETE: 4, REROLE: 3, INSERT: 3}
TRUNCATED = 3
#: States: nothing written, system written, user written, assistant written.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}
#: state -> {role initial: (rows to insert before it, state after it)}
STEPS = {
    START: {"s": ("", SYSTEM), "u": ("", USER), "a": ("u", ASSISTANT)},
    SYSTEM: {"u": ("", USER), "a": ("u", ASSISTANT)},
    USER: {"u": ("a", USER), "a": ("", ASSISTANT)},
    ASSISTANT: {"u": ("", USER), "a": ("u", ASSISTANT)},
}
#: state -> rows to insert at the end
CLOSE = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
#: state -> {other state: what it costs the other one at most to do the same from there on}
MATCHED = {
    START: {ASSISTANT: COST[DELETE], USER: COST[INSERT] + COST[DELETE]},
    SYSTEM: {ASSISTANT: 0, USER: COST[INSERT]},
    USER: {ASSISTANT: COST[INSERT]},
    ASSISTANT: {USER: COST[INSERT]},
}
_BLANKS = " \t\n\x0b\x0c\r"
_EDITS = pa.schema(
    [
        ("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("cost", pa.int32()), ("fault", pa.string()),
        ("illegal", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ]
)
#: Rows handed on together.
ROWS = 512


class Node:
    """One row's edit on a path, with the inserts before it. ``refs`` counts the
    children and survivors that stand on it."""

    __slots__ = ("parent", "edits", "refs")

    def __init__(self, parent: Node | None, edits: list[tuple]):
        self.parent, self.edits, self.refs = parent, edits, 0


class Search:
    """The survivors of one conversation. ``step`` and ``finish`` return the edits
    settled by then: (letter, cost, row or None, role or None, text or None).

    Survivors of equal cost are told apart by all their unsettled letters. As each has
    one letter other than I for every row, and ends with it, none begins with another,
    so their order is carried along as a rank: the order of the next letters is that of
    (rank, letters), and no suffix is read twice."""

    def __init__(self):
        self.root = Node(None, [])
        self.root.refs = 1
        #: state -> (cost, rank of the letters among the survivors, node)
        self.tips: dict[int, tuple[int, int, Node]] = {START: (0, 0, self.root)}

    @staticmethod
    def _inserts(initials: str) -> list[tuple]:
        return [(INSERT, COST[INSERT], None, ROLES[i], "") for i in initials]

    def step(self, row: tuple, initial: str, role: str, text: str, fault: str | None) -> list[tuple]:
        """Takes the next row; ``row`` is handed back beside its edit."""
        must_go = fault in ("blank", "duplicate")
        extra = TRUNCATED if fault == "truncated" else 0
        # state -> ((cost, rank, letters), node it goes on from, edits)
        best: dict[int, tuple] = {}

        def offer(state: int, key: tuple, node: Node, before: str, edit: tuple) -> None:
            if state not in best or key < best[state][0]:
                best[state] = key, node, before, edit

        for state, (cost, rank, node) in self.tips.items():
            offer(state, (cost + COST[DELETE], rank, DELETE), node, "", (DELETE, COST[DELETE], row, None, None))
            if must_go:
                continue
            for written, (before, after) in STEPS[state].items():
                keep = written == initial
                if keep or written in ROLES:
                    letter = KEEP if keep else REROLE
                    own = COST[letter] + extra
                    key = cost + len(before) * COST[INSERT] + own, rank, INSERT * len(before) + letter
                    offer(after, key, node, before, (letter, own, row, role if keep else ROLES[written], text))
        old = [node for *_, node in self.tips.values()]
        left = {
            s: b for s, b in best.items() if not any(o in best and b[0][0] > best[o][0][0] + more for o, more in MATCHED[s].items())
        }
        ranks = {k: i for i, k in enumerate(sorted({b[0][1:] for b in left.values()}))}
        self.tips = {}
        for state, (key, node, before, edit) in left.items():
            node.refs += 1
            tip = Node(node, [*self._inserts(before), edit])
            tip.refs = 1
            self.tips[state] = key[0], ranks[key[1:]], tip
        for node in old:
            self._release(node)
        return self._settle()

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node is not self.root:
            node = node.parent
            node.refs -= 1

    def _path(self, node: Node) -> list[Node]:
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return path[::-1]

    def _settle(self) -> list[tuple]:
        """Moves the root down while one path only leads on from it."""
        out: list[tuple] = []
        if self.root.refs == 1:
            for node in self._path(next(iter(self.tips.values()))[2]):
                if self.root.refs != 1:
                    break
                out += node.edits
                self.root, node.parent = node, None
        return out

    def finish(self) -> list[tuple]:
        ends = [((cost + len(CLOSE[s]) * COST[INSERT], rank, INSERT * len(CLOSE[s])), s) for s, (cost, rank, _) in self.tips.items()]
        state = min(ends)[1]
        path = self._path(self.tips[state][2])
        return [e for node in path for e in node.edits] + self._inserts(CLOSE[state])


def fault(text: str = "text", repeated: str = "repeated") -> Column:
    """The first fault of a row: blank, duplicate, truncated, or null."""
    bare = F.rtrim(F.col(text), F.lit(_BLANKS))
    return (
        F.when(bare == "", "blank")
        .when(F.col(repeated), "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    )


def ordered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, fault): each conversation whole in one partition,
    by turn (nulls first), role and text. Null roles and texts are one space."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    own = rows.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), *filled).repartition("conv_id")
    # both sorts stay inside the partition of the conversation and spill
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = own.withColumn("repeated", F.row_number().over(same) > 1)
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    return marked.withColumn("fault", fault()).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "fault")


def edits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The cheapest edits that give every conversation the roles ``(s?(ua)+)?``, in
    order, conversations whole: conv_id, at (from 0), edit (K, D, R, I), cost, fault and
    turn of the row, illegal (its role may not follow the one before), and the role
    and text written (null: none).

    Keep costs 0, Rerole to user or assistant 3, Delete 4 (required for blank and
    duplicate rows), Insert of an empty user or assistant row 3, a truncated row that
    stays 3 more. Of equal costs the ASCII-least letters win. Rows of a null conv_id
    are one conversation, null turns come first, null roles and texts are one space;
    equal rows are duplicates of the first; a row without a role (empty) cannot be
    kept. Extra columns are ignored, an empty table
    gives no rows."""
    legal = {"su", "ua", "au"}

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        search, current, at, last = None, None, 0, ""

        def emit(settled: list[tuple]) -> None:
            nonlocal at
            for letter, cost, row, role_, text_ in settled:
                own_turn, own_fault, illegal = row or (None, None, False)
                out.append((current, at, letter, cost, own_fault, illegal, own_turn, role_, text_))
                at += 1

        def batch() -> pa.RecordBatch:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*out), _EDITS)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, schema=_EDITS)

        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                for conv_id, turn_, role_, text_, fault_ in zip(*(c.to_pylist() for c in b.slice(i, ROWS).columns)):
                    if search is None or conv_id != current:
                        if search:
                            emit(search.finish())
                        search, current, at, last = Search(), conv_id, 0, None
                    initial = role_[:1]
                    illegal = last is not None and last + initial not in legal
                    last = initial
                    emit(search.step((turn_, fault_, illegal), initial, role_, text_, fault_))
                if out:
                    yield batch()
        if search:
            emit(search.finish())
        if out:
            yield batch()

    schema = "conv_id bigint, at bigint, edit string, cost int, fault string, illegal boolean, turn bigint, role string, text string"
    return ordered(rows, conv, turn, role, text).mapInArrow(repaired, schema)


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``edits`` (as it returns them, in order): gaps of
    the turns, rows by first fault, illegal neighbours, cost, the letters, and the
    SHA-256 of the repaired ``role:text`` lines, which are read as a stream."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held = None

        def close() -> None:
            turns = (held["hi"] - held["lo"] + 1 - held["turns"]) if held["turns"] else 0
            n = held["n"]
            done.append((held["conv"], turns, n["blank"], n["duplicate"], n["truncated"], held["illegal"], held["cost"], "".join(held["audit"]), held["sha"].hexdigest()))

        def batch() -> pa.RecordBatch:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*done), _DIGEST)]
            done.clear()
            return pa.RecordBatch.from_arrays(cols, schema=_DIGEST)

        for b in batches:
            for conv, at, letter, cost, fault_, illegal, turn, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if at == 0:
                    if held:
                        close()
                    held = {"conv": conv, "n": dict.fromkeys(("blank", "duplicate", "truncated"), 0), "illegal": 0, "cost": 0, "audit": [], "lo": None, "hi": None, "turns": 0, "sha": hashlib.sha256(), "any": False}
                held["audit"].append(letter)
                held["cost"] += cost
                held["illegal"] += illegal
                if fault_:
                    held["n"][fault_] += 1
                if turn is not None and turn != held["hi"]:
                    held["lo"] = turn if held["lo"] is None else held["lo"]
                    held["hi"], held["turns"] = turn, held["turns"] + 1
                if role is not None:
                    held["sha"].update(f"{chr(10) if held['any'] else ''}{role}:{text}".encode())
                    held["any"] = True
            if done:
                yield batch()
        if held:
            close()
            yield batch()

    schema = ", ".join(f"{n} bigint" for n in _DIGEST.names[:7]) + ", audit string, repaired_sha256 string"
    return repaired.mapInArrow(read, schema)
