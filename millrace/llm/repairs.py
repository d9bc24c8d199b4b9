"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

Each turn has a role, by its initial, and at most one fault: blank (no character but ASCII white space), duplicate (role and text
seen earlier in the conversation), or truncated (does not end in `.`, `!` or `?`). Edits: Keep (0), Rerole to user or
assistant (3), Delete (4; blank and duplicate turns must go), Insert an empty user or assistant turn (3); a
truncated turn that stays adds 3. The repaired initials must read `(s?(ua)+)?`. Of equal costs the audit, the edits'
initials in order, that comes first in ASCII wins.

1. Faults by expressions; one sorted pass per conversation writes its signature, one symbol per turn.
2. Signatures are minimised from the end: distinct ones, read backwards and sorted by range, form an automaton in which
   equal endings are one node, as neighbours share the path of their common ending. At each node and grammar state cost-to-go
   and best audit suffix (its first edit and the node behind it) are made once for all conversations that end so.
   Nodes whose costs differ by a constant alone share one table of edits. A run of sorted endings needs the
   nodes of one path only, so memory is the longest signature's, and a signature that a third of all conversations
   have is one row here.
3. Audits go back to the conversations by signature, then ahead of their turns in one sorted pass that makes the repaired turns.

Texts move once, turns without texts once; a conversation of any length is read as a stream.

Defined results: turns are taken by `turn`, NULL first; ties by role, then by the hash of the text. A NULL role or text counts as one
space; NULL is an id like others. A turn of another role than s, u or a can't be kept. Repeated rows are turns of their own
(the later ones duplicates). A conversation whose rows are all `dropped` has zeros and an empty audit. Texts of any
length are hashed, not compared. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.words import WHITE
from millrace.sources.scratch import written_table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar states: at the start, behind a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State behind a kept turn, by initial.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: State behind a turn that is given its role, and that role.
MADE = (USER, USER, ASSISTANT, USER)
ROLES = ("user", "user", "assistant", "user")
ENDS = (START, ASSISTANT)
LEGAL = frozenset({"su", "ua", "au"})
#: Symbols of a signature: a turn that must go, else its initial (`o`: another role), in upper case if truncated.
GONE = "x"
#: Broadcast of solved signatures: bytes of signatures and audits.
BROADCAST_BYTES = 32 << 20
_MOST = (1 << 63) - 1


def damaged(conversations: DataFrame, modulus: int = 20) -> DataFrame:
    """`conv_id, turn, role, text, dropped`: turns damaged by a hash of `conv_id:turn`.

    0 drops the turn (the row stays, marked), 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats it, 4 makes it the user's. NULLs
    read as one space.
    """
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % modulus
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), hit.alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("hit") == 0).alias("dropped"), F.explode(times).alias("copy"),
    ).drop("copy")


def _id_type(rows: DataFrame) -> pa.DataType:
    return to_arrow_type(rows.schema["conv_id"].dataType)


def _turns(turns: DataFrame) -> DataFrame:
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in turns.columns else F.lit(False)
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"), dropped.alias("dropped"),
    )


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """All rows of a conversation in one partition, in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "digest")


def _state_table(symbol: str, behind: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """Costs and first edits by state in front of a turn, from the costs behind it."""
    costs, edits = [], []
    initial, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for state in range(4):
        ways = [(DELETE + behind[state], "D")]
        if symbol != GONE:
            ways.append((REROLE + extra + behind[MADE[state]], "R"))
            if initial in KEPT[state]:
                ways.append((extra + behind[KEPT[state][initial]], "K"))
        cost, edit = min(ways)
        costs.append(cost)
        edits.append(edit)
    return _with_inserts(costs, edits)


def _with_inserts(costs: list[int], edits: list[str]) -> tuple[tuple[int, ...], str]:
    # Inserted turns lead through at most three other states.
    for _ in range(3):
        for state in range(4):
            costs[state], edits[state] = min((costs[state], edits[state]), (INSERT + costs[MADE[state]], "I"))
    return tuple(costs), "".join(edits)


@dataclass(frozen=True)
class Node:
    """An ending: cost-to-go by state is `base + costs`, and the first edit of the best audit."""

    base: int
    costs: tuple[int, ...]
    edits: str


class Endings:
    """The automaton along one path, from the end; steps between cost tables are made once."""

    def __init__(self) -> None:
        costs, edits = _with_inserts([0 if q in ENDS else 1 << 30 for q in range(4)], ["." if q in ENDS else "?" for q in range(4)])
        self.path = [Node(0, costs, edits)]
        self.ending = ""
        self.steps: dict[tuple[str, tuple[int, ...]], tuple[int, tuple[int, ...], str]] = {}

    def step(self, symbol: str, behind: Node) -> Node:
        key = (symbol, behind.costs)
        if key not in self.steps:
            costs, edits = _state_table(symbol, behind.costs)
            least = min(costs)
            self.steps[key] = (least, tuple(c - least for c in costs), edits)
        more, costs, edits = self.steps[key]
        return Node(behind.base + more, costs, edits)

    def solve(self, ending: str) -> tuple[int, str]:
        """Cost and audit of the signature that reads `ending` backwards."""
        del self.path[len(commonprefix((self.ending, ending))) + 1 :]
        for symbol in ending[len(self.path) - 1 :]:
            self.path.append(self.step(symbol, self.path[-1]))
        self.ending = ending
        audit, state, k = [], START, len(ending)
        while (edit := self.path[k].edits[state]) != ".":
            audit.append(edit)
            state = KEPT[state][ending[k - 1].lower()] if edit == "K" else MADE[state] if edit in "RI" else state
            k -= edit != "I"
        return self.path[-1].base + self.path[-1].costs[START], "".join(audit)


_SOLVED = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])


def solved(signatures: DataFrame) -> DataFrame:
    """`signature, cost, audit` of the distinct values of `signature`."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            found = [(e[::-1], *endings.solve(e)) for e in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(_SOLVED.names, x)) for x in found], schema=_SOLVED)

    endings = written_table(signatures.select(F.reverse("signature").alias("ending")).distinct(), "repair-endings")
    ranged = endings.repartitionByRange("ending").sortWithinPartitions("ending")
    return ranged.mapInArrow(solve, "signature string, cost bigint, audit string")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def signatures(turns: DataFrame) -> DataFrame:
    """`conv_id, signature, gaps, blank, duplicate, truncated, illegal` of each conversation."""
    rows = _turns(turns)
    schema = pa.schema([("conv_id", _id_type(rows)), ("signature", pa.string()), *((c, pa.int64()) for c in _COUNTS)])
    trimmed = F.btrim("text", F.lit(WHITE))
    end = F.right(trimmed, F.lit(1))
    slim = rows.select(
        "conv_id", "turn", "role", "digest", "dropped",
        F.when(trimmed == "", "b").when(~end.isin(".", "!", "?"), "t").otherwise("").alias("fault"),
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Signature | None = None
        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held.conv != row[0]:
                    if held is not None:
                        done.append(held.row())
                    held = _Signature(row[0])
                held.add(*row[1:])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.row()], schema=schema)

    # Equal turns are marked inside the partition of their conversation: sorted, not gathered.
    slim = slim.repartition("conv_id")
    equal = Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(F.col("turn").asc_nulls_first())
    seen = F.row_number().over(equal) > 1
    marked = slim.select("conv_id", "turn", "role", "digest", "fault", "dropped", (seen & ~F.col("dropped")).alias("again"))
    sorted_rows = marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest")
    picked = sorted_rows.select("conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "fault", "again", "dropped")
    kind = rows.schema["conv_id"].dataType.simpleString()
    return picked.mapInArrow(made, ", ".join([f"conv_id {kind}", "signature string", *(f"{c} bigint" for c in _COUNTS)]))


class _Signature:
    """A conversation as its turns come by."""

    def __init__(self, conv):
        self.conv, self.symbols = conv, bytearray()
        self.least = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: str, again: bool, dropped: bool) -> None:
        if dropped:
            return
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.last = turn
        gone = fault == "b" or again
        self.blank += fault == "b"
        self.duplicate += again and fault != "b"
        self.truncated += fault == "t" and not again
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        symbol = GONE if gone else initial if initial in ("s", "u", "a") else "o"
        self.symbols += (symbol.upper() if fault == "t" and not gone else symbol).encode()

    def row(self) -> dict:
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.turns
        return {
            "conv_id": self.conv, "signature": self.symbols.decode(), "gaps": min(gaps, _MOST), "blank": self.blank,
            "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
        }


def repair_plans(turns: DataFrame) -> DataFrame:
    """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit` of each conversation."""
    found = written_table(signatures(turns), "repair-signatures")
    done = written_table(solved(found.select("signature")), "repair-audits")
    size = done.agg(F.sum(F.length("signature") + F.length("audit") + 40)).first()[0] or 0
    # Few distinct signatures go to every task; else equal ones meet by a join, which splits frequent ones.
    side = F.broadcast(done) if size <= BROADCAST_BYTES else done
    return found.join(side, "signature").select("conv_id", *_COUNTS, "cost", "audit")


class _Repair:
    """The turns of one conversation, edited as they come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit.startswith("I", self.at):
            yield "I", ROLES[self.state], ""
            self.state = MADE[self.state]
            self.at += 1

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what stands for this turn."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield edit, role, text
            self.state = KEPT[self.state][role[:1]]
        elif edit == "R":
            yield edit, ROLES[self.state], text
            self.state = MADE[self.state]

    end = _inserted


def _with_plans(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its turns in order; `plan` is NULL at turns."""
    plan = F.struct(*(c for c in plans.columns if c != "conv_id"))
    none = {"turn": "bigint", "role": "string", "text": "string", "digest": "binary"}
    heads = plans.select("conv_id", plan.alias("plan"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()), F.lit(0).alias("kind"))
    rows = _turns(turns).where(~F.col("dropped")).drop("dropped")
    rows = rows.withColumns({"plan": F.lit(None).cast(heads.schema["plan"].dataType), "kind": F.lit(1)})
    return _ordered(heads.unionByName(rows), "kind").select("conv_id", "plan", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, object, Iterator[tuple[str, str, str]]]]:
    """Conversation, plan (where it begins) and repaired turns, for each row and once behind each conversation."""
    conv, repair = None, None
    for batch in batches:
        for key, plan, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if plan is not None:
                if repair is not None:
                    yield conv, None, repair.end()
                conv, repair = key, _Repair(plan["audit"])
                yield conv, plan, iter(())
            else:
                yield conv, None, repair.turn(role, text)
    if repair is not None:
        yield conv, None, repair.end()


#: Repaired turns in one Arrow batch.
_BATCH = 1000


def repaired_turns(turns: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """`conv_id, n, edit, role, text`: the repaired conversations, turns numbered from 0."""
    plans = written_table(repair_plans(turns), "repair-plans") if plans is None else plans
    rows = _with_plans(turns, plans)
    schema = pa.schema([("conv_id", _id_type(rows)), ("n", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for conv, plan, found in _streamed(batches):
            n = 0 if plan is not None else n
            for edit, role, text in found:
                out.append({"conv_id": conv, "n": n, "edit": edit, "role": role, "text": text})
                n += 1
            if len(out) >= _BATCH:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(made, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, n bigint, edit string, role string, text string")


def repair_digests(turns: DataFrame) -> DataFrame:
    """`repair_plans` with the SHA-256 of the repaired `role:text` lines of each conversation."""
    plans = written_table(repair_plans(turns), "repair-plans")
    rows = _with_plans(turns, plans)
    columns = [c for c in plans.columns if c != "conv_id"]
    counts = [(c, pa.string() if c == "audit" else pa.int64()) for c in columns]
    schema = pa.schema([("conv_id", _id_type(rows)), *counts, ("repaired_sha256", pa.string())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        held, digest, first = None, None, True
        for conv, plan, found in _streamed(batches):
            if plan is not None:
                if held is not None:
                    done.append(held | {"repaired_sha256": digest.hexdigest()})
                held, digest, first = {"conv_id": conv, **plan}, hashlib.sha256(), True
                if len(done) >= _BATCH:
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
                    done = []
            for _, role, text in found:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        if held is not None:
            done.append(held | {"repaired_sha256": digest.hexdigest()})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    kinds = ", ".join(f"{c} {'string' if c == 'audit' else 'bigint'}" for c in columns)
    return rows.mapInArrow(made, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {kinds}, repaired_sha256 string")
