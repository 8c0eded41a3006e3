"""Operator 13 - repair of conversation structure by generalised LR parsing.

A conversation's turns should have role initials ``(s?(ua)+)?``.  The repair is
the cheapest way to get there by editing turns: keep it, change its role,
delete it, or insert an empty turn.

The role grammar has an LR automaton (built here from its productions), and
the parser is a generalised one.  A stack is a node of a graph: an automaton
state above another node, so stacks share what lies below, and equal stacks
are one node.  Before each turn the stacks are closed under insertions; then
every stack takes the turn by each action that its automaton allows (shift of
the turn's own initial, shift of a changed role, or deletion), reducing as the
next symbol asks.  Equal stack tops are merged by the smallest (cost, audit),
where the audit is the row of the edits' initials.

Ranks stand for audits: before a turn, stacks are in the order of their
audits, and none of these is a beginning of another, as all have seen the same
turns and end in an edit of one.  So (cost, rank, edits since) compares whole
audits.  A stack that costs more than ``SLACK`` beyond the best cannot win: two
insertions complete an open pair and one deletion drops a second ``s``, so the
best can be carried on as this one could for less.  What is left is one of a
bounded number of shapes of a frontier (usual conversations meet under a hundred),
so a turn costs one look-up after the first of its kind.

Scale: one shuffle by conversation; each task streams its sorted turns.  A
conversation is held as blocks of ``BLOCK`` characters: at a block's end each
surviving stack takes over the running digest of its own repaired text, so a
conversation of any length takes memory for one block, its audit and digests of
its distinct turns.  The contract's digest of the repaired text is sequential,
so one conversation is one task's stream.

Defined results: nulls are one space in texts, roles and the hashed key; a null
``conv_id`` is a conversation; null turns come first and count in no gap; turns
of equal number are ordered by role and text (nulls as spaces), so repeated
rows are adjacent; a role's initial is its first character (none for an empty
role); very long texts are streamed; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadweave.llm.shipping import ship

#: Role grammar; upper case is a nonterminal, the first production starts.
GRAMMAR = (("C", ""), ("C", "B"), ("C", "sB"), ("B", "P"), ("B", "BP"), ("P", "ua"))
END = "$"
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
UNMENDED = 5   # an undeleted truncated turn
SLACK = 2 * COST[INSERT] + COST[DELETE]
SPACES = " \t\n\x0b\x0c\r"
BLOCK = 1 << 20


@dataclass(frozen=True)
class Automaton:
    """LR(0) states with SLR look-ahead: ``goto[state][symbol]``, and the
    productions that ``reduce[state]`` allows before a terminal."""

    goto: tuple[dict[str, int], ...]
    reduce: tuple[dict[str, list[tuple[str, int]]], ...]


def automaton(grammar: tuple[tuple[str, str], ...]) -> Automaton:
    rules = (("", grammar[0][0]), *grammar)
    heads = {h for h, _ in grammar}

    def closed(items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        todo = list(items)
        while todo:
            r, dot = todo.pop()
            for k, (head, _) in enumerate(rules):
                if rules[r][1][dot:dot + 1] == head and head and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    empty = {h for h, body in grammar if not body}
    first: dict[str, set[str]] = {h: set() for h in heads}
    follow: dict[str, set[str]] = {h: set() for h in heads}
    follow[grammar[0][0]].add(END)
    before = None
    while before != (before := (str(sorted((h, sorted(s)) for h, s in first.items())), str(sorted((h, sorted(s)) for h, s in follow.items())))):
        for head, body in grammar:
            for k, x in enumerate(body):
                if all(y in empty for y in body[:k]):
                    first[head] |= first.get(x, {x})
                if x in heads:
                    rest = body[k + 1:]
                    follow[x] |= first.get(rest[0], {rest[0]}) if rest else follow[head]
    states = [closed({(0, 0)})]
    goto: list[dict[str, int]] = []
    for state in states:
        moves = {}
        for symbol in sorted({rules[r][1][dot] for r, dot in state if dot < len(rules[r][1])}):
            nxt = closed({(r, dot + 1) for r, dot in state if rules[r][1][dot:dot + 1] == symbol})
            if nxt not in states:
                states.append(nxt)
            moves[symbol] = states.index(nxt)
        goto.append(moves)
    reduce: list[dict[str, list[tuple[str, int]]]] = []
    for state in states:
        at: dict[str, list[tuple[str, int]]] = {}
        for r, dot in sorted(state):
            if r and dot == len(rules[r][1]):
                for t in sorted(follow[rules[r][0]]):
                    at.setdefault(t, []).append((rules[r][0], dot))
        reduce.append(at)
    return Automaton(tuple(goto), tuple(reduce))


ROLES = automaton(GRAMMAR)
#: A stack: (state, the stack below it); equal stacks are equal nodes.
Stack = tuple[int, "Stack | None"]
BOTTOM: Stack = (0, None)


def shifted(stack: Stack, symbol: str) -> list[Stack]:
    """The stacks after ``symbol``, with the reductions before it (``END``: those
    that accept)."""
    out, todo = [], [stack]
    while todo:
        top = todo.pop()
        if symbol in ROLES.goto[top[0]]:
            out.append((ROLES.goto[top[0]][symbol], top))
        if symbol == END and top[1] == BOTTOM and top[0] == ROLES.goto[0][GRAMMAR[0][0]]:
            out.append(top)
        for head, pops in ROLES.reduce[top[0]].get(symbol, ()):
            base: Stack = top
            for _ in range(pops):
                base = base[1]
            todo.append((ROLES.goto[base[0]][head], base))
    return out


#: Stacks in the order of their audits, each with its cost beyond the smallest.
Frontier = tuple[tuple[Stack, int], ...]
START: Frontier = ((BOTTOM, 0),)


def _inserted(frontier: Frontier) -> dict[Stack, tuple[int, int, str, str]]:
    """Stacks reachable by insertions: (cost, rank, edits, roles inserted)."""
    best: dict[Stack, tuple[int, int, str, str]] = {}
    todo = [(cost, rank, "", "", stack) for rank, (stack, cost) in enumerate(frontier)]
    while todo:
        cost, rank, edits, roles, stack = todo.pop()
        if stack in best and best[stack] <= (cost, rank, edits, roles):
            continue
        best[stack] = (cost, rank, edits, roles)
        todo += [(cost + COST[INSERT], rank, edits + INSERT, roles + r, after) for r in NAMES for after in shifted(stack, r)]
    return best


def _ordered(found: dict[Stack, tuple[int, int, str, str]]) -> tuple[Frontier, int, tuple[tuple[int, str, str], ...]]:
    low = min(x[0] for x in found.values())
    kept = sorted((rank, edits, roles, cost - low, stack) for stack, (cost, rank, edits, roles) in found.items() if cost <= low + SLACK)
    return tuple((s, c) for *_, c, s in kept), low, tuple((rank, edits, roles) for rank, edits, roles, *_ in kept)


@lru_cache(maxsize=1 << 14)
def advance(frontier: Frontier, initial: str, fault: str) -> tuple[Frontier, int, tuple[tuple[int, str, str], ...]]:
    """The frontier after one turn, what its best costs more, and for each of
    its stacks (rank before, edits, role shifted by each edit but deletion)."""
    must_go = fault in ("blank", "duplicate")
    late = UNMENDED if fault == "truncated" else 0
    found: dict[Stack, tuple[int, int, str, str]] = {}
    for stack, (cost, rank, edits, roles) in _inserted(frontier).items():
        options = [(stack, COST[DELETE], DELETE, "")]
        if not must_go:
            options += [(after, late, KEEP, initial) for after in shifted(stack, initial)]
            options += [(after, COST[REROLE] + late, REROLE, r) for r in NAMES if r != initial for after in shifted(stack, r)]
        for after, more, edit, role in options:
            new = (cost + more, rank, edits + edit, roles + role)
            if after not in found or new < found[after]:
                found[after] = new
    return _ordered(found)


@lru_cache(maxsize=1 << 12)
def finish(frontier: Frontier) -> tuple[int, int, str, str]:
    """The cheapest accepted end: (cost, rank, edits, roles inserted)."""
    return min(x for stack, x in _inserted(frontier).items() if shifted(stack, END))


@dataclass
class _Text:
    """Repaired text and audit of one stack up to the block's start."""

    digest: "hashlib._Hash" = field(default_factory=hashlib.sha256)
    begun: bool = False
    audit: tuple | None = None   # (audit before, edits)

    def then(self, edits: str, lines: list[str]) -> "_Text":
        digest = self.digest.copy()
        if lines:
            digest.update((("\n" if self.begun else "") + "\n".join(lines)).encode())
        return _Text(digest, self.begun or bool(lines), (self.audit, edits) if edits else self.audit)

    def edits(self) -> str:
        parts, at = [], self.audit
        while at is not None:
            at, part = at
            parts.append(part)
        return "".join(reversed(parts))


class Repair:
    """Streams the turns of one conversation, in order."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.frontier, self.cost, self.past = START, 0, [_Text()]
        self.turns: list[tuple[str, str]] = []
        self.steps: list[tuple[tuple[int, str, str], ...]] = []
        self.held = 0
        self.seen: set[bytes] = set()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.before: str | None = None
        self.low = self.high = self.last = None
        self.distinct = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.distinct += turn != self.last
            self.low, self.high, self.last = turn if self.low is None else self.low, turn, turn
        initial = role[:1]
        if self.before is not None:
            self.counts["illegal"] += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        fault, bare = "", text.rstrip(SPACES)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if not bare:
            fault = "blank"
        elif key in self.seen:
            fault = "duplicate"
        elif bare[-1] not in ".!?":
            fault = "truncated"
        if fault:
            self.counts[fault] += 1
        self.seen.add(key)
        self.frontier, more, step = advance(self.frontier, initial if initial in ("s", "u", "a") else "", fault)
        self.cost += more
        self.turns.append((role, text))
        self.steps.append(step)
        self.held += len(role) + len(text) + 64
        if self.held >= self.block:
            self.past = [self._traced(rank) for rank in range(len(self.frontier))]
            self.turns, self.steps, self.held = [], [], 0

    def _traced(self, rank: int, end: tuple[str, str] = ("", "")) -> _Text:
        """Text and audit of the stack of this rank, then the insertions ``end``."""
        path = []
        for step in reversed(self.steps):
            rank, edits, roles = step[rank]
            path.append((edits, roles))
        lines: list[str] = []
        audit = []
        for (role, text), (edits, roles) in zip(self.turns, reversed(path), strict=True):
            audit.append(edits)
            lines += [f"{NAMES[r]}:" for r in roles[:len(edits) - 1]]
            if edits[-1] == KEEP:
                lines.append(f"{role}:{text}")
            elif edits[-1] == REROLE:
                lines.append(f"{NAMES[roles[-1]]}:{text}")
        lines += [f"{NAMES[r]}:" for r in end[1]]
        return self.past[rank].then("".join(audit) + end[0], lines)

    def result(self) -> dict:
        if not self.distinct and self.before is None:
            cost, text = 0, _Text()
        else:
            more, rank, edits, roles = finish(self.frontier)
            cost, text = self.cost + more, self._traced(rank, (edits, roles))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": text.edits(), "repaired_sha256": text.digest.hexdigest()}


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults planted by a hash of (conv_id, turn): (conv_id,
    turn, role, text, copies); 0 copies: the turn is lost."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"),
                        kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text[, copies]): conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    ship(turns.sparkSession)
    if "copies" not in turns.columns:
        turns = turns.withColumn("copies", F.lit(1))
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), "copies")
    kind = turns.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, repair, done = None, None, []

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array([d["conv_id"] for d in done], id_type)] +
                [pa.array([d[c] for d in done], pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in RESULT], ["conv_id", *RESULT])
            done.clear()
            return rows

        for b in batches:
            id_type = b.schema.field("conv_id").type
            for conv, turn, role, text, copies in zip(*(b[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")), strict=True):
                if repair is None or conv != now:
                    if repair is not None:
                        done.append({"conv_id": now, **repair.result()})
                    now, repair = conv, Repair()
                for _ in range(copies):
                    repair.add(turn, role, text)
            if done:
                yield out()
        if repair is not None:
            done.append({"conv_id": now, **repair.result()})
            yield out()

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    numbers = ", ".join(f"{c} long" for c in RESULT[:-2])
    return dealt.mapInArrow(run, f"conv_id {kind.simpleString()}, {numbers}, audit string, repaired_sha256 string")
