"""Conversation structure repair: the cheapest edits that give every conversation the form ``(system? (user assistant)+)?``.

A row may be kept (K), get the role that is due (R), or be deleted (D, the only choice for blank and repeated rows); an empty message of the role that
is due may be inserted (I). Depth-first branch-and-bound over nodes (rows done, state) finds the cheapest edits, of these the least in ASCII order:
an explicit stack, lower bounds of what the rest costs at least, the best complete edits so far, and for each node the best prefix that
reached it. Two prefixes of one cost at one node differ before the shorter ends (more rows or a whole turn of inserts would cost more), so the lesser
one stays the lesser whatever follows, and the other may go.

The bounds come from a simpler machine, which only knows whose turn it is: it keeps no system message, so where one may still be kept the bound is less
by the price of a deletion, and it does not ask for a pair after one.

Rows of a conversation pass one task in order, in segments of ``SEGMENT`` rows: at a border the best prefix for each of four states goes on, with the
running digest of its text. So a conversation of any length needs the memory of a segment and of its own audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from entitymart.llm.common import per_group_rows

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SEGMENT = 512
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: Where a conversation may end: with nothing, or after an assistant.
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
_NEVER = 1 << 60
_SPACE = " \t\n\x0b\x0c\r"
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def due(state: int) -> str:
    return "a" if state == USER else "u"


def after(state: int) -> int:
    """The state once the message that is due has come."""
    return ASSISTANT if state == USER else USER


def bounds(pattern: str, targets: tuple[int, ...]) -> list[tuple[int, int]]:
    """For each row the least cost from there on, where a user and where an assistant is due. For ``pattern`` see ``search``."""
    user = 0 if set(targets) - {USER} else _NEVER
    assistant = 0 if USER in targets else _NEVER
    out = [(min(user, assistant + INSERT), min(assistant, user + INSERT))]
    for c in reversed(pattern):
        user, assistant = out[-1]
        more = TRUNCATED if c.isupper() else 0
        if c == "x":
            u, a = user + DELETE, assistant + DELETE
        else:
            u = min(user + DELETE, assistant + more + (c.lower() != "u") * RETYPE)
            a = min(assistant + DELETE, user + more + (c.lower() != "a") * RETYPE)
        out.append((min(u, a + INSERT), min(a, u + INSERT)))
    return out[::-1]


@lru_cache(maxsize=1 << 14)
def search(pattern: str, entry: int, targets: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, audit) of the best edits from state ``entry`` to one of ``targets``, or nothing. ``pattern``: a letter a row: x for one that has to go, else
    s, u, a or o (other) by its role, as a capital if the row is truncated."""
    n, least = len(pattern), bounds(pattern, targets)
    last_system = max(pattern.rfind("s"), pattern.rfind("S"))

    def bound(i: int, state: int) -> int:
        if state == START and i <= last_system:
            return max(0, least[i][0] - DELETE)
        return least[i][state == USER]

    best: tuple[int, str] = (_NEVER, "")
    met: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(bound(0, entry), 0, entry, 0, "")]
    while stack:
        floor, i, state, cost, audit = stack.pop()
        if floor > best[0] or (floor == best[0] and audit > best[1][: len(audit)]):
            continue
        if (i, state) in met and met[i, state] <= (cost, audit):
            continue
        met[i, state] = (cost, audit)
        if i == n and state in targets and (cost, audit) < best:
            best = (cost, audit)
        then = after(state)
        moves = [(i, then, cost + INSERT, "I")]
        if i < n:
            c = pattern[i]
            moves.append((i + 1, state, cost + DELETE, "D"))
            if c != "x":
                role, more = c.lower(), TRUNCATED if c.isupper() else 0
                if role == due(state):
                    moves.append((i + 1, then, cost + more, "K"))
                else:
                    moves.append((i + 1, then, cost + more + RETYPE, "R"))
                if role == "s" and state == START:
                    moves.append((i + 1, SYSTEM, cost + more, "K"))
        further = [(paid + bound(j, to), j, to, paid, audit + edit) for j, to, paid, edit in moves]
        stack += sorted((m for m in further if m[0] < _NEVER), key=lambda m: (m[0], m[4]), reverse=True)
    return best if best[0] < _NEVER else None


def applied(audit: str, rows: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each message that the edits leave or insert; ``rows``: (role, text)."""
    at = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        if edit == "K":
            state = SYSTEM if state == START and role[:1] == "s" else after(state)
        else:
            role = NAMES[due(state)]
            state = after(state)
        yield edit, role, text


class Walk:
    """A conversation whose rows come one by one."""

    def __init__(self):
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.turn = self.before = None
        self.turns = 0
        self.letters: list[str] = []
        self.rows: list[tuple[str, str]] = []
        # The best prefix for each state: cost, audit, digest of its messages (nothing yet: None).
        self.labels: dict[int, tuple[int, str, object]] = {START: (0, "", None)}

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if len(self.rows) == SEGMENT:
            self.settle(STATES)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if self.before is not None:
            self.count["illegal"] += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
            self.turns += 1
        end = text.rstrip(_SPACE)[-1:]
        if not end:
            self.count["blank"] += 1
            letter = "x"
        elif again:
            self.count["duplicate"] += 1
            letter = "x"
        elif end not in ".!?":
            self.count["truncated"] += 1
            letter = letter.upper()
        self.letters.append(letter)
        self.rows.append((role, text))

    def settle(self, targets: tuple[int, ...]) -> None:
        """Takes the held rows into the best prefixes."""
        pattern, best = "".join(self.letters), {}
        for entry, (cost, audit, _) in self.labels.items():
            for aims in [targets] if targets == ENDS else [(t,) for t in targets]:
                if found := search(pattern, entry, aims):
                    new = (cost + found[0], audit + found[1], entry, found[1])
                    if aims[0] not in best or new[:2] < best[aims[0]][:2]:
                        best[aims[0]] = new
        self.labels = {to: (cost, audit, self.digest(entry, own)) for to, (cost, audit, entry, own) in best.items()}
        self.letters, self.rows = [], []

    def digest(self, entry: int, audit: str):
        h = self.labels[entry][2]
        h = h and h.copy()
        for _, role, text in applied(audit, self.rows, entry):
            line = f"{role}:{text}".encode()
            if h is None:
                h = hashlib.sha256(line)
            else:
                h.update(b"\n" + line)
        return h

    def report(self) -> dict:
        self.settle(ENDS)
        (cost, audit, h), = self.labels.values()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, **self.count, "cost": cost, "audit": audit, "repaired_sha256": (h or hashlib.sha256()).hexdigest()}


def ordered(rows: DataFrame, first: Column | None = None) -> DataFrame:
    """(conv_id, rank, turn, role, text, again), conversations whole and in order in their partitions: by turn (nulls first), then role and text. ``again``: role
    and text stood there before. Rows with a null role are marks, which only say that there is such a conversation."""
    dealt = rows.select("conv_id", (F.lit(1) if first is None else first).alias("rank"), F.col("turn").cast("long").alias("turn"), "role", "text").repartition("conv_id")
    place = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("rank", F.col("turn").asc_nulls_first()))
    return dealt.withColumn("again", place > 1).sortWithinPartitions("conv_id", "rank", F.col("turn").asc_nulls_first(), "role", "text", "again")


def filled(rows: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    return rows.select("conv_id", "turn", blank("role"), blank("text"))


def reports(rows: DataFrame) -> DataFrame:
    """A row for each conv_id of ``rows`` (conv_id, turn, role, text): turns that are missing, rows blank, repeated or truncated, neighbours whose roles do not follow
    each other, cost and audit of the cheapest edits, and the digest of the repaired ``role:text`` lines.

    Null roles and texts are a space, as in ``filled``, unless both are null: such a row is a mark that a conversation of no rows exists. Null ids are a
    conversation too; ties of a turn go by role and text; other columns are not read; an empty table gives none."""
    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL(REPORT)])

    def run(conversations):
        for conv_id, its_rows in conversations:
            walk = Walk()
            for _, turn, role, text, again in its_rows:
                if role is not None:
                    walk.add(turn, role, text, again)
            yield {"conv_id": conv_id, **walk.report()}

    return per_group_rows(ordered(rows), run, schema)


def repaired(rows: DataFrame, told: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the messages after the edits that ``told`` (of ``reports``) names. An audit comes before the rows of its conversation,
    which pass by one at a time."""
    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL("place long, edit string, role string, text string")])
    audits = told.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("rank"))
    both = audits.unionByName(rows.where("role is not null").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.lit(1).alias("rank")))

    def run(conversations):
        for conv_id, its_rows in conversations:
            audit = next(its_rows)[3]
            own = ((role, text) for _, _, role, text, _ in its_rows)
            for place, (edit, role, text) in enumerate(applied(audit, own, START), 1):
                yield {"conv_id": conv_id, "place": place, "edit": edit, "role": role, "text": text}

    return per_group_rows(ordered(both, F.col("rank")), run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Planted damage, by crc32(``conv_id:turn``) % 20: 0 drops a row (a mark stays), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = filled(conversations).withColumn("fate", fate)
    stays = F.col("fate") != 0
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(stays, role).alias("role"), F.when(stays, text).alias("text"), copies.alias("copy")).drop("copy")
