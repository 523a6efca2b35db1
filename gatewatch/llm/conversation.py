"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, in turn order, become a string of codes: the role's initial and the
row's fault. Edits in ASCII order of their initials are Delete, Insert, Keep and Rerole; the
roles that remain must read ``(s?(ua)+)?``. The search is depth first in that order under a
cost bound. A state is (row, automaton state); one that failed under some remaining budget
keeps the least budget under which it may yet succeed (the failed-state table), and the
bound is raised to what the start state then needs. The first accepting path under the
smallest bound is the answer: the cheapest edits, of several the ASCII-least. The estimate
of the remaining cost is an additive pattern table: the rows are cut into chunks of ``CHUNK``
codes, each chunk's least cost from every automaton state to any is looked up, and the sums
are a lower bound that the search starts from.

Two passes, each one shuffle by conversation, sorted by turn and streamed. The first carries
no text (roles, text hashes, fault bits; about 100 bytes a row of the one conversation being
read) and returns the edits; the second streams the texts past their conversation's edits, so
no conversation's texts are ever held. Rows of equal turn come in order of role and text hash;
null turns come first. Null roles and texts are one space: such a text is blank, such a role
fits nowhere. Rows of a null conversation id are one conversation. Repeated rows are
duplicates. A conversation without rows has empty edits; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import ship_code

#: Edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CHUNK = 64
#: Automaton of (s?(ua)+)?: 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
WANTED = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}  # role and state of Insert and Rerole
ACCEPTING = (0, 3)
GONE = "-"  # code of a blank or duplicate row; capitals are truncated rows


# ---------------------------------------------------------------- search

def _edits(code: str | None, q: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows consumed, next state) of the edits in ASCII order."""
    out = [("D", DELETE, 1, q)] if code else []
    out.append(("I", INSERT, 0, WANTED[q][1]))
    if code and code != GONE:
        more = TRUNCATED if code.isupper() else 0
        if (to := NEXT.get(code.lower(), {}).get(q)) is not None:
            out.append(("K", more, 1, to))
        out.append(("R", REROLE + more, 1, WANTED[q][1]))
    return out


EDITS = {(c, q): _edits(c, q) for c in [None, GONE, *"suaxSUAX"] for q in range(4)}


@lru_cache(maxsize=20_000)
def _pattern(chunk: str) -> tuple[tuple[int, ...], ...]:
    """Least cost from (position in the chunk, state) to the chunk's end in any state."""
    cost = [(0, 0, 0, 0)]
    for c in reversed(chunk):
        here = [min(w + cost[-1][to] for _, w, n, to in EDITS[c, q] if n) for q in range(4)]
        for _ in range(3):  # inserts before the row
            here = [min(here[q], INSERT + here[WANTED[q][1]]) for q in range(4)]
        cost.append(tuple(here))
    return tuple(reversed(cost))


def _estimates(codes: str) -> list[list[int]]:
    """Lower bounds of the remaining cost at every (row, state)."""
    out, rest = [[0, 0, 0, 0]], 0
    for at in range((len(codes) - 1) // CHUNK * CHUNK, -1, -CHUNK):
        table = _pattern(codes[at:at + CHUNK])
        out += [[rest + c for c in row] for row in reversed(table[:-1])]
        rest += min(table[0])
    return out[::-1]


@lru_cache(maxsize=20_000)
def cheapest(codes: str) -> tuple[int, str]:
    """Cost and edits of the cheapest repair, of several the ASCII-least."""
    need = _estimates(codes) if codes else [[0, 0, 0, 0]]  # least budget that may succeed
    n = len(codes)
    while True:
        bound = need[0][0]
        # one frame per state on the path: row, state, budget, next edit, least budget seen
        path, frames = [], [[0, 0, bound, 0, None]]
        while frames:
            i, q, budget, k, least = frame = frames[-1]
            if i == n and q in ACCEPTING:
                return bound, "".join(path)
            edits = EDITS[codes[i] if i < n else None, q]
            for at in range(k, len(edits)):
                name, w, step, to = edits[at]
                wants = w + need[i + step][to]
                if wants <= budget:
                    frame[3] = at  # tried again when it has failed: its need has grown by then
                    path.append(name)
                    frames.append([i + step, to, budget - w, 0, None])
                    break
                least = wants if least is None else min(least, wants)
                frame[3], frame[4] = at + 1, least
            else:
                need[i][q] = max(need[i][q], least)
                frames.pop()
                if path:
                    path.pop()


# ---------------------------------------------------------------- passes over the rows

_NONE = object()
_AUDIT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SEARCHED = "conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Reader:
    """Codes and counts of the conversation being streamed."""

    def __init__(self, conv):
        self.conv, self.codes, self.seen, self.before = conv, [], set(), None
        self.low = self.high = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role, h1, h2, blank, cut) -> None:
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1
        first = role[:1]
        if self.before is not None and self.before + first not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = first
        mark = (role, h1, h2)
        again = mark in self.seen
        self.seen.add(mark)
        code = first if first in ("s", "u", "a") else "x"
        if blank:
            self.blank += 1
            code = GONE
        elif again:
            self.duplicate += 1
            code = GONE
        elif cut:
            self.truncated += 1
            code = code.upper()
        self.codes.append(code)

    def result(self) -> dict:
        cost, audit = cheapest("".join(self.codes))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit}


_ORDER = ["turn", "role", "h1", "h2"]  # ascending: nulls first
GONE_COLUMN = "__gone"
HELD = 2_000  # finished conversations per returned batch


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with nulls as one space and text hashes. A row marked in the column ``GONE_COLUMN``,
    if there is one, only names its conversation."""
    gone = F.col(GONE_COLUMN) if GONE_COLUMN in rows.columns else F.lit(False)
    return (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone"))
            .withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.col("text"))}))


def search_edits(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text; others are not looked at) -> per conversation gaps, blank, duplicate,
    truncated, illegal, cost and audit (the edits' initials)."""
    ship_code(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType
    schema = _SEARCHED.format(kind.simpleString())
    arrow = pa.schema([("conv_id", _arrow(kind)), *[(c, pa.int64()) for c in _AUDIT], ("audit", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for b in batches:
            for conv, turn, role, h1, h2, blank, cut, gone in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or conv != now.conv:
                    if now:
                        done.append(now.result())
                    now = _Reader(conv)
                if not gone:
                    now.add(turn, role, h1, h2, blank, cut)
            if len(done) >= HELD:
                yield pa.RecordBatch.from_pylist(done, arrow)
                done = []
        if now:
            done.append(now.result())
        yield pa.RecordBatch.from_pylist(done, arrow)

    narrow = _prepared(rows).select(
        "conv_id", "turn", "role", "h1", "h2", (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"), "gone")
    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER).mapInArrow(search, schema)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _repaired(role: str, text: str, edit: str, q: int) -> tuple[str, str, int]:
    """Role, text and automaton state after an edit that leaves a row."""
    if edit == "K":
        return role, text, NEXT[role[:1]][q]
    want, q = WANTED[q]
    return {"u": "user", "a": "assistant"}[want], "" if edit == "I" else text, q


def _streamed(batches: Iterator[pa.RecordBatch]):
    """Sorted rows with their conversation's edits in front -> ('start', conv, its numbers),
    ('row', role, text) in repaired order, ('end', conv, None)."""
    conv, audit, at, q = _NONE, "", 0, 0

    def rest():
        nonlocal at, q
        while at < len(audit) and audit[at] == "I":
            role, text, q = _repaired("", "", "I", q)
            at += 1
            yield "row", role, text

    for b in batches:
        cols = {n: b.column(n).to_pylist() for n in b.schema.names}
        for i in range(b.num_rows):
            if cols["ord"][i] == 0:
                if conv is not _NONE:
                    yield from rest()
                    yield "end", conv, None
                conv, audit, at, q = cols["conv_id"][i], cols["audit"][i], 0, 0
                yield "start", conv, {c: cols[c][i] for c in _AUDIT} | {"audit": audit}
                continue
            yield from rest()  # inserts between the row before and this one
            edit = audit[at]
            at += 1
            if edit != "D":
                role, text, q = _repaired(cols["role"][i], cols["text"][i], edit, q)
                yield "row", role, text
    if conv is not _NONE:
        yield from rest()
        yield "end", conv, None


def _beside(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Texts and edits by conversation, the edits first."""
    texts = _prepared(rows).where(~F.col("gone")).select("conv_id", F.lit(1).alias("ord"), "turn", "role", "h1", "h2", "text")
    both = edits.withColumn("ord", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "ord", *_ORDER).select("conv_id", "ord", *_AUDIT, "audit", "role", "text")


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, position, role, text)."""
    kind = rows.schema["conv_id"].dataType
    arrow = pa.schema([("conv_id", _arrow(kind)), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, conv, n = [], 0, None, 0
        for what, a, b in _streamed(batches):
            if what == "start":
                conv, n = a, 0
            elif what == "row":
                held.append({"conv_id": conv, "position": n, "role": a, "text": b})
                n, size = n + 1, size + len(b)
                if size > 1 << 22 or len(held) >= HELD:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, arrow)

    return _beside(rows, edits).mapInArrow(write, f"conv_id {kind.simpleString()}, position long, role string, text string")


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``edits`` with repaired_sha256: the repaired ``role:text`` rows, newline-joined, hashed
    while they stream by."""
    kind = rows.schema["conv_id"].dataType
    schema = _SEARCHED.format(kind.simpleString()) + ", repaired_sha256 string"
    arrow = pa.schema([("conv_id", _arrow(kind)), *[(c, pa.int64()) for c in _AUDIT], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, sha, glue = [], None, None, b""
        for what, a, b in _streamed(batches):
            if what == "start":
                now, sha, glue = {"conv_id": a, **b}, hashlib.sha256(), b""
            elif what == "row":
                sha.update(glue + f"{a}:{b}".encode())
                glue = b"\n"
            else:
                done.append(now | {"repaired_sha256": sha.hexdigest()})
                if len(done) >= HELD:
                    yield pa.RecordBatch.from_pylist(done, arrow)
                    done = []
        yield pa.RecordBatch.from_pylist(done, arrow)

    return _beside(rows, edits).mapInArrow(digest, schema)


# ---------------------------------------------------------------- damage

def damaged(rows: DataFrame) -> DataFrame:
    """The table with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 marks the row
    gone, 1 empties the text, 2 removes its [.!?], 3 repeats the row, 4 sets role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                       (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") == 0).alias(GONE_COLUMN), F.explode(copies).alias("copy")).drop("copy")
