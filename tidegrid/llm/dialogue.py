"""Repair of conversations: the cheapest edits that make the roles alternate, found by a dynamic program over role states.

Edits keep, re-role or delete a row, or insert an empty one. What is compared besides costs are the audits, the edits'
initials in order. They are persistent strings: nodes that point at the string without its last letter, with
binary-lifting ancestors and a rolling hash of the whole. Two of equal cost are compared at the end of their longest common
prefix, found by descending over ancestors of equal hash; equal hashes are verified letter by letter.

Rows are dealt by ranges of conversation and turn, so a long conversation spans tasks and pieces of bounded size. A piece
of an unfinished conversation is reduced to the cheapest audit from each role state to each other; these compose in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import stored

#: What the repaired roles have come to: nothing yet, the system's turn, the user's or the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: State that comes after each one if the role is ours to choose, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Costs of the edits; a row whose text breaks off costs ``CUT_OFF`` more unless it is deleted.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
#: Rows and characters that a piece of a conversation has at most (a longer row is a piece of its own).
PIECE_ROWS, PIECE_CHARS = 1024, 4_000_000
#: Modulus and base of the rolling hash.
MODULUS, BASE = (1 << 61) - 1, 0x5851F42D4C957F2D
#: White space: a blank text has nothing else.
WHITE = " \t\n\x0b\x0c\r"


class Trails:
    """Strings that share their beginnings; a string is the number of its last node, 0 the empty one."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.up: list[list[int]] = [[]]
        self.depth, self.hash, self.last = [0], [0], [""]
        self._verified: set[tuple[int, int]] = set()

    def add(self, node: int, letter: str) -> int:
        ups, k = [node], 0
        while k < len(self.up[ups[k]]):
            ups.append(self.up[ups[k]][k])
            k += 1
        self.up.append(ups)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % self.modulus)
        self.last.append(letter)
        return len(self.up) - 1

    def prefix(self, node: int, depth: int) -> int:
        """The first ``depth`` letters."""
        drop, k = self.depth[node] - depth, 0
        while drop:
            if drop & 1:
                node = self.up[node][k]
            drop, k = drop >> 1, k + 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal; letters decide where hashes agree."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        x, y, walked = a, b, []
        while x != y and (x, y) not in self._verified:
            if self.last[x] != self.last[y]:
                return False
            walked.append((x, y))
            x, y = self.up[x][0], self.up[y][0]
        self._verified.update(walked)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether string ``a`` sorts before string ``b``."""
        size = min(self.depth[a], self.depth[b])
        x, y = self.prefix(a, size), self.prefix(b, size)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.last[x] < self.last[y]  # the strings before are equal

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.last[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Row(NamedTuple):
    """A row of a conversation; ``fault`` is blank, duplicate, cut (off) or nothing."""

    turn: int | None
    role: str
    text: str
    fault: str


#: Cheapest way to each state: cost and audit, or None.
Ways = list[tuple[int, int] | None]


class Search:
    """The dynamic program over the rows of a piece."""

    def __init__(self, modulus: int = MODULUS):
        self.trails = Trails(modulus)

    def _offer(self, ways: list, state: int, cost: int, node: int, letter: str) -> None:
        now = ways[state]
        if now is None or cost < now[0]:
            ways[state] = (cost, node, letter)
        elif cost == now[0]:
            mine, old = self.trails.add(node, letter), self._node(now)
            ways[state] = (cost, mine, "") if self.trails.less(mine, old) else (cost, old, "")

    def _node(self, way: tuple[int, int, str]) -> int:
        return self.trails.add(way[1], way[2]) if way[2] else way[1]

    def _settled(self, ways: list) -> Ways:
        return [None if w is None else (w[0], self._node(w)) for w in ways]

    def inserted(self, ways: Ways) -> Ways:
        """With inserted rows where they make a state cheaper (or its audit lesser)."""
        while True:
            new = [None if w is None else (*w, "") for w in ways]
            for state, way in enumerate(ways):
                if way:
                    self._offer(new, NEXT[state], way[0] + INSERT, way[1], "I")
            settled = self._settled(new)
            if settled == ways:
                return ways
            ways = settled

    def after(self, ways: Ways, row: Row) -> Ways:
        new: list = [None] * 4
        initial, extra = row.role[:1], CUT_OFF if row.fault == "cut" else 0
        for state, way in enumerate(self.inserted(ways)):
            if way is None:
                continue
            cost, node = way
            self._offer(new, state, cost + DELETE, node, "D")
            if row.fault in ("blank", "duplicate"):
                continue
            to = kept_state(state, initial)
            if to is not None:
                self._offer(new, to, cost + extra, node, "K")
            self._offer(new, NEXT[state], cost + REROLE + extra, node, "R")
        return self._settled(new)

    def run(self, rows: list[Row], state: int = START) -> Ways:
        ways: Ways = [None] * 4
        ways[state] = (0, 0)
        for row in rows:
            ways = self.after(ways, row)
        return ways

    def finish(self, ways: Ways) -> tuple[int, str]:
        """Cost and audit of the cheapest way to a state that a conversation may end in."""
        ends = [w for w in map(self.inserted(ways).__getitem__, ACCEPTED) if w]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or other[0] == best[0] and self.trails.less(other[1], best[1]):
                best = other
        return best[0], self.trails.text(best[1])


def kept_state(state: int, initial: str) -> int | None:
    """Where a kept row of a role leads, if it may stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def apply_audit(audit: str, rows: Iterator[Row]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows."""
    state = START
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield ROLES[state], ""
            continue
        row = next(rows)
        if letter == "K":
            state = kept_state(state, row.role[:1])
            yield row.role, row.text
        elif letter == "R":
            state = NEXT[state]
            yield ROLES[state], row.text


def digest(lines: Iterator[tuple[str, str]]) -> str:
    """SHA-256 of the lines ``role:text``, joined by newlines."""
    out, first = hashlib.sha256(), True
    for role, text in lines:
        out.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        first = False
    return out.hexdigest()


class Counts:
    """What is counted along a conversation, over its rows or over its pieces."""

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = None
        self.first_turn = self.last_turn = None

    def add(self, row: Row) -> None:
        self._join(row.role[:1], row.role[:1], row.turn, row.turn, int(row.turn is not None))
        self.rows += 1
        self.blank += row.fault == "blank"
        self.duplicate += row.fault == "duplicate"
        self.truncated += row.fault == "cut"

    def append(self, other: Counts) -> None:
        if other.rows:
            self._join(other.first_role, other.last_role, other.first_turn, other.last_turn, other.turns)
        for name in ("rows", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))

    def _join(self, first_role: str, last_role: str, first_turn: int | None, last_turn: int | None, turns: int) -> None:
        if self.rows:
            self.illegal += self.last_role + first_role not in LEGAL
        else:
            self.first_role = first_role
        self.last_role = last_role
        if first_turn is not None:
            self.turns += turns - (first_turn == self.last_turn)
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns

    def state(self) -> list[str | None]:
        return [None if v is None else str(v) for v in vars(self).values()]

    @classmethod
    def of(cls, state: list[str | None]) -> Counts:
        out = cls()
        for name, v in zip(vars(out), state):
            setattr(out, name, v if "role" in name else None if v is None else int(v))
        return out


_RESULT = ("conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
_PIECE = _RESULT + ", part int, serial bigint, counts array<string>, costs array<bigint>, audits array<string>"


def _schema(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _batch(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string()),
             "array<bigint>": pa.list_(pa.int64())}
    columns = [c.split() for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in columns],
                                      names=[name for name, _ in columns])


def _result(conv: str | None, counts: Counts, cost: int, audit: str, sha: str | None) -> dict:
    return {"conv": conv, "gaps": counts.gaps, "blank": counts.blank, "duplicate": counts.duplicate,
            "truncated": counts.truncated, "illegal": counts.illegal, "cost": cost, "audit": audit, "repaired_sha256": sha}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            yield from batch.slice(start, 512).to_pylist()


def _expanded(rows: Iterator[dict]) -> Iterator[tuple[str | None, Row | None]]:
    """Conversation and row, as often as the row is there; None for a conversation alone. A mark that stands before its row
    says that the row has been seen at an earlier turn."""
    marked = None
    for r in rows:
        key = r["conv"], r["turn"], r["role"], r["sha"]
        if not r["kind"]:
            marked = key
            continue
        if not r["n"]:
            yield r["conv"], None
        turn = None if r["turn"] is None else int(r["turn"])
        seen = marked == key
        for _ in range(r["n"]):
            fault = "blank" if r["blank"] else "duplicate" if seen else "cut" if r["cut"] else ""
            seen = True
            yield r["conv"], Row(turn, r["role"], r["text"], fault)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished results of conversations that lie within the task, and pieces of the first and last one and of long ones."""
    part, serial = TaskContext.get().partitionId(), 0
    conv, held, chars, opened, out = None, [], 0, True, []

    def close(whole: bool) -> dict:
        nonlocal serial
        counts, search = Counts(), Search()
        for row in held:
            counts.add(row)
        ways = search.run(held)
        cost, audit = search.finish(ways)
        found = _result(conv, counts, cost, audit, digest(apply_audit(audit, iter(held))))
        if whole:
            return found
        costs, audits = [], []
        for state in range(4):
            own = Search()
            for way in own.run(held, state):
                costs.append(None if way is None else way[0])
                audits.append(None if way is None else own.trails.text(way[1]))
        serial += 1
        return found | {"part": part, "serial": serial, "counts": counts.state(), "costs": costs, "audits": audits}

    began = False
    for name, row in _expanded(_rows(batches)):
        if began and name != conv:
            out.append(close(not opened))
            conv, held, chars, opened = name, [], 0, False
        began, conv = True, name
        if row is None:
            continue
        if held and (len(held) >= PIECE_ROWS or chars + len(row.text) > PIECE_CHARS):
            out.append(close(False))
            held, chars, opened = [], 0, True
        held.append(row)
        chars += len(row.text)
        if len(out) >= 1000:
            yield _batch(out, _PIECE)
            out = []
    if began:
        out.append(close(False))
    yield _batch(out, _PIECE)


class Link(NamedTuple):
    """The audit of one piece after those before."""

    before: Link | None
    audit: str


def _link_less(a: Link | None, b: Link | None) -> bool:
    """Compare audits of as many pieces each, from the last one that they share."""
    x, y = [], []
    while a is not b:
        x.append(a.audit)
        y.append(b.audit)
        a, b = a.before, b.before
    return "".join(reversed(x)) < "".join(reversed(y))


def _joined(link: Link | None) -> str:
    out = []
    while link is not None:
        out.append(link.audit)
        link = link.before
    return "".join(reversed(out))


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations from their pieces, which come in order; without a digest if there are several."""
    conv, counts, ways, seen, single = None, Counts(), [], 0, None

    def close() -> dict:
        if seen == 1:
            return single
        search, ends = Search(), []
        for state, way in enumerate(ways):
            for to, end in enumerate(search.inserted([(0, 0) if s == state else None for s in range(4)])) if way else ():
                if end and to in ACCEPTED:
                    ends.append((way[0] + end[0], Link(way[1], search.trails.text(end[1]))))
        cost = min(c for c, _ in ends)
        audits = [link for c, link in ends if c == cost]
        best = audits[0]
        for other in audits[1:]:
            best = other if _link_less(other, best) else best
        return _result(conv, counts, cost, _joined(best), None)

    for r in _rows(batches):
        if seen and r["conv"] != conv:
            yield _batch([close()], _RESULT)
            seen = 0
        if not seen:
            conv, counts, single = r["conv"], Counts(), {k: r[k] for k in _schema(_RESULT)}
            ways = [(0, None), None, None, None]
        seen += 1
        counts.append(Counts.of(r["counts"]))
        new: list = [None] * 4
        for state, way in enumerate(ways):
            for to in range(4) if way else ():
                cost, audit = r["costs"][4 * state + to], r["audits"][4 * state + to]
                if cost is None:
                    continue
                offered = way[0] + cost, Link(way[1], audit)
                now = new[to]
                if now is None or offered[0] < now[0] or offered[0] == now[0] and _link_less(offered[1], now[1]):
                    new[to] = offered
        ways = new
    if seen:
        yield _batch([close()], _RESULT)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, str, Iterator[Row]]]:
    """Conversation, audit and rows, from rows before which the conversation's audit stands."""
    rows = _rows(batches)
    head = next(rows, None)

    while head is not None:
        conv, audit, following = head["conv"], head["audit"], None

        def own() -> Iterator[dict]:
            nonlocal following
            for r in rows:
                if r["kind"] < 0:
                    following = r
                    return
                yield r

        mine = own()
        yield conv, audit, (row for _, row in _expanded(mine) if row)
        for _ in mine:  # rows that the caller has not asked for
            pass
        head = following


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, audit, rows in _conversations(batches):
        yield _batch([{"conv": conv, "sha": digest(apply_audit(audit, rows))}], "conv string, sha string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ddl, out, chars = "conv string, place bigint, role string, text string", [], 0
    for conv, audit, rows in _conversations(batches):
        for place, (role, text) in enumerate(apply_audit(audit, rows)):
            out.append({"conv": conv, "place": place, "role": role, "text": text})
            chars += len(text)
            if chars > PIECE_CHARS or len(out) >= 10_000:
                yield _batch(out, ddl)
                out, chars = [], 0
    yield _batch(out, ddl)


def _white_end(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def _prepared(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: Column | None) -> DataFrame:
    """Different rows with their number ``n`` and what is needed to order and judge them; ``n`` is 0 where a row stands for its
    conversation alone. Marks of rows whose role and text an earlier turn has precede them (``kind`` 0)."""
    times = F.lit(1) if copies is None else copies
    there = times > 0
    empty = F.lit("")
    plain = df.select(
        F.col(conv_col).cast("string").alias("conv"), F.when(there, F.col(turn_col)).cast("bigint").alias("turn"),
        F.when(there, F.coalesce(F.col(role_col), F.lit(" "))).otherwise(empty).alias("role"),
        F.when(there, F.coalesce(F.col(text_col), F.lit(" "))).otherwise(empty).alias("text"), times.cast("bigint").alias("n"))
    body = _white_end(F.col("text"))
    rows = stored(plain.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).select(
        "conv", "turn", "role", "text", "n", F.sha2("text", 256).alias("sha"), (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut")))
    slim = rows.filter("n > 0 and not blank").select("conv", "turn", "role", "sha")
    firsts = (slim.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s"))
              .agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull().cast("int")).alias("none"),
                   F.count(F.lit(1)).alias("times")).filter("times > 1"))
    later = F.when(F.col("none") == 1, F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    marks = slim.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s")))
    marks = marks.filter(later).select("conv", "turn", "role", "sha", F.lit(0).alias("kind"))
    return rows.withColumn("kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)


_ORDER = ["conv", "turn", "role", "sha", "kind"]


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("turn", F.col("turn").cast("string"))


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of the conversations of ``audits (conv, audit)`` by conversation, each behind its audit."""
    own = rows.join(audits.select(F.col("conv").alias("c")), F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    heads = audits.select("conv", "audit", F.lit(-1).alias("kind"))
    ordered = own.unionByName(heads, allowMissingColumns=True).withColumn("head", F.col("kind") >= 0)
    return _as_text(ordered.repartition("conv").sortWithinPartitions("conv", "head", *_ORDER[1:])).drop("head")


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies: Column | None = None) -> DataFrame:
    """``(conv_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``, a row for each conversation.

    Rows are ordered by turn (missing ones first), then role, then the SHA-256 of the text; a missing role or text is one
    space. ``copies`` says how often a row is there: rows that are there 0 times only name their conversation. A row's first
    fault counts: ``blank`` (white space only), ``duplicate`` (same role and text earlier), ``truncated`` (does not end in
    ``.!?``). Blank and duplicate rows are deleted. Roles go by their first letter and must spell ``(s?(ua)+)?``. ``audit`` has
    the initials of the cheapest edits (Keep, Rerole, Delete, Insert), the least by ASCII of equal ones. A missing
    conversation id is a conversation; a conversation without rows has zeros and an empty audit; a table without rows
    has no result. Repeated rows are duplicates. Other columns are not read.

    All rows are sorted once; a conversation of any length is cut into pieces of ``PIECE_ROWS`` rows. Only the digest of a
    conversation that spans pieces is taken in one task, as a digest must be, from a stream of its rows.
    """
    return _named(_repair(_prepared(df, conv_col, turn_col, role_col, text_col, copies)), df, conv_col)


def _named(found: DataFrame, df: DataFrame, conv_col: str) -> DataFrame:
    return found.select(F.col("conv").cast(df.schema[conv_col].dataType).alias(conv_col), *[c for c in found.columns if c != "conv"])


def _repair(rows: DataFrame) -> DataFrame:
    names = _schema(_RESULT)
    dealt = _as_text(rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER))
    found = stored(dealt.mapInArrow(_pieces, _PIECE))
    pieces = found.filter("part is not null").repartition("conv").sortWithinPartitions("conv", "part", "serial")
    composed = stored(pieces.mapInArrow(_compose, _RESULT))
    spread = composed.filter("repaired_sha256 is null")
    hashed = _with_audits(rows, spread.select("conv", "audit")).mapInArrow(_digests, "conv string, sha string").select(
        F.col("conv").alias("c"), "sha")
    finished = spread.join(hashed, F.col("conv").eqNullSafe(F.col("c"))).withColumn("repaired_sha256", F.col("sha"))
    return reduce(DataFrame.unionByName, [found.filter("part is null").select(*names),
                         composed.filter("repaired_sha256 is not null").select(*names), finished.select(*names)])


def repaired(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``(conv_col, place, role, text)``: the rows of the repaired conversations, numbered from 0; see :func:`repair`."""
    rows = _prepared(df, conv_col, turn_col, role_col, text_col, None)
    audits = stored(_repair(rows).select("conv", "audit"))
    ddl = "conv string, place bigint, role string, text string"
    return _named(_with_audits(rows, audits).mapInArrow(_repaired, ddl), df, conv_col)
