"""Conversation structure repair: the cheapest edits that make a conversation alternate.

Every row is one symbol: its role's initial and its fault.  Equal consecutive symbols are
collapsed to runs; a run of length L is one min-plus product with the L-th power of its
symbol's transition over the states of ``(s?(ua)+)?``, put together from cached binary
powers.  Walking the runs backward gives the cost to go at every run's end; walking them
forward unrolls the choices into the audit, the ASCII-least of the cheapest ones."""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import give_back, small, stored

SPACE = " \t\n\x0b\x0c\r"            # the six white-space characters
ENDS = ".!?"                          # a text that ends in none of them is truncated
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5      # costs; the last is added to an undeleted truncated row
BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW, SOUND_ROW = "b", "d", "t", "-"

# states: nothing yet, after a system row, after a user row, after an assistant row
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
NEXT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURN = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}     # the initial that an added or re-roled row gets
NAME = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60
MAX_INSERTS = 3                       # by then every state has been reached
UNROLLED = 64                         # rows of a run unrolled at once

ROW = "conv_id bigint, turn bigint, role string, text string"
REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def steps(state: int, symbol: str) -> list:
    """(cost, token, next state) of all ways past one row: insertions before it, then its own edit."""
    initial, fault = symbol[:-1], symbol[-1]
    out = []
    for added in range(MAX_INSERTS + 1):
        paid, letters = INSERT * added, "I" * added
        out.append((paid + DELETE, letters + "D", state))
        if fault not in (BLANK_ROW, DUPLICATE_ROW):
            spoilt = TRUNCATED * (fault == TRUNCATED_ROW)
            if (state, initial) in NEXT:
                out.append((paid + KEEP + spoilt, letters + "K", NEXT[state, initial]))
            out.append((paid + REROLE + spoilt, letters + "R", NEXT[state, TURN[state]]))
        state = NEXT[state, TURN[state]]
    return out


def product(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in STATES) for row in a)


def end_costs() -> tuple:
    """Cost from every state to an accepted end, and the insertions it takes."""
    costs, added = [], []
    for state in STATES:
        n = 0
        while state not in (NOTHING, ASSISTANT):
            state, n = NEXT[state, TURN[state]], n + 1
        costs.append(INSERT * n)
        added.append("I" * n)
    return tuple(costs), added


class Machine:
    """Cached transitions, binary powers and unrolled runs; the caches are of bounded size."""

    LIMIT = 100_000

    def __init__(self):
        self.powers, self.ways, self.backs, self.fronts = {}, {}, {}, {}
        self.end, self.tail = end_costs()

    def power(self, symbol: str, bit: int) -> tuple:
        """The transition of 2**bit rows of this symbol."""
        own = self.powers.setdefault(symbol, [])
        while len(own) <= bit:
            if own:
                own.append(product(own[-1], own[-1]))
            else:
                first = [[NEVER] * len(STATES) for _ in STATES]
                for state in STATES:
                    for cost, _, to in steps(state, symbol):
                        first[state][to] = min(first[state][to], cost)
                own.append(tuple(map(tuple, first)))
        return own[bit]

    def back(self, symbol: str, length: int, after: tuple) -> tuple:
        """Cost to go before ``length`` rows of a symbol, from the one behind them: (vector
        less its least entry, that entry)."""
        key = (symbol, length, after)
        if key not in self.backs:
            if len(self.backs) > self.LIMIT:
                self.backs.clear()
            vector = after
            for bit in range(length.bit_length()):
                if length >> bit & 1:
                    vector = tuple(min(x + v for x, v in zip(row, vector)) for row in self.power(symbol, bit))
            low = min(vector)
            self.backs[key] = tuple(v - low for v in vector), low
        return self.backs[key]

    def front(self, symbol: str, length: int, state: int, after: tuple) -> tuple:
        """The least tokens of a run entered in ``state``, and the state it is left in."""
        key = (symbol, length, state, after)
        if key not in self.fronts:
            if len(self.fronts) > self.LIMIT:
                self.fronts.clear()
            if length > UNROLLED:                       # the first half, then the second, by the same powers
                half = length // 2
                one, state = self.front(symbol, half, state, self.back(symbol, length - half, after)[0])
                two, state = self.front(symbol, length - half, state, after)
                return one + two, state                 # long ones are not kept
            tokens = []
            for left in range(length - 1, -1, -1):
                then = self.back(symbol, left, after)[0] if left else after
                _, token, state = min((cost + then[to], token, to) for cost, token, to in steps(state, symbol))
                tokens.append(token)
            self.fronts[key] = "".join(tokens), state
        return self.fronts[key]

    def solve(self, runs: list) -> tuple:
        """(cost, audit) of a conversation given as (symbol, length) runs."""
        low = min(self.end)
        vector, total, behind = tuple(v - low for v in self.end), low, []
        intern = {}
        for symbol, length in reversed(runs):
            behind.append(intern.setdefault(vector, vector))     # few vectors differ: one object each
            vector, low = self.back(symbol, length, vector)
            total += low
        total += vector[NOTHING]
        state, letters = NOTHING, []
        for symbol, length in runs:
            token, state = self.front(symbol, length, state, behind.pop())
            letters.append(token)
        return total, "".join(letters) + self.tail[state]


def row_order(turn: str = "turn", role: str = "role", text: str = "text") -> list:
    return [F.col(turn).asc_nulls_first(), F.col(role).asc(), F.col(text).asc()]


def cleaned(rows: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, turn, role and text (null: one space), and whether the row is there."""
    here = F.coalesce(F.col(present).cast("boolean"), F.lit(True)) if present else F.lit(True)
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), here.alias("present"))


def flagged(rows: DataFrame) -> DataFrame:
    """Rows without their texts but in order: initial, fault apart from repeats, and whether
    the same role and text occur at an earlier turn.

    First turns are aggregated by hash (128 bits) where a text repeats, so a text of a third
    of all rows is one row a task before the shuffle."""
    hashes = (F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    known = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))     # a null turn comes first
    marks = rows.where("present").select("conv_id", "role", *hashes, known.alias("at"))
    first = marks.groupBy("conv_id", "role", "h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last")) \
        .where("first <> last").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), "h1", "h2", "first")
    first = small(stored(first, "repeated-turns"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", BLANK_ROW).when(~F.substring(trimmed, -1, 1).isin(*ENDS), TRUNCATED_ROW).otherwise(SOUND_ROW)
    a = rows.select("*", *hashes, fault.alias("fault"), known.alias("at"))
    met = a.conv_id.eqNullSafe(first.c) & (a.role == first.r) & (a.h1 == first.h1) & (a.h2 == first.h2)
    return a.join(first, met, "left").select(
        "conv_id", "present", "turn", "role", "text", a.h1, a.h2, "fault",
        F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("again"))


def by_conversation(batches, columns: list):
    """(conv_id, iterator of its rows) of batches sorted by conversation; nothing is held."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in columns))
    return groupby(rows(), key=lambda r: r[0])


def inspect(rows: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation.

    Rows are taken by turn (nulls first), those of one turn by role and text.  Null roles and
    texts count as one space, a null conv_id is a conversation of its own; repeated rows are
    duplicates.  Rows whose ``present`` is false are not there but keep their conversation
    in the result (zeros, empty audit).  Further columns are not looked at.  One task goes
    through a conversation, holding a symbol a run and the audit it has to return, never
    its texts."""
    rows = flagged(cleaned(rows, present))
    columns = ["conv_id", "present", "turn", "initial", "h1", "h2", "fault", "again", "role_hash"]
    ordered = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *row_order()) \
        .select("conv_id", "present", "turn", F.substring("role", 1, 1).alias("initial"), "h1", "h2", "fault", "again",
                F.xxhash64("role").alias("role_hash"))

    def run(batches):
        machine, out = Machine(), []
        for conv, own in by_conversation(batches, columns):
            count = dict.fromkeys((BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW, SOUND_ROW), 0)
            runs, illegal, turns, low, high = [], 0, 0, None, None
            last_turn, last_initial, last_row, last_symbol, length = None, None, None, None, 0
            for _, here, turn, initial, h1, h2, fault, again, role in own:
                if not here:
                    continue
                if turn is not None and turn != last_turn:
                    low = turn if low is None else low
                    high, last_turn, turns = turn, turn, turns + 1
                if fault != BLANK_ROW and (again or last_row == (turn, role, h1, h2)):
                    fault = DUPLICATE_ROW
                last_row = (turn, role, h1, h2)
                count[fault] += 1
                if last_initial is not None and last_initial + initial not in LEGAL:
                    illegal += 1
                last_initial = initial
                symbol = (initial if initial in ("s", "u", "a") else "") + fault
                if fault in (BLANK_ROW, DUPLICATE_ROW):
                    symbol = BLANK_ROW                   # both have to go, whatever their role
                if symbol == last_symbol:
                    length += 1
                else:
                    if length:
                        runs.append((last_symbol, length))
                    last_symbol, length = symbol, 1
            if length:
                runs.append((last_symbol, length))
            cost, audit = machine.solve(runs)
            gaps = high - low + 1 - turns if turns else 0
            out.append((conv, gaps, count[BLANK_ROW], count[DUPLICATE_ROW], count[TRUNCATED_ROW], illegal, cost, audit))
            if len(out) >= 1000 or len(audit) > 1 << 20:
                yield as_batch(out, INSPECTED)
                out = []
        yield as_batch(out, INSPECTED)
        give_back()

    return ordered.mapInArrow(run, f"conv_id bigint, {REPORT}")


INSPECTED = [("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
             ("audit", pa.string())]


def as_batch(rows: list, fields: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's report (as ``inspect`` gives it), then its rows in order; one task each."""
    texts = rows.where("present").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text")
    first = audits.select("conv_id", F.lit(0).alias("kind"), F.struct(*[c for c, _ in INSPECTED[1:]]).alias("report"))
    return first.unionByName(texts, allowMissingColumns=True).repartition("conv_id") \
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *row_order()) \
        .select("conv_id", "report", "role", "text")


def walk(audit: str, own):
    """(role, text) of the repaired rows of one conversation, one at a time."""
    state, at = NOTHING, 0

    def inserted():
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            initial = TURN[state]
            state, at = NEXT[state, initial], at + 1
            yield NAME[initial], ""

    for _, _, role, text in own:
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit != "D":
            initial = role[0] if edit == "K" else TURN[state]
            state = NEXT[state, initial]
            yield (role if edit == "K" else NAME[initial]), text
    yield from inserted()


def repair(rows: DataFrame, present: str | None = None, audits: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text.  ``audits`` is the
    result of ``inspect`` for the same rows, made anew if not given; what it says of nulls,
    ties, repeated rows and further columns holds here."""
    audits = inspect(rows, present) if audits is None else audits

    def run(batches):
        out, held = [], 0
        for conv, own in by_conversation(batches, SORTED):
            audit = next(own)[1]["audit"]
            for i, (role, text) in enumerate(walk(audit, own)):
                out.append((conv, i, role, text))
                held += len(text)
                if len(out) >= 2000 or held > 1 << 22:
                    yield as_batch(out, REPAIRED)
                    out, held = [], 0
        yield as_batch(out, REPAIRED)
        give_back()

    return with_audits(cleaned(rows, present), audits).mapInArrow(run, "conv_id bigint, position bigint, role string, text string")


SORTED = ["conv_id", "report", "role", "text"]
REPAIRED = [("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())]


def digest(rows: DataFrame, present: str | None = None) -> DataFrame:
    """``inspect`` with repaired_sha256: of the repaired rows as ``role:text``, joined by
    newlines.  A hash is taken row after row, so one task reads a conversation's texts, but
    it holds none."""
    fields = [*INSPECTED, ("repaired_sha256", pa.string())]

    def run(batches):
        out = []
        for conv, own in by_conversation(batches, SORTED):
            report = next(own)[1]
            made, joint = hashlib.sha256(), ""
            for role, text in walk(report["audit"], own):
                made.update(f"{joint}{role}:{text}".encode())
                joint = "\n"
            out.append((conv, *report.values(), made.hexdigest()))
            if len(out) >= 1000 or len(report["audit"]) > 1 << 20:
                yield as_batch(out, fields)
                out = []
        yield as_batch(out, fields)
        give_back()

    return with_audits(cleaned(rows, present), inspect(rows, present)) \
        .mapInArrow(run, f"conv_id bigint, {REPORT}, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage by crc32(``conv_id:turn``) % 20, nulls being one space: 0 drops a
    row (``present`` false), 1 empties its text, 2 removes its sentence ends, 3 repeats it,
    4 makes it the user's."""
    def part(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), copies.alias("copy")) \
        .drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(damage(read_table(spark, sf_dir, "conversations")), "present")
