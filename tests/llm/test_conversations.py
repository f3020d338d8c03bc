"""Conversation repair against plain brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tessera.llm import op13_conversations as op

GRAMMAR = re.compile("(s?(ua)+)?")
ROLE = {"u": "user", "a": "assistant"}


def faults_of(rows):
    """Blank, duplicate, truncated or sound, row by row."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        if not solid:
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            out.append("-" if solid[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def every_script(rows):
    """(cost, audit, repaired rows) of the best of all edit scripts, with at most two rows added at a place."""
    faults, best = faults_of(rows), None
    gaps = [g for n in range(3) for g in itertools.product("ua", repeat=n)]
    choices = [["D"] + ([] if f in "bd" else ["K", "Ru", "Ra"]) for f in faults]
    for picks in itertools.product(*choices):
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for i in range(len(rows) + 1):
                cost, audit = cost + 5 * len(added[i]), audit + "I" * len(added[i])
                out += [(ROLE[x], "") for x in added[i]]
                if i < len(rows):
                    role, text = rows[i]
                    audit += picks[i][0]
                    cost += {"K": 0, "R": 1, "D": 2}[picks[i][0]] + 5 * (picks[i] != "D" and faults[i] == "t")
                    out += [] if picks[i] == "D" else [(role if picks[i] == "K" else ROLE[picks[i][1]], text)]
            if (best is None or (cost, audit) < best[:2]) and GRAMMAR.fullmatch("".join(r[:1] for r, _ in out)) \
                    and all(r for r, _ in out):
                best = (cost, audit, out)
    return best


def row_by_row(rows):
    """The same for any length: cheapest (cost, audit) from every place and state."""
    faults = faults_of(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    after = {"": (0, ""), "s": (10, "II"), "u": (5, "I"), "a": (0, "")}
    for (role, _), fault in zip(reversed(rows), reversed(faults)):
        now = {}
        for state in step:
            options = [(2 + after[state][0], "D" + after[state][1])]
            if fault not in "bd":
                for initial, to in step[state].items():
                    extra = 5 * (fault == "t") + after[to][0]
                    if role[:1] == initial:
                        options.append((extra, "K" + after[to][1]))
                    if initial in "ua":
                        options.append((1 + extra, "R" + after[to][1]))
            now[state] = min(options)
        for _ in range(4):                                # insertions before the row
            for state in step:
                to = "a" if state == "u" else "u"
                now[state] = min(now[state], (5 + now[to][0], "I" + now[to][1]))
        after = now
    return after[""]


def runs_of(rows):
    symbols = []
    for (role, _), fault in zip(rows, faults_of(rows)):
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        symbols.append("b" if fault in "bd" else initial + fault)
    return [(s, len(list(g))) for s, g in itertools.groupby(symbols)]


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", " ", "", "u"]
    return [(rng.choice(roles), rng.choice(["", " \t", "x", "ok.", f"text {rng.randrange(99)}!", f"cut {rng.randrange(99)}"])) for _ in range(n)]


def test_cheapest_of_all_scripts():
    rng, machine = random.Random(2), op.Machine()
    for _ in range(40):
        rows = random_rows(rng, rng.randrange(0, 3))
        want = every_script(rows)
        cost, audit = machine.solve(runs_of(rows))
        assert (cost, audit) == want[:2] == row_by_row(rows)
        assert list(op.walk(audit, ((0, None, r, t) for r, t in rows))) == want[2]


def test_long_runs_equal_rows_one_by_one():
    rng, machine = random.Random(4), op.Machine()
    for k in range(300):
        rows = []
        for _ in range(rng.randrange(1, 8)):
            row = random_rows(rng, 1)[0]
            for i in range(rng.choice([1, 1, 2, 3, 65, 130, 300])):
                rows.append((row[0], row[1].replace("text", f"text{k}-{len(rows)}").replace("cut", f"cut{len(rows)}")))
        assert machine.solve(runs_of(rows)) == row_by_row(rows)


def test_binary_powers_of_a_very_long_run():
    vector, low = op.Machine().back("u-", 1 << 40, (0, 0, 0, 0))
    assert (vector, low) == ((0, 0, 0, 0), 1 << 39)       # every second user row becomes an assistant's


def damaged(rows):
    """The contract's damage in plain Python."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def expected(rows):
    out = {}
    by_id = {}
    for conv, *_ in rows:
        by_id[conv] = []
    for conv, turn, role, text in damaged(rows):
        by_id[conv].append((turn is not None, turn or 0, role, text.encode(), text, turn))
    for conv, own in by_id.items():
        own.sort(key=lambda r: r[:4])
        pairs = [(r[2], r[4]) for r in own]
        turns = {r[5] for r in own if r[5] is not None}
        faults = faults_of(pairs)
        cost, audit = row_by_row(pairs)
        initials = [r[:1] for r, _ in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in op.walk(audit, ((0, None, r, t) for r, t in pairs)))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in "bdt"), illegal, cost,
                     audit, hashlib.sha256(text.encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, audit string, kind int, present boolean"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for conv in range(120):
        roles = ["system"] * (conv % 4 == 0) + ["user", "assistant"] * 4
        for turn, role in enumerate(roles[:rng.randrange(1, 9)]):
            role = rng.choice([role] * 6 + ["user", "tool", None, ""])
            text = rng.choice([f"Answer {conv} {turn}.", f"Answer {conv} {turn}.", "Same thing!", f"cut {turn}", None, " \n", "é?  "])
            out.append((conv, rng.choice([turn] * 5 + [turn + 2, None]), role, text))
    out += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, None, None, None)]
    out += [(500, 1, "user", f"tie {i}.") for i in (2, 0, 1)] + [(500, 2, "assistant", "A.")] * 3      # ties, repeated rows
    out += [(501, t, "user" if t % 2 else "assistant", f"turn {t}" + "." * (t % 5 > 0)) for t in range(3000)]
    out += [(502, t, "user", "again") for t in range(2000)]
    out += [(503, 0, "user", "x" * 200_000 + "?"), (503, 1, "assistant", "." + " " * 100_000)]
    out += [(c, 0, "user", "gone") for c in range(600, 700)]                                            # some lose their only row
    return out


def test_digest_against_brute_force(spark, rows):
    given = spark.createDataFrame([(*r, "x", 7, False) for r in rows], SCHEMA).repartition(5).drop("present")
    got = op.digest(op.damage(given), "present").collect()
    want = expected(rows)
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert any(v[5:] == (0, "", hashlib.sha256(b"").hexdigest()) for v in want.values())


def test_repaired_rows(spark, rows):
    given = spark.createDataFrame([(*r, "x", 7, False) for r in rows], SCHEMA).repartition(5)   # every "present" is false, but is not named
    repaired = op.repair(given)
    out = {}
    for r in repaired.orderBy("conv_id", "position").collect():
        out.setdefault(r.conv_id, []).append(r)
    for own in out.values():
        assert GRAMMAR.fullmatch("".join(r.role[:1] for r in own)) and [r.position for r in own] == list(range(len(own)))
        assert all(r.text == "" or re.search(r"[^\x20\x09-\x0D]", r.text) for r in own)
    audits = {r.conv_id: r.audit for r in op.inspect(given).collect()}
    assert all(len(out.get(c, [])) == len(a) - a.count("D") for c, a in audits.items()) and set(out) <= set(audits)


def test_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert op.digest(op.damage(none), "present").isEmpty() and op.repair(none).isEmpty() and op.inspect(none).isEmpty()
