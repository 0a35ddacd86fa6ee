import hashlib
import os
import random
import re
import zlib

import pytest

from monthgrid.llm import conversation as C

COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Least (cost, audit, lines) over every way to edit (role, text) rows, with inserts anywhere; a table of all states and rows."""
    found = C.faults(rows)
    best = {(): (0, "", ())}  # role initials of what has been written so far, as a state machine of its own

    def grow(best):
        """Adds up to three inserts at this place."""
        for _ in range(3):
            for seq, (c, a, x) in list(best.items()):
                for role in ("user", "assistant"):
                    put(best, seq, role[0], (c + 5, a + "I", (*x, f"{role}:")))

    def put(best, seq, initial, value):
        new = state(seq, initial)
        if new is not None and (new not in best or value < best[new]):
            best[new] = value

    def state(seq, initial):
        word = "".join(seq) + initial
        if not re.fullmatch("s?(ua)*u?", word):
            return None
        return (word,) if len(word) < 2 else tuple("s" if word[0] == "s" else "") + (("ua",) if word[-1] == "a" else ("uau",))

    for (role, text), fault in zip(rows, found):
        grow(best)
        new = {}
        for seq, (c, a, x) in best.items():
            value = (c + 2, a + "D", x)
            if seq not in new or value < new[seq]:
                new[seq] = value
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            if role:  # an empty role has no initial and cannot stay
                put(new, seq, role[:1], (c + extra, a + "K", (*x, f"{role}:{text}")))
            for other in ("user", "assistant"):
                put(new, seq, other[0], (c + 1 + extra, a + "R", (*x, f"{other}:{text}")))
        best = new
    grow(best)
    return min(v for seq, v in best.items() if re.fullmatch("(s?(ua)+)?", "".join(seq)))


def some_rows(rng, n):
    return [(rng.choice(["user", "assistant", "system", "tool", "u", "", " "]), rng.choice(["Yes.", "No", " ", "", "Well!\n", "a b?", "so", "x.", "y.", "z!"])) for _ in range(n)]


def test_repair_is_cheapest_and_audit_least():
    rng = random.Random(11)
    for k in range(1500):
        rows = some_rows(rng, k % 9)
        got = C.repair([(i, r, t) for i, (r, t) in enumerate(rows)])
        cost, audit, lines = plain(rows)
        assert (got["cost"], got["audit"], tuple(got["lines"])) == (cost, audit, lines), rows
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in got["lines"]))


def test_tables_of_parts_chain_to_the_whole():
    rng = random.Random(12)
    for _ in range(100):
        codes = bytes(rng.randrange(12) for _ in range(12))
        cost, rank = C.table(codes)
        for s in range(4):
            for t in range(4):
                if cost[4 * s + t] < C.NONE:
                    price = 0
                    state = s
                    for code, block in zip(codes, C.blocks(codes, 0, 12, s, t)):
                        price, state = next((price + p, u) for b, p, u in C.MOVES[code][state] if b == block)
                    assert (price, state) == (cost[4 * s + t], t)
        texts = sorted({tuple(C.blocks(codes, 0, 12, s, t)) for s in range(4) for t in range(4) if cost[4 * s + t] < C.NONE})
        assert [rank[4 * s + t] for s in range(4) for t in range(4) if cost[4 * s + t] < C.NONE] == [
            texts.index(tuple(C.blocks(codes, 0, 12, s, t))) for s in range(4) for t in range(4) if cost[4 * s + t] < C.NONE]


def expected(rows):
    """The contract's result for (conv_id, turn, role, text) rows, plainly."""
    out = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            out[c] += [(turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)] * (2 if h == 3 else 1)
    result = {}
    for c, kept in out.items():
        kept = sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        lines, turns = [r[1:] for r in kept], {r[0] for r in kept} - {None}
        found, (cost, audit, fixed) = C.faults(lines), plain(lines)
        result[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(lines, lines[1:])), cost, audit,
                     hashlib.sha256("\n".join(fixed).encode()).hexdigest())
    return result


def result(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[f] for f in (*C.FIGURES, "audit", "repaired_sha256")) for r in rows}


@pytest.mark.parametrize("strip", [(C.ROWS, C.CHARS), (3, 1000), (1, 1000), (50, 7)])
def test_table_with_odd_rows_hot_conversation_and_strips(spark, strip):
    rng = random.Random(13)
    rows = [(1, t, *some_rows(rng, 1)[0]) for t in range(150)]  # most of all rows in one conversation
    rows += [(c, t, *some_rows(rng, 1)[0]) for c in range(2, 12) for t in range(rng.randint(1, 8))]
    rows += [(20, None, "user", "Same."), (20, None, "user", "Same."), (20, 4, None, None), (20, 4, "user", "Later"), (None, 1, "user", "Hi."), (None, None, None, None),
             (21, None, None, None), (22, 5, "assistant", "x" * 5000)]
    rows += [(c, t, "user", "Gone.") for c in range(100, 400) for t in (1,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], COLUMNS + ", strip string, gone boolean").repartition(5)
    assert result(C.repaired(C.damaged(df), *strip)) == expected(rows)


def test_empty_table(spark):
    assert C.repaired(C.damaged(spark.createDataFrame([], COLUMNS))).count() == 0


def test_string_ids(spark):
    df = spark.createDataFrame([("a", 1, "user", "Hi."), ("b", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    assert {r["conv_id"] for r in C.repaired(C.damaged(df)).collect()} == {"a", "b"}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_registered_query_over_a_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(C.op11_conversation_repair(spark, sf)) == expected(rows)
