"""Conversation structure repair by Hirschberg's divide and conquer over four states.

A repaired conversation is empty or ``system? (user assistant)+``, so an edited prefix is in one of four states: nothing yet,
after the system row, after a user row, after an assistant row. Each row is kept, given another role or deleted, and a row may be
inserted before it; inserts after the last row close the conversation. What comes before a row and what happens to it is a *block*
of letters (D, IK, IR, K, R). No block begins another, so audits compare block by block, and beside each state's least cost it is
enough to know how the least audits of the states compare with each other (``rank``).

Hirschberg: costs and ranks run forward over the first half and backward over the second; the state in which they meet cheapest, of
equals with the least audit, splits the problem in two. Memory is linear in the rows, time a logarithm more.

Rows are sorted by conversation and turn over the whole table (range partitions), so a conversation that holds a third of all rows is
spread over many tasks. A conversation that lies inside one partition is repaired there. What touches a partition's edge, or is
long, goes in *strips* of bounded size: each strip gives a 4 x 4 table of least costs and ranks between its ends, the
tables are chained by two streaming passes that choose the state at each end, and every strip is then rebuilt on its own.
The audit is one string and SHA-256 runs over one conversation's lines in order, so these two are streamed by one task per
conversation, strip by strip, which holds the audit and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrid.llm.blocks import arrow_type
from monthgrid.llm.words import parts
from monthgrid.session import stage

#: Rows and characters of a strip; longer conversations are repaired in several.
ROWS, CHARS = 8192, 4 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
#: What an edit costs; an undeleted truncated row costs TRUNCATED more.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLOCKS = ("D", "IK", "IR", "K", "R")  # in ASCII order
FINE, MUST_GO, CUT_OFF = range(3)
NONE = 1 << 60
BLANK = " \t\n\x0b\x0c\r"
#: State after a further user or assistant row.
_NEXT = (USER, USER, ASSISTANT, USER)
#: Inserts that close a conversation, per state, and their order as text.
_CLOSE = ((0, 0), (2 * INSERT, 2), (INSERT, 1), (0, 0))
_INITIALS = "sua"


def letter(role: str, fault: int) -> int:
    """A row as one of twelve letters: the initial of its role (s, u, a, other) and what is wrong with it."""
    return 3 * (_INITIALS.find(role[:1]) if role[:1] else -1) + 3 + fault


def _moves(code: int) -> list[list[tuple[int, int, int]]]:
    """Per state the ways to deal with a row: (block, cost, state after it)."""
    kind, fault = divmod(code, 3)
    initial, extra = "?sua"[kind], TRUNCATED if fault == CUT_OFF else 0

    def kept(state: int) -> int | None:
        if initial == "s":
            return SYSTEM if state == START else None
        return _NEXT[state] if initial == "ua"[_NEXT[state] - USER] else None

    out = []
    for state in range(4):
        ways = [(0, DELETE, state)]
        if fault != MUST_GO:
            for inserted, s in ((0, state), (1, _NEXT[state])):
                if (t := kept(s)) is not None:
                    ways.append((1 if inserted else 3, INSERT * inserted + extra, t))
                ways.append((2 if inserted else 4, INSERT * inserted + REROLE + extra, _NEXT[s]))
        out.append(ways)
    return out


MOVES = [_moves(code) for code in range(12)]
#: (costs, ranks) of a list of states, made relative to the least cost, and what was taken off.
_memo: dict = {}


def _settled(best: list) -> tuple[tuple, int]:
    """From (cost, order) per state to costs less the least of them, and dense ranks of the orders; and the least cost."""
    low = min(b[0] for b in best)
    order = {k: i for i, k in enumerate(sorted({b[1] for b in best if b[0] < NONE}))}
    return (tuple(b[0] - low if b[0] < NONE else NONE for b in best), tuple(order[b[1]] if b[0] < NONE else 0 for b in best)), low


def _forward(known: tuple, code: int) -> tuple[tuple, int]:
    """One row further; ``known`` may hold several sets of four states (one per state at the start), ranked together."""
    if (got := _memo.get((known, code, 0))) is None:
        cost, rank = known
        best = [(NONE, (0, 0))] * len(cost)
        for s, (c, r) in enumerate(zip(cost, rank)):
            if c < NONE:
                for block, price, t in MOVES[code][s % 4]:
                    t += s - s % 4
                    best[t] = min(best[t], (c + price, (r, block)))
        got = _memo[known, code, 0] = _settled(best)
    return got


def _backward(known: tuple, code: int) -> tuple[tuple, int]:
    """One row further to the front."""
    if (got := _memo.get((known, code, 1))) is None:
        cost, rank = known
        best = [min((cost[t] + price, (block, rank[t])) if cost[t] < NONE else (NONE, (0, 0)) for block, price, t in MOVES[code][s]) for s in range(4)]
        got = _memo[known, code, 1] = _settled(best)
    return got


def _at(state: int) -> tuple:
    """Only this state, at no cost."""
    return tuple(0 if s == state else NONE for s in range(4)), (0,) * 4


_CLOSED = tuple(c for c, _ in _CLOSE), tuple(r for _, r in _CLOSE)


def _run(step, known: tuple, codes: Iterable[int]) -> tuple:
    for code in codes:
        known, _ = step(known, code)
    return known


def blocks(codes: bytes, lo: int, hi: int, enter: int, leave: int | None) -> list[int]:
    """The least blocks for rows ``lo`` to ``hi`` between two states; ``leave`` None closes the conversation after them."""
    if lo == hi:
        return []
    after = _CLOSED if leave is None else _at(leave)
    if hi - lo == 1:
        return [min((price + after[0][t], block, after[1][t]) for block, price, t in MOVES[codes[lo]][enter])[1]]
    mid = (lo + hi) // 2
    f = _run(_forward, _at(enter), codes[lo:mid])
    b = _run(_backward, after, reversed(codes[mid:hi]))
    meet = min((f[0][t] + b[0][t], f[1][t], b[1][t], t) for t in range(4))[3]
    return blocks(codes, lo, mid, enter, meet) + blocks(codes, mid, hi, meet, leave)


def table(codes: bytes) -> tuple[list[int], list[int]]:
    """Least costs and ranks between any two states over these rows: 16 of each, ``4 * enter + leave``."""
    known, total = (tuple(0 if s // 4 == s % 4 else NONE for s in range(16)), (0,) * 16), 0
    for code in codes:
        known, more = _forward(known, code)
        total += more
    return [c + total if c < NONE else NONE for c in known[0]], list(known[1])


def faults(rows: list[tuple[str, str]], seen: set | None = None) -> list[str]:
    """First fault of each (role, text): blank, duplicate of an earlier row, truncated, or nothing."""
    seen, out = set() if seen is None else seen, []
    for row in rows:
        text = row[1].rstrip(BLANK)
        out.append("blank" if not text else "duplicate" if row in seen else "" if text[-1] in ".!?" else "truncated")
        seen.add(row)
    return out


_FAULT = {"": FINE, "blank": MUST_GO, "duplicate": MUST_GO, "truncated": CUT_OFF}


def rebuilt(rows: list[tuple[str, str]], codes: bytes, enter: int, leave: int | None) -> tuple[str, list[str], int]:
    """(audit, repaired lines, cost) of rows between two states."""
    audit, lines, cost, state = [], [], 0, enter

    def add(text: str, role: str | None = None):
        nonlocal state
        state = _NEXT[state]
        lines.append(f"{role or ('user', 'assistant')[state - USER]}:{text}")

    def insert():
        nonlocal cost
        add("")
        cost += INSERT

    for (role, text), code, block in zip(rows, codes, blocks(codes, 0, len(codes), enter, leave)):
        audit.append(BLOCKS[block])
        if block == 0:
            cost += DELETE
            continue
        if block < 3:
            insert()
        cost += TRUNCATED * (code % 3 == CUT_OFF)
        if BLOCKS[block][-1] == "R":
            cost += REROLE
            add(text)
        elif code // 3 == 1:
            state = SYSTEM
            lines.append(f"{role}:{text}")
        else:
            add(text, role)
    if leave is None:
        for _ in range(_CLOSE[state][1]):
            audit.append("I")
            insert()
    return "".join(audit), lines, cost


def illegal(initials: str) -> int:
    """Adjacent initials other than su, ua, au."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _initial(role: str) -> str:
    return role[:1] if role[:1] and role[:1] in _INITIALS else "?"


def repair(rows: list[tuple[int | None, str, str]]) -> dict:
    """A whole conversation of (turn, role, text) in order: its figures, the audit and the lines."""
    turns, lines = {t for t, _, _ in rows if t is not None}, [(r, t) for _, r, t in rows]
    found = faults(lines)
    codes = bytes(letter(r, _FAULT[f]) for (r, _), f in zip(lines, found))
    audit, kept, cost = rebuilt(lines, codes, START, None)
    return {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": illegal("".join(_initial(r) for r, _ in lines)), "cost": cost, "audit": audit, "lines": kept}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) after the contract's damage; dropped rows stay, emptied, as ``gone``."""
    space = F.lit(" ")
    c = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                             F.coalesce(F.col("text").cast("string"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    c = c.withColumn("hit", F.crc32(key.cast("binary")) % 20).withColumn("gone", F.col("hit") == 0)
    text = F.when(F.col("hit") <= 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 0, "").when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), "gone", times.alias("copy")).drop("copy")


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SOLVED = ", ".join(f"{f} bigint" for f in FIGURES) + ", audit string, repaired_sha256 string"
_LOOSE = "strip bigint, at int, turn bigint, role string, text string, gone boolean"


def _sha(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _scan(schema: pa.Schema, max_rows: int, max_chars: int):
    """Repairs the conversations inside a partition; those at its edges and long ones come out as rows of strips."""
    def solved(conv, rows):
        r = repair([x[:3] for x in rows if not x[3]])
        return {"conv_id": conv, **{f: r[f] for f in FIGURES}, "audit": r["audit"], "repaired_sha256": _sha(r["lines"])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip = TaskContext.get().partitionId() << 32
        conv, rows, chars, whole = None, None, 0, False
        out: list[dict] = []

        def loose():
            nonlocal rows, chars, strip
            out.extend({"conv_id": conv, "strip": strip, "at": i, "turn": t, "role": r, "text": x, "gone": g} for i, (t, r, x, g) in enumerate(rows))
            rows, chars, strip = [], 0, strip + 1

        for b in parts(batches, 64):
            for c, *row in zip(*(x.to_pylist() for x in b.columns)):
                if rows is None or c != conv:
                    if rows:
                        if whole:
                            out.append(solved(conv, rows))
                        else:
                            loose()
                    whole = rows is not None  # the first conversation may have begun in the partition before
                    conv, rows, chars = c, [], 0
                rows.append(row)
                chars += len(row[2])
                if len(rows) >= max_rows or chars >= max_chars:
                    loose()
                    whole = False
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        if rows:
            loose()  # the last one may go on in the partition after
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _tables(schema: pa.Schema):
    """A strip's letters, counts and table of costs."""
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["at"])
        found = ["duplicate" if r["again"] and r["fault"] != "blank" else r["fault"] for r in rows]
        codes = bytes(letter(r["role"], _FAULT[f]) for r, f in zip(rows, found))
        cost, rank = table(codes)
        initials = "".join(_initial(r["role"]) for r in rows)
        return pa.Table.from_pylist([{"key": rows[0]["key"], "strip": rows[0]["strip"], "codes": codes, "costs": cost, "ranks": rank, "initials": initials[0] + initials[-1],
                                      "illegal": illegal(initials), **{f: found.count(f) for f in ("blank", "duplicate", "truncated")}}], schema)
    return run


def _chain_back(schema: pa.Schema):
    """Strips of each conversation from the last to the first: the costs and ranks of closing it after each strip."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, after = None, _CLOSED
        for b in parts(batches, 256):
            out = []
            for r in b.to_pylist():
                if r["key"] != key:
                    key, after = r["key"], _CLOSED
                out.append({**r, "after_costs": list(after[0]), "after_ranks": list(after[1])})
                after, _ = _settled([min((r["costs"][4 * s + t] + after[0][t], (r["ranks"][4 * s + t], after[1][t])) if r["costs"][4 * s + t] < NONE and after[0][t] < NONE
                                         else (NONE, (0, 0)) for t in range(4)) for s in range(4)])
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _chain_on(schema: pa.Schema):
    """And from the first to the last: the state at each strip's ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, START
        for b in parts(batches, 256):
            out = []
            for r in b.to_pylist():
                if r["key"] != key:
                    key, state = r["key"], START
                cost, rank = r["costs"][4 * state:4 * state + 4], r["ranks"][4 * state:4 * state + 4]
                leave = min((cost[t] + r["after_costs"][t], rank[t], r["after_ranks"][t], t) for t in range(4))[3]
                out.append({"key": key, "strip": r["strip"], "codes": r["codes"], "enter": state, "leave": leave})
                state = leave
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _rebuild(schema: pa.Schema):
    def run(rows: pa.Table, ends: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_pylist([], schema)
        lines = [(r["role"], r["text"]) for r in sorted(rows.to_pylist(), key=lambda r: r["at"])]
        e = ends.to_pylist()[0]
        audit, kept, cost = rebuilt(lines, e["codes"], e["enter"], None if e["last"] else e["leave"])
        return pa.Table.from_pylist([{"key": e["key"], "strip": e["strip"], "audit": audit, "cost": cost, "n_lines": len(kept), "lines": "\n".join(kept),
                                      **{f: e[f] for f in ("initials", "illegal", "blank", "duplicate", "truncated")}}], schema)
    return run


def _join_strips(schema: pa.Schema):
    """Strips of each conversation in order to its figures; holds the audit, the running digest and one strip."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, done = None, None

        def closed():
            total["audit"], total["repaired_sha256"] = "".join(audit), digest.hexdigest()
            return pa.RecordBatch.from_pylist([{"key": key, **total}], schema)

        for b in parts(batches, 8):
            for r in b.to_pylist():
                if r["key"] != key or done is None:
                    if done is not None:
                        yield closed()
                    key, total, audit, digest, done, last = r["key"], dict.fromkeys(FIGURES[1:], 0), [], hashlib.sha256(), 0, ""
                for f in FIGURES[1:]:
                    total[f] += r[f]
                total["illegal"] += illegal(last + r["initials"][0]) if last else 0
                last = r["initials"][1]
                audit.append(r["audit"])
                if r["n_lines"]:
                    digest.update((b"\n" if done else b"") + r["lines"].encode())
                    done += r["n_lines"]
        if done is not None:
            yield closed()
    return run


def _from_strips(loose: DataFrame) -> DataFrame:
    """Repairs the conversations that came out in strips."""
    kind = loose.schema["conv_id"].dataType.simpleString()
    loose = loose.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    rows = loose.filter("NOT gone")
    ends_in = F.regexp_replace(F.substring(F.rtrim(F.translate("text", BLANK[1:], " " * 5)), -1, 1), "[.!?]", ".")
    fault = F.when(ends_in == "", "blank").when(ends_in == ".", "").otherwise("truncated")
    marked = rows.select("key", "strip", "at", F.substring("role", 1, 1).alias("role"), fault.alias("fault"),
                         F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"))
    place = F.struct("strip", "at")
    first = marked.groupBy("key", "same").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    marked = (marked.join(first, ["key", "same"], "left")
              .select("key", "strip", "at", "role", "fault", F.coalesce(place > F.col("first"), F.lit(False)).alias("again")))
    counts = "initials string, illegal bigint, blank bigint, duplicate bigint, truncated bigint"
    tabled = "key string, strip bigint, codes binary, costs array<bigint>, ranks array<bigint>, " + counts
    strips = stage(marked.groupBy("key", "strip").applyInArrow(_tables(_arrow(tabled)), tabled), "strips")
    chained = "key string, strip bigint, codes binary, costs array<bigint>, ranks array<bigint>, after_costs array<bigint>, after_ranks array<bigint>"
    ends = "key string, strip bigint, codes binary, enter int, leave int"
    found = (strips.select("key", "strip", "codes", "costs", "ranks").repartition("key")
             .sortWithinPartitions("key", F.desc("strip")).mapInArrow(_chain_back(_arrow(chained)), chained)
             .sortWithinPartitions("key", "strip").mapInArrow(_chain_on(_arrow(ends)), ends))
    last = strips.groupBy("key").agg(F.max("strip").alias("last_strip"))
    found = (found.join(last, "key").withColumn("last", F.col("strip") == F.col("last_strip")).drop("last_strip")
             .join(strips.drop("codes", "costs", "ranks"), ["key", "strip"]))
    built = "key string, strip bigint, audit string, cost bigint, n_lines bigint, lines string, " + counts
    pieces = stage(rows.select("key", "strip", "at", "role", "text").groupBy("key", "strip")
                   .cogroup(found.groupBy("key", "strip")).applyInArrow(_rebuild(_arrow(built)), built), "rebuilt")
    whole = "key string, " + ", ".join(f"{f} bigint" for f in FIGURES[1:]) + ", audit string, repaired_sha256 string"
    figures = pieces.repartition("key").sortWithinPartitions("key", "strip").mapInArrow(_join_strips(_arrow(whole)), whole)
    turns = (rows.groupBy("key").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.countDistinct("turn").alias("n"))
             .select("key", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).alias("gaps")))
    out = loose.groupBy("key").agg(F.first("conv_id").alias("conv_id")).join(turns, "key", "left").join(figures, "key", "left")
    return out.select(F.col("conv_id").cast(kind), *[F.coalesce(f, F.lit(0)).cast("bigint").alias(f) for f in FIGURES],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(_sha([]))).alias("repaired_sha256"))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in ddl.split(", "))])


def repaired(rows: DataFrame, max_rows: int = ROWS, max_chars: int = CHARS) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, gone): gaps, faults, cost, audit and digest of the cheapest repair.

    Rows are taken by turn, nulls first, equal turns by role and text. Rows marked ``gone`` only make their conversation known.
    A null conv_id is a conversation of its own; an empty role has no initial, so its row cannot be kept as it is. Role and text must not be null; other columns are not read. Conversations without
    rows have zeros, an empty audit and the digest of the empty text; an empty table gives none. Beyond ``max_rows`` rows or
    ``max_chars`` characters a conversation is repaired in strips, with the same result.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    first = F.substring("text", 1, 64).alias("begins")
    ordered = (rows.select("conv_id", "turn", "role", "text", "gone", first).repartitionByRange("conv_id", "turn", "role", "begins")
               .sortWithinPartitions("conv_id", "turn", "role", "text").drop("begins"))
    ddl = f"{_SOLVED}, {_LOOSE}"
    schema = pa.schema([("conv_id", arrow_type(kind)), *_arrow(ddl)])
    scanned = stage(ordered.mapInArrow(_scan(schema, max_rows, max_chars), f"conv_id {kind}, {ddl}"), "conversations")
    inside = scanned.filter("strip IS NULL").select("conv_id", *FIGURES, "audit", "repaired_sha256")
    return inside.unionByName(_from_strips(scanned.filter("strip IS NOT NULL").select("conv_id", *[c.split(" ")[0] for c in _LOOSE.split(", ")])))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _best(ways: list[tuple[str, str, str, str]]) -> str:
    """SQL: the least of (state, letters, cost, lines) continuations; a state that cannot be reached is null."""
    return "list_sort([x FOR x IN [" + ", ".join(
        f"CASE WHEN s{s}.c IS NOT NULL AND ({when}) THEN {{'c': s{s}.c + {cost}, 'a': s{s}.a || '{block}', 'x': s{s}.x || {lines}}} END"
        for s, block, when, cost, lines in ways) + "] IF x IS NOT NULL])[1]"


def _step(state: int) -> str:
    """SQL: the least way into a state over one row (r: role, t: text, i: initial, f: what is wrong with it)."""
    extra, fine = f"CASE WHEN f = {CUT_OFF} THEN {TRUNCATED} ELSE 0 END", f"f <> {MUST_GO}"
    own = "[r || ':' || t]"
    ways = [(state, "D", "true", str(DELETE), "[]::VARCHAR[]")]
    if state == SYSTEM:
        ways.append((START, "K", f"{fine} AND i = 's'", extra, own))
    if state in (USER, ASSISTANT):
        name, other = ("user", "assistant") if state == USER else ("assistant", "user")
        for s in range(4):
            direct = _NEXT[s] == state
            if not direct and _NEXT[_NEXT[s]] != state:
                continue
            more, put, mark = ("0", "", "") if direct else (str(INSERT), f"['{other}:'] || ", "I")
            ways.append((s, f"{mark}K", f"{fine} AND i = '{name[0]}'", f"{more} + {extra}", put + own))
            ways.append((s, f"{mark}R", fine, f"{more} + {REROLE} + {extra}", f"{put}['{name}:' || t]"))
    return _best(ways)


SQL = rf"""
WITH RECURSIVE bits AS (SELECT i, i::BIGINT AS v, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
keyed AS (SELECT conv_id, turn::BIGINT AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hit AS (SELECT keyed.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)),
               lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h FROM keyed, tab),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS r,
             CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS t
      FROM hit, range(2) x(n) WHERE h <> 0 AND (n = 0 OR h = 3)),
placed AS (SELECT conv_id, turn, r, t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, t) AS n,
                  rtrim(t, E' \t\n\x0B\x0C\r') AS core FROM d),
marked AS (SELECT *, CASE WHEN core = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, r, t ORDER BY n) > 1 THEN 'duplicate'
                          WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS bad,
                  left(r, 1) AS i, lag(left(r, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (bad = 'blank') AS blank,
                count(*) FILTER (bad = 'duplicate') AS duplicate, count(*) FILTER (bad = 'truncated') AS truncated,
                count(*) FILTER (n > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM marked GROUP BY 1),
codes AS (SELECT conv_id, n, r, t, i, CASE bad WHEN '' THEN {FINE} WHEN 'truncated' THEN {CUT_OFF} ELSE {MUST_GO} END AS f FROM marked),
walk AS (SELECT conv_id, 0::BIGINT AS n, {{'c': 0, 'a': '', 'x': []::VARCHAR[]}} AS s0, NULL::STRUCT(c INT, a VARCHAR, x VARCHAR[]) AS s1,
                NULL::STRUCT(c INT, a VARCHAR, x VARCHAR[]) AS s2, NULL::STRUCT(c INT, a VARCHAR, x VARCHAR[]) AS s3 FROM sums
  UNION ALL SELECT w.conv_id, c.n, {_step(0)}, {_step(1)}, {_step(2)}, {_step(3)}
  FROM walk w JOIN codes c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.n + 1),
ended AS (SELECT w.conv_id, {_best([(0, "", "true", "0", "[]::VARCHAR[]"), (1, "II", "true", str(2 * INSERT), "['user:', 'assistant:']"),
                                     (2, "I", "true", str(INSERT), "['assistant:']"), (3, "", "true", "0", "[]::VARCHAR[]")])} AS e
          FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.n)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost,
       coalesce(e.a, '') AS audit, sha256(coalesce(array_to_string(e.x, E'\n'), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
