"""Conversation structure repair by rank-convergence parallel Viterbi (12).

A conversation's roles should read ``(s?(ua)+)?`` by their initials. Each turn is kept (cost 0), given the role user or
assistant (2) or deleted (3, and required of blank and repeated turns); empty user and assistant turns may be inserted
anywhere (2); a truncated turn that is not deleted adds 1. The repair is the cheapest list of edits, of equally cheap ones
the least in ASCII order of its audit (K, R, D and I in order).

The costs to the end from each of four states (nothing yet, behind s, u, a) are a vector that every turn maps to the one
in front of it, by sums and minima. Conversations are cut into pieces of bounded size, solved in parallel:

* Each piece starts from a speculative vector, that of a conversation's end, and works backwards.
* Fix-up passes give each piece the vector in front of the next one. Where it differs from the one used by more than a
  constant, the piece is run again, up to the turn from which its vectors differ from the earlier ones by a constant only:
  all before that turn stands. Passes repeat until no piece changes.
* With the stitched costs each piece is traced from every state that it may be entered in; which one it is follows from
  the pieces before it, whose state-to-state maps are composed pairwise (constant ones at once).

Turns are dealt by ranges of (conversation, turn, role, SHA-256 of the text) and sorted, so a conversation of any length
spreads over tasks; one within a task and within a piece's size is solved there and then. A repeated turn is known by a
marker of the first turn of its kind, sorted in just before it.

Results for special input: a null role or text counts as one space; null ids are one conversation; null turns come
first; turns of one number are in order of role, then of the text's SHA-256; an empty table gives no rows; other columns
are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from platewise.llm.common import BOOL, INT, LONG, STRING, fields, materialise, pick, width

ROWS, BYTES = 1024, 4 << 20
#: States: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant. Where a user or assistant turn leads, the only
#: one of the two that fits, and where keeping a turn leads, by its initial.
TURN = (2, 2, 3, 2)
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "-": (None,) * 4}
NAMES = {2: "user", 3: "assistant"}
END = "0420"  # inserts that complete the roles; vectors are written as four digits, the least of them 0
SPACES = " \t\n\x0b\x0c\r"


def code_of(role: str, text: str, first: bool) -> str:
    """Initial (s, u, a or -) and fault of a turn: b blank, t truncated, . none; T and D for repeated ones."""
    seen = text.strip(SPACES)
    fault = "b" if not seen else "." if seen[-1] in ".!?" else "t"
    if not first:
        fault = {"b": "b", "t": "T", ".": "D"}[fault]
    return (role[:1] if role[:1] in ("s", "u", "a") else "-") + fault


@lru_cache(maxsize=None)
def costs(code: str, behind: str) -> tuple[int, ...]:
    """Costs in front of a turn, from each state, given those behind it."""
    after, own = [int(c) for c in behind], []
    for x in range(4):
        c = [3 + after[x]]
        if code[1] in "t.":
            late, y = code[1] == "t", KEEP[code[0]][x]
            c += [2 + late + after[TURN[x]]] + ([late + after[y]] if y is not None else [])
        own.append(min(c))
    return tuple(min(own[x], 2 + own[TURN[x]], 4 + own[TURN[TURN[x]]]) for x in range(4))


@lru_cache(maxsize=None)
def front(code: str, behind: str) -> str:
    """The vector in front of a turn, less its smallest cost."""
    v = costs(code, behind)
    return "".join(str(c - min(v)) for c in v)


@lru_cache(maxsize=None)
def edit(code: str, behind: str, x: int) -> tuple[str, int, int]:
    """The least of the cheapest edits in front of a turn in state x, the state that it leads to, its cost."""
    after, v = [int(c) for c in behind], costs(code, behind)
    if 3 + after[x] == v[x]:
        return "D", x, 3
    if 2 + v[TURN[x]] == v[x]:
        return "I", TURN[x], 2
    late, y = int(code[1] == "t"), KEEP[code[0]][x]
    if y is not None and late + after[y] == v[x]:
        return "K", y, late
    return "R", TURN[x], 2 + late


def backward(codes: str, end: str, known: str | None = None) -> str:
    """The vectors in front of each turn, and ``end``; from where they equal the ``known`` ones on, those stand."""
    out, v = [end], end
    for i in reversed(range(len(codes) // 2)):
        v = front(codes[2 * i:2 * i + 2], v)
        if known is not None and known[4 * i:4 * i + 4] == v:
            return known[:4 * i + 4] + "".join(reversed(out))
        out.append(v)
    return "".join(reversed(out))


def trace(codes: str, vectors: str, x: int, last: bool) -> tuple[str, int, int]:
    """Audit, state behind the piece and cost, entered in state x; the last piece is completed."""
    audit, cost = [], 0
    for i in range(len(codes) // 2):
        letter = "I"
        while letter == "I":
            letter, x, c = edit(codes[2 * i:2 * i + 2], vectors[4 * i + 4:4 * i + 8], x)
            audit.append(letter)
            cost += c
    while last and END[x] != "0":
        audit.append("I")
        x, cost = TURN[x], cost + 2
    return "".join(audit), x, cost


def applied(turns: list, codes: str, audit: str, x: int) -> list[dict]:
    """The repaired turns of a piece entered in state x."""
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            x = TURN[x]
            out.append({"role": NAMES[x], "text": ""})
            continue
        if letter == "K":
            x = KEEP[codes[2 * i]][x]
            out.append({"role": turns[i]["role"], "text": turns[i]["text"]})
        elif letter == "R":
            x = TURN[x]
            out.append({"role": NAMES[x], "text": turns[i]["text"]})
        i += 1
    return out


def illegal(codes: str) -> int:
    initials = codes[::2]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def kinds(codes: str) -> dict[str, int]:
    faults = codes[1::2]
    return {"blank": faults.count("b"), "duplicate": faults.count("D") + faults.count("T"), "truncated": faults.count("t"),
            "illegal": illegal(codes)}


TURNS = T.ArrayType(fields(role=STRING, text=STRING))
COUNTS = ("blank", "duplicate", "truncated", "illegal")
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def dealt(rows: DataFrame) -> DataFrame:
    """Turns and markers of the first turn of each kind, dealt by ranges and sorted; ``part`` is the range's number."""
    own = rows.select("conv_id", "turn", "role", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"))
    kind = ["conv_id", "role", "sha"]
    first = own.groupBy(*kind).agg(F.min(F.struct("turn")).alias("t")).select(
        "conv_id", F.col("t.turn").alias("turn"), "role", F.lit(None).cast("string").alias("text"), "sha", F.lit(-1.0).alias("salt"))
    both = own.withColumn("salt", F.rand(12)).unionByName(first)  # equal turns may be dealt to several tasks
    keys = ["conv_id", "turn", "role", "sha", "salt"]
    return both.repartitionByRange(width(rows.sparkSession), *keys).sortWithinPartitions(*keys).select(
        "conv_id", "role", "text", F.spark_partition_id().alias("part"))


def cut(rows: DataFrame, size: int, volume: int) -> DataFrame:
    """Pieces: the repaired turns of conversations within a range (``idx`` null); as they are, the turns of those that may
    go on (``idx`` counts these in a range, ``last`` ends it); and a row for each range (``idx`` -1) that tells whether a
    marker ends it (``pending``) and whether it has turns (``last``)."""
    made = fields(part=INT, idx=LONG, last=BOOL, pending=BOOL, codes=STRING, audit=STRING, cost=LONG, **{c: LONG for c in COUNTS})
    schema = T.StructType([rows.schema["conv_id"], *made.fields, T.StructField("turns", TURNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, out, held = None, [], 0
        turns, codes, chars = [], [], 0
        part, conv, idx = None, None, 0
        whole, pending = False, False  # the range's first conversation may have begun in an earlier one

        def close(ends: bool, last: bool = False) -> None:
            nonlocal turns, codes, chars, idx, held
            text = "".join(codes)
            row = {"conv_id": conv, "part": part, "codes": text, "last": last, "turns": turns}
            if ends and whole:
                audit, _, cost = trace(text, backward(text, END), 0, True)
                row |= {"audit": audit, "cost": cost, **kinds(text), "turns": applied(turns, text, audit, 0)}
            else:
                row["idx"], idx = idx, idx + 1
            out.append(row)
            held += chars
            turns, codes, chars = [], [], 0

        for batch in batches:
            kind = kind or pa.schema([batch.schema.field("conv_id"), ("part", pa.int32()), ("idx", pa.int64()), ("last", pa.bool_()),
                                      ("pending", pa.bool_()), ("codes", pa.string()), ("audit", pa.string()), ("cost", pa.int64()),
                                      *[(c, pa.int64()) for c in COUNTS], ("turns", _TURNS)])
            for c, role, text, p in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "part")]):
                if part is not None and c != conv:
                    if turns:
                        close(ends=True)
                    whole = True
                conv, part = c, p
                if text is None:
                    pending = True
                    continue
                if len(turns) >= size or chars >= volume:
                    whole = False
                    close(ends=False)
                codes.append(code_of(role, text, first=pending))
                turns.append({"role": role, "text": text})
                chars, pending = chars + len(text), False
                if held >= volume or len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema=kind)
                    out, held = [], 0
        if part is not None:
            if turns:
                close(ends=False, last=True)
            out.append({"conv_id": None, "part": part, "idx": -1, "pending": pending, "last": idx > 0})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return rows.mapInArrow(run, schema)


def chained(pieces: DataFrame) -> DataFrame:
    """The pieces of conversations that may go on, with ``id`` (in order), ``codes`` (their first turn no repeat where a
    marker ends the range before), ``prev_id`` and ``next_id`` within the conversation, ``illegal`` with the first turn's."""
    spark = pieces.sparkSession
    # one row per range reaches the driver
    ranges = sorted(tuple(r) for r in pieces.where("idx = -1").select("part", "pending", "last").collect())
    filled = [p for p, _, some in ranges if some]
    after = dict(zip(filled, filled[1:]))
    before = {p: pending for (_, pending, _), (p, _, _) in zip(ranges, ranges[1:])}
    known = spark.createDataFrame([(p, after.get(p), before.get(p, False)) for p in filled], "part int, after int, marked boolean")
    start = lambda part: F.shiftleft(part.cast("long"), 33)
    codes = F.when(F.col("marked") & (F.col("idx") == 0),
                   F.concat(F.expr("translate(left(codes, 2), 'TD', 't.')"), F.expr("substring(codes, 3)"))).otherwise(F.col("codes"))
    own = pieces.where("idx >= 0").join(F.broadcast(known), "part").select(
        "conv_id", (start(F.col("part")) + F.col("idx")).alias("id"), codes.alias("codes"),
        F.when(F.col("last"), start(F.col("after"))).otherwise(start(F.col("part")) + F.col("idx") + 1).alias("at"))
    # neighbours are the same conversation's if the id there is its own
    there = own.select(F.col("conv_id").alias("c"), F.col("at").alias("there"), F.col("id").alias("prev_id"),
                       F.expr("substring(codes, -2, 1)").alias("initial"))
    both = own.join(there, (own["id"] == there["there"]) & own["conv_id"].eqNullSafe(there["c"]), "left").drop("c", "there")
    here = own.select(F.col("conv_id").alias("c"), F.col("id").alias("next_id"))
    return both.join(here, (both["at"] == here["next_id"]) & both["conv_id"].eqNullSafe(here["c"]), "left").select(
        "conv_id", "id", "prev_id", "next_id", "codes",
        F.coalesce(~F.concat("initial", F.expr("left(codes, 1)")).isin("su", "ua", "au"), F.lit(False)).cast("long").alias("illegal"))


def _mapped(df: DataFrame, function, *kept: str, **made: T.DataType) -> DataFrame:
    """``df``'s kept columns and the values that ``function`` makes of each row (a dict), in Arrow batches."""
    schema = T.StructType([df.schema[k] for k in kept] + fields(**made).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [function(r) for r in batch.to_pylist()]
            out = [pa.array([r[k] for r in rows], _TURNS if k == "turns" else pa.int64() if t == LONG else pa.string())
                   for k, t in made.items()]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + out, names=[*kept, *made])

    return df.mapInArrow(run, schema)


def stitched(chain: DataFrame) -> DataFrame:
    """``id``, ``prev_id`` and ``vectors`` of the chained pieces: those of speculative ends, then fix-up passes until each
    piece's end equals the next one's front but for a constant."""
    keep = ("id", "prev_id", "next_id", "codes")
    state = materialise(_mapped(chain, lambda r: {"vectors": backward(r["codes"], END), "changed": 1}, *keep,
                                vectors=STRING, changed=LONG), "speculated")

    def fixed(r: dict) -> dict:
        if r["end"] is None or r["end"] == r["vectors"][-4:]:
            return {"vectors": r["vectors"], "changed": 0}
        return {"vectors": backward(r["codes"], r["end"], known=r["vectors"]), "changed": 1}

    while not state.where("changed = 1").isEmpty():
        fronts = state.select(F.col("prev_id").alias("to"), F.expr("left(vectors, 4)").alias("end")).where("to is not null")
        joined = state.drop("changed").join(fronts, F.col("id") == F.col("to"), "left").drop("to")
        state = materialise(_mapped(joined, fixed, *keep, vectors=STRING, changed=LONG), "stitched")
    return state.drop("changed")


def entered(traces: DataFrame) -> DataFrame:
    """``id`` and ``entry``, the state in which each piece is entered. ``exits`` maps a piece's entry state to its exit
    state, as four digits; a map stands for ever more pieces until it is constant or reaches the first piece."""
    there = traces.select(F.col("id").alias("ref"), F.col("prev_id").alias("far"), F.col("exits").alias("map"))
    first = traces.select("id", "prev_id").join(there, F.col("prev_id") == F.col("ref"), "left")
    constant = F.expr("map = repeat(left(map, 1), 4)")

    def settled(df: DataFrame, entry: Column) -> DataFrame:
        return df.select("id", "ref", "map", F.coalesce(entry, F.when(constant, F.expr("left(map, 1)"))).alias("entry"))

    head = F.when(F.col("prev_id").isNull(), "0").when(F.col("far").isNull(), F.expr("left(map, 1)"))
    state = materialise(settled(first, head), "entries")
    while not state.where("entry is null").isEmpty():
        other = state.select(F.col("id").alias("_id"), F.col("ref").alias("_ref"), F.col("map").alias("_map"), F.col("entry").alias("_entry"))
        joined = state.join(other, F.col("ref") == F.col("_id"), "left").select(
            "id", "entry", F.expr("translate(_entry, '0123', map)").alias("found"),
            F.when(F.col("entry").isNull(), F.col("_ref")).otherwise(F.col("ref")).alias("ref"),
            F.when(F.col("entry").isNull(), F.expr("translate(_map, '0123', map)")).otherwise(F.col("map")).alias("map"))
        state = materialise(settled(joined, F.coalesce("entry", "found")), "entries")
    return state.select("id", "entry")


def repair(rows: DataFrame, size: int = ROWS, volume: int = BYTES) -> DataFrame:
    """Repairs ``conv_id``, ``turn``, ``role``, ``text``: ``turns`` (array of role and text), ``audit``, ``cost`` and the
    numbers of turns with each first fault and of illegal neighbours. A conversation has one row (``piece`` null), or
    several in order of ``piece`` if it lies in several tasks or is longer than ``size`` turns or ``volume`` characters."""
    own = pick(rows, "conv_id", "turn", "role", "text")
    for c in ("role", "text"):
        own = own.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    pieces = materialise(cut(dealt(own), size, volume), "pieces")
    chain = materialise(chained(pieces), "chain")

    def traced(r: dict) -> dict:
        tries = [trace(r["codes"], r["vectors"], x, r["next_id"] is None) for x in ((0,) if r["prev_id"] is None else range(4))]
        return {"exits": "".join(str(x) for _, x, _ in tries), "audits": " ".join(a for a, _, _ in tries),
                "costs": " ".join(str(c) for _, _, c in tries)}

    traces = materialise(_mapped(stitched(chain), traced, "id", "prev_id", exits=STRING, audits=STRING, costs=STRING), "traces")
    solved = chain.join(traces.drop("prev_id"), "id").join(entered(traces), "id")
    ids = F.shiftleft(F.col("part").cast("long"), 33) + F.col("idx")
    open_ = pieces.where("idx >= 0").select(ids.alias("id"), "turns").join(solved, "id")

    def done(r: dict) -> dict:
        x = int(r["entry"])
        audit, cost = r["audits"].split(" ")[x], int(r["costs"].split(" ")[x])
        found = kinds(r["codes"])
        return {"audit": audit, "cost": cost, **found, "illegal": found["illegal"] + r["illegal"],
                "turns": applied(r["turns"], r["codes"], audit, x)}

    counts = {c: LONG for c in COUNTS}
    named = open_.withColumn("piece", F.when(F.col("prev_id").isNotNull() | F.col("next_id").isNotNull(), F.col("id")))
    opened = _mapped(named, done, "conv_id", "piece", audit=STRING, cost=LONG, **counts, turns=TURNS)
    closed = pieces.where("idx is null").select("conv_id", F.lit(None).cast("long").alias("piece"), "audit", "cost", *COUNTS, "turns")
    return closed.unionByName(opened)


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """One row per repaired turn, in order of ``piece`` and ``place`` within a conversation."""
    return repaired.select("conv_id", "piece", F.posexplode("turns").alias("place", "t")).select("conv_id", "piece", "place", "t.role", "t.text")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated or given to the user by the crc32 of ``conv_id:turn``."""
    c = pick(conversations, "conv_id", "turn", "role", "text")
    string = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.concat(string("conv_id"), F.lit(":"), string("turn")).cast("binary")), F.lit(20))
    c = c.select("conv_id", "turn", string("role").alias("role"), string("text").alias("text"), h.alias("h")).where("h > 0")
    return c.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and the SHA-256 of its repaired ``role:text`` lines. A conversation in
    several pieces is read in order, as a stream: a hash of one text cannot be taken in parts."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    made = repaired.select("conv_id", "piece", "audit", "cost", *COUNTS, F.size("turns").alias("n"), F.array_join(lines, "\n").alias("body"))
    whole = made.where("piece is null").select("conv_id", "audit", "cost", *COUNTS, F.sha2(F.col("body").cast("binary"), 256).alias("repaired_sha256"))
    schema = whole.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, row, audits, sha = None, None, [], None

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row | {"audit": "".join(audits), "repaired_sha256": sha.hexdigest()}], schema=kind)

        for batch in batches:
            kind = kind or pa.schema([batch.schema.field("conv_id"), ("audit", pa.string()), ("cost", pa.int64()),
                                      *[(c, pa.int64()) for c in COUNTS], ("repaired_sha256", pa.string())])
            for r in batch.to_pylist():
                if row is None or r["conv_id"] != row["conv_id"]:
                    if row is not None:
                        yield ready()
                    row, audits, sha, some = {"conv_id": r["conv_id"], "cost": 0, **{c: 0 for c in COUNTS}}, [], hashlib.sha256(), False
                for c in ("cost", *COUNTS):
                    row[c] += r[c]
                audits.append(r["audit"])
                if r["n"]:
                    sha.update((("\n" if some else "") + r["body"]).encode())
                    some = True
        if row is not None:
            yield ready()

    parts = made.where("piece is not null").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return whole.unionByName(parts.mapInArrow(run, schema))


def digest(conversations: DataFrame) -> DataFrame:
    """Damage and repair as the registered query returns them."""
    rows = damaged(conversations)
    gaps = rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    found = summary(repair(rows))
    ids = pick(conversations, "conv_id").distinct()
    for other in (gaps, found):
        there = other.withColumnRenamed("conv_id", "c")
        ids = ids.join(there, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    zero = {c: 0 for c in ("gaps", *COUNTS, "cost")} | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return ids.fillna(zero).select("conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256")
