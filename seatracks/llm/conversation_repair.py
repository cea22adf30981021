"""Cheapest repair of conversations' structure, by a checkpointed dynamic program over blocks of turns.

A valid conversation is empty, or an optional system turn and then pairs of user and assistant. Where a walk from the
first turn may go is told by a vector for each turn: the least cost of the rest from each state (nothing yet, after
system, user, assistant). Those vectors come from the last turn backwards, and only those at checkpoints are stored:
every B turns, with B about the square root of the longest conversation. Blocks are summed up side by side, a
conversation's checkpoints come from its blocks' sums, and each block recomputes its own vectors from the checkpoint at its
end while it walks forward along edits that cost no more than need be, at each point the one whose letter is least. No
task holds more of a conversation than a block, or one number a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BLANK, STOPS, LEAST_BLOCK = " \t\n\x0b\f\r", ".!?", 64
#: Costs of edits; a truncated turn that stays costs MEND besides.
REROLE, DELETE, INSERT, MEND = 3, 4, 3, 3
FAR = 1 << 30
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. Where a role's initial leads, and what an
#: inserted or changed turn must be.
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
TURN = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
#: Cost of what is missing at the end, by state.
LAST = (0, 2 * INSERT, INSERT, 0)
LEGAL = ("su", "ua", "au")

Vector = tuple[int, ...]


def _edits(symbol: str, v: Vector, s: int) -> list[tuple[str, int, int]]:
    """Letter, cost to the end and next state of the edits of a turn in state ``s``. A symbol is the fault (0 none, 1
    truncated, 2 blank or duplicate) and the role's initial."""
    out = [("D", DELETE + v[s], s)]
    if symbol[0] != "2":
        mend = MEND if symbol[0] == "1" else 0
        if (to := KEEP.get((symbol[1:], s))) is not None:
            out.append(("K", mend + v[to], to))
        out.append(("R", REROLE + mend + v[TURN[s][1]], TURN[s][1]))
    return out


@cache  # as many as there are symbols and vectors, which are small numbers once the least is taken off
def before(symbol: str, v: Vector) -> tuple[int, Vector]:
    """The vector before a turn, from the one behind it; the least of it apart."""
    own = [min(c for _, c, _ in _edits(symbol, v, s)) for s in range(4)]
    full = [min(own[s], INSERT + own[TURN[s][1]], 2 * INSERT + own[TURN[TURN[s][1]][1]]) for s in range(4)]
    least = min(full)
    return least, tuple(min(c - least, FAR) for c in full)


@cache
def taken(symbol: str, v: Vector, s: int) -> tuple[str, int]:
    """The letters and the next state for a turn in state ``s``: of all edits that lose nothing, always the least letter."""
    letters = ""
    while True:
        edits = _edits(symbol, v, s)
        least, full = before(symbol, v)
        best = least + full[s]
        tight = [(letter, to) for letter, cost, to in edits if cost == best]
        if INSERT + least + full[TURN[s][1]] == best:
            tight.append(("I", TURN[s][1]))
        letter, to = min(tight)
        letters += letter
        if letter != "I":
            return letters, to
        s = to


def summed(symbols: list[str]) -> list[int]:
    """A block's costs from each state (row) to each state (column), row by row."""
    columns = []
    for end in range(4):
        total, v = 0, tuple(0 if s == end else FAR for s in range(4))
        for symbol in reversed(symbols):
            least, v = before(symbol, v)
            total += least
        columns.append([min(total + c, FAR) for c in v])
    return [columns[e][s] for s in range(4) for e in range(4)]


def checkpoints(sums: list[list[int]]) -> list[list[int]]:
    """The vector at the end of each block, and at last that of the first one's start."""
    v, out = list(LAST), []
    for m in reversed(sums):
        out.append(v)
        v = [min(m[4 * s + e] + v[e] for e in range(4)) for s in range(4)]
    return [*out[::-1], v]


def walked(symbols: list[str], end: list[int]) -> list[str]:
    """A block's audit from each start state, with the state it ends in before it."""
    least = min(end)
    v, vectors = tuple(min(c - least, FAR) for c in end), []
    for symbol in reversed(symbols):
        vectors.append(v)
        v = before(symbol, v)[1]
    out = []
    for start in range(4):
        s, letters = start, []
        for symbol, after in zip(symbols, reversed(vectors), strict=True):
            some, s = taken(symbol, after, s)
            letters.append(some)
        out.append(f"{s}{''.join(letters)}")
    return out


def chosen(ends: list[list[int]]) -> list[int]:
    """The state that each block starts in, and at last that of the conversation's end."""
    out = [0]
    for e in ends:
        out.append(int(e[out[-1]]))
    return out


def _by(run: Callable, returns: str, *columns: Column) -> Column:
    """A column by one of the functions above, for each block or conversation; its arrays come as lists."""
    return F.udf(lambda *x: run(*[y if isinstance(y, list) else y.tolist() for y in x]), returns, useArrow=True)(*columns)


def _ordered(rows: DataFrame, key: Column, home: str) -> DataFrame:
    """The turns with ``_c`` (the conversation) and ``_at``, which grows with their order over all conversations.

    A range exchange deals out the order itself, so a conversation of any length is spread over tasks. Turns of one
    number stand in order of role and digest of the text.
    """
    rows = rows.withColumn("_key", key)
    order = ("_c", "turn", "role", "_key")
    ranged = rows.repartitionByRange(common.buckets(rows.sparkSession), *order).sortWithinPartitions(*order)
    return common.written(ranged.withColumn("_at", F.monotonically_increasing_id()), f"{home}/turns")


def repaired(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation.

    Turns stand in order of ``turn``, null first; of one number, by role and digest of the text, so repeats are neighbours.
    A null role or text is one space; a null conv_id is a conversation of its own. A turn's role counts by its first
    letter; a kept one keeps its role and text. Other columns are ignored, whatever their names; an empty table gives
    no rows.
    """
    home = common.shared_dir(turns.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(_conversation().alias("_c"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    said = F.rtrim("text", F.lit(BLANK))
    rows = rows.withColumn("_fault", F.when(said == "", 2).when(F.translate(F.right(said, F.lit(1)), STOPS, "") != "", 1).otherwise(0))
    rows = _ordered(rows, F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), home)
    # a turn is seen first at the least place of its conversation, role and text
    firsts = rows.groupBy("_c", "_key").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("_first"))
    slim = rows.select("_c", "_at", "_fault", F.substring("role", 1, 1).alias("_i")).join(firsts, "_at", "left")
    again = F.col("_first").isNull() & (F.col("_fault") != 2)
    blank = F.col("_fault") == 2
    slim = slim.select("_c", "_at", F.struct("_at", "_i", F.concat(F.when(again, "2").otherwise(F.col("_fault").cast("string")), "_i").alias("x"), blank.alias("b"), again.alias("d")).alias("_t"))
    counts = rows.groupBy("_c").agg(F.count(F.lit(1)).alias("n"), F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("turns"))
    counts = common.written(counts, f"{home}/counts")
    longest = counts.agg(F.max("n")).first()[0] or 0
    block = max(LEAST_BLOCK, 1 << ((longest.bit_length() + 1) // 2))  # a power of two: no block crosses a partition's end
    blocks = slim.groupBy("_c", F.expr(f"_at div {block}").alias("_b")).agg(F.sort_array(F.collect_list("_t")).alias("_t"))
    count = lambda c: F.size(F.filter("_t", c)).cast("long")
    pairs = F.transform(F.slice("_t._i", 2, F.greatest(F.size("_t") - 1, F.lit(0))), lambda x, i: F.concat(F.get(F.col("_t._i"), i), x))
    blocks = blocks.select(
        "_c", "_b", F.col("_t._at").alias("_ats"), F.col("_t.x").alias("_x"), _by(summed, "array<long>", F.col("_t.x")).alias("m"),
        count(lambda t: t["b"]).alias("blank"), count(lambda t: t["d"]).alias("duplicate"), count(lambda t: ~t["b"] & ~t["d"] & t["x"].startswith("1")).alias("truncated"),
        F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL))).cast("long").alias("illegal"), F.get("_t._i", F.lit(0)).alias("i0"), F.element_at("_t._i", -1).alias("i1"),
    )
    blocks = common.written(blocks, f"{home}/blocks")
    # each conversation's sums: a few numbers for each block
    ones = blocks.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("_b", "m", "i0", "i1"))).alias("_s"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    across = F.transform(F.slice("_s.i0", 2, F.greatest(F.size("_s") - 1, F.lit(0))), lambda x, i: F.concat(F.get(F.col("_s.i1"), i), x))
    ones = ones.withColumn("illegal", F.col("illegal") + F.size(F.filter(across, lambda p: ~p.isin(*LEGAL)))).withColumn("_v", _by(checkpoints, "array<array<long>>", F.col("_s.m")))
    ones = common.written(ones.select("_c", F.col("_s._b").alias("_bs"), "_v", "blank", "duplicate", "truncated", "illegal"), f"{home}/checkpoints")
    each = ones.select("_c", F.explode(F.arrays_zip(F.col("_bs").alias("b"), F.slice("_v", F.lit(1), F.size("_bs")).alias("v"))).alias("_z")).select("_c", F.col("_z.b").alias("_b"), F.col("_z.v").alias("_end"))
    walks = common.written(blocks.select("_c", "_b", "_ats", "_x").join(each, ["_c", "_b"]).select("_c", "_b", "_ats", _by(walked, "array<string>", F.col("_x"), F.col("_end")).alias("_w")), f"{home}/walks")
    # which of its four walks each block takes
    ends = walks.select("_c", F.struct("_b", F.transform("_w", lambda w: F.substring(w, 1, 1).cast("int")).alias("e")).alias("_e"))
    starts = ends.groupBy("_c").agg(F.sort_array(F.collect_list("_e")).alias("_e")).select("_c", F.col("_e._b").alias("_bs"), _by(chosen, "array<int>", F.col("_e.e")).alias("_st"))
    starts = common.written(starts, f"{home}/starts")
    taken_ = starts.select("_c", F.explode(F.arrays_zip(F.col("_bs").alias("b"), F.slice("_st", F.lit(1), F.size("_bs")).alias("s"))).alias("_z")).select("_c", F.col("_z.b").alias("_b"), F.col("_z.s").alias("_start"))
    audits = common.written(walks.join(taken_, ["_c", "_b"]).select("_c", "_b", "_ats", F.expr("substring(get(_w, _start), 2)").alias("_a")), f"{home}/audits")
    closing = F.expr(f"repeat('I', cast(get(array({', '.join(map(str, LAST))}), element_at(_st, -1)) / {INSERT} as int))")
    audit = audits.groupBy("_c").agg(F.sort_array(F.collect_list(F.struct("_b", "_a"))).alias("_p")).join(starts, "_c").select("_c", F.concat(F.array_join("_p._a", ""), closing).alias("audit"))
    known = _conversations(turns)
    out = known.join(counts, "_c", "left").join(ones.drop("_bs"), "_c", "left").join(audit, "_c", "left").join(_hashed(rows, audits), "_c", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "conv_id", zero(F.col("hi") - F.col("lo") + 1 - F.col("turns")).alias("gaps"), *[zero(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        zero(F.get(F.element_at("_v", -1), F.lit(0))).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _conversation() -> Column:
    """A conversation's key, which is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _conversations(turns: DataFrame) -> DataFrame:
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), _conversation().alias("_c")).distinct()


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation's repaired turns: before a turn stands a row with its letters."""
    key, state, digest, first, letters = None, 0, None, True, ""

    def add(role: str, text: str) -> None:
        nonlocal first
        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        first = False

    def insert() -> None:
        nonlocal state
        role, state = TURN[state]
        add(role, "")

    def closed() -> tuple[str, str]:
        for _ in range(LAST[state] // INSERT):
            insert()
        return key, digest.hexdigest()

    def batch(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], ["_c", "_sha"])

    for part in batches:
        done = []
        for c, found, role, text in zip(*(part.column(n).to_pylist() for n in ("_c", "_a", "role", "text")), strict=True):
            if c != key:
                if key is not None:
                    done.append(closed())
                key, state, digest, first = c, 0, hashlib.sha256(), True
            if found is not None:
                letters = found
                continue
            for _ in letters[:-1]:
                insert()
            if letters[-1] == "K":
                state = KEEP[(role[:1], state)]
                add(role, text)
            elif letters[-1] == "R":
                role, state = TURN[state]
                add(role, text)
        yield batch(done)
    if key is not None:
        yield batch([closed()])


def _hashed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """_c and _sha, the digest of the repaired turns. A digest is one sequence, so a conversation is one task's, but as a
    stream of its sorted turns."""
    nothing = F.lit(None).cast("string")
    pieces = F.arrays_zip(F.col("_ats").alias("t"), F.regexp_extract_all("_a", F.lit("(I*[DKR])"), F.lit(1)).alias("a"))
    pieces = audits.select("_c", F.explode(pieces).alias("_z")).select("_c", F.col("_z.t").alias("_at"), F.lit(0).alias("_o"), F.col("_z.a").alias("_a"), nothing.alias("role"), nothing.alias("text"))
    both = pieces.unionByName(rows.select("_c", "_at", F.lit(1).alias("_o"), nothing.alias("_a"), "role", "text"))
    one = both.repartition(common.buckets(rows.sparkSession), "_c").sortWithinPartitions("_c", "_at", "_o")
    return one.select("_c", "_a", "role", "text").mapInArrow(_hash_stream, "_c string, _sha string")


def damaged(turns: DataFrame) -> DataFrame:
    """The turns after faults by the checksum of ``conv_id:turn`` modulo 20: 0 drops a turn, 1 empties its text, 2 removes
    its full stops, question and exclamation marks, 3 repeats it, 4 makes the user its role. Nulls are one space, in
    the checksum too."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_f")).where("_f <> 0")
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("_f") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_n"))
    return rows.drop("_n")


def damaged_and_repaired(turns: DataFrame) -> DataFrame:
    """``repaired`` over ``damaged`` turns, with a row for every conversation of the table: one that lost all its turns has
    zeros, an empty audit and the digest of no text."""
    out = repaired(damaged(turns))
    columns = [c for c in out.columns if c != "conv_id"]
    known = _conversations(turns)
    made = out.withColumn("_c", _conversation()).drop("conv_id")
    empty = {c: F.lit(0).cast("long") for c in columns} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return known.join(made, "_c", "left").select("conv_id", *[F.coalesce(F.col(c), empty[c]).alias(c) for c in columns])
