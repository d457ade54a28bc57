"""Repair of conversations at least cost, by a dynamic program over a grammar of role and fault sequences.

Every row is a symbol, its role's initial and its fault. Conversations are cut into pieces of a bounded number of
rows, and equal pieces are worked out once. Re-Pair replaces the pairs of neighbouring symbols that the distinct
pieces hold most often by rules, in rounds of Spark jobs. The edits of a symbol are a min-plus transfer matrix
over the four states of the wanted role grammar `(s?(ua)+)?`, each entry with its cheapest audit string; a rule's
matrix is the product of its two symbols' matrices with ropes for audits, a piece's is the product of what is left
of it, and a conversation multiplies its pieces' matrices into one row vector, streamed in order.
"""

from __future__ import annotations

import hashlib
import itertools
import os.path
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
# Rows of a piece; conversations may be cut anywhere.
PIECE = 256
# What the grammar may grow to: bounds what the driver holds and every task is sent.
ROUNDS, RULES_A_ROUND, LEAST_USES = 8, 32, 8

INITIALS, FAULTS = "sua?", ("", "blank", "duplicate", "truncated")
SYMBOLS = "abcdefghijklmnop"
_FIRST_RULE = 0xE000
# States of the role grammar: nothing yet, behind the system row, behind a user row, behind an assistant row.
STATES = range(4)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ENDS = (0, 3)
# No state's cheapest way on is dearer than another's by more than this: what lags further behind can't win.
SPREAD = 12

Entry = tuple[int, "Rope"] | None
Matrix = list[list[Entry]]


class Rope:
    """A string as two ropes or as letters; letters are only put together where somebody asks."""

    __slots__ = ("parts", "text")

    def __init__(self, text: str | None = None, parts: tuple[Rope, Rope] | None = None):
        self.text, self.parts = text, parts

    def __add__(self, other: Rope) -> Rope:
        return Rope(parts=(self, other))

    def __str__(self) -> str:
        if self.text is None:
            self.text, self.parts = str(self.parts[0]) + str(self.parts[1]), None
        return self.text

    def __lt__(self, other: Rope) -> bool:
        return str(self) < str(other)


def better(a: Entry, b: Entry) -> Entry:
    """The cheaper one, at equal cost the one whose audit is less in ASCII order."""
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return min(a, b, key=lambda e: e[0])
    return b if b[1] < a[1] else a


def times(left: Matrix, right: Matrix) -> Matrix:
    """The min-plus product. Audits of equal cost over the same rows never begin with one another, so the lesser stays the lesser whatever follows."""
    out: Matrix = [[None] * 4 for _ in STATES]
    for i, via, j in itertools.product(STATES, STATES, STATES):
        a, b = left[i][via], right[via][j]
        if a is not None and b is not None and (out[i][j] is None or a[0] + b[0] <= out[i][j][0]):
            out[i][j] = better(out[i][j], (a[0] + b[0], a[1] + b[1]))
    return out


def inserts() -> Matrix:
    """Any number of inserted rows, none included; more than two in a row never pay."""
    none: Matrix = [[(0, Rope("")) if i == j else None for j in STATES] for i in STATES]
    one: Matrix = [[None] * 4 for _ in STATES]
    for (i, initial), j in NEXT.items():
        if initial in "ua":
            one[i][j] = (COST[INSERT], Rope(INSERT))
    step: Matrix = [[better(none[i][j], one[i][j]) for j in STATES] for i in STATES]
    return times(step, step)


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before a row, then its edit."""
    at = SYMBOLS.index(symbol)
    initial, fault = INITIALS[at // 4], FAULTS[at % 4]
    edit: Matrix = [[(COST[DELETE], Rope(DELETE)) if i == j else None for j in STATES] for i in STATES]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED_COST if fault == "truncated" else 0
        for (i, wanted), j in NEXT.items():
            if wanted == initial:
                edit[i][j] = better(edit[i][j], (COST[KEEP] + more, Rope(KEEP)))
            if wanted in "ua":
                edit[i][j] = better(edit[i][j], (COST[REROLE] + more, Rope(REROLE)))
    return times(inserts(), edit)


def rule_matrices(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """Matrices of all symbols and, bottom up, of the rules over them."""
    found = {s: symbol_matrix(s) for s in SYMBOLS}
    for n, (left, right) in enumerate(rules):
        found[chr(_FIRST_RULE + n)] = times(found[left], found[right])
    return found


def compress(sequence: str, rules: list[tuple[str, str]]) -> str:
    for n, (left, right) in enumerate(rules):
        sequence = sequence.replace(left + right, chr(_FIRST_RULE + n))
    return sequence


def learn_grammar(sequences: DataFrame, rounds: int = ROUNDS, a_round: int = RULES_A_ROUND, least: int = LEAST_USES) -> list[tuple[str, str]]:
    """Re-Pair over all rows of `sequence`: per round the most frequent pairs that share no symbol become rules.

    Each task adds up its own pairs; their number is bounded by the square of the symbols and rules.
    """
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        now = list(rules)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: Counter[str] = Counter()
            for batch in batches:
                for sequence in batch.column(0).to_pylist():
                    short, before = compress(sequence, now), None
                    for at in range(len(short) - 1):
                        pair = short[at : at + 2]
                        # Of a chain of one symbol every other pair counts.
                        before = None if pair == before and pair[0] == pair[1] else pair
                        if before:
                            total[pair] += 1
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys()), pa.array(total.values(), pa.int64())], ["pair", "n"])

        best = (
            sequences.select("sequence").mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least).orderBy(F.desc("n"), "pair").limit(4 * a_round).collect()
        )
        used: set[str] = set()
        for row in best:
            if not used & set(row["pair"]) and len(rules) < len(now) + a_round:
                used |= set(row["pair"])
                rules.append((row["pair"][0], row["pair"][1]))
        if len(rules) == len(now):
            break
    return rules


def _string(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))


BLANKS = " \t\n\x0b\f\r"


def place_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and `place`, a number that rises with (conv_id, turn, role, text), nulls first.

    Written to the shared folder. The rows are cut into ranges, equal ones too, so a conversation of any size is
    spread over tasks.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role").asc(), F.col("text").asc(), F.col("salt").asc()]
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), _string(role).alias("role"), _string(text).alias("text"),
        F.monotonically_increasing_id().alias("salt"),
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(ordered.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place")), "turns")


def cut_pieces(placed: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, piece, sequence (a symbol per row), n_turns (distinct), first_turn, last_turn."""
    first = placed.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    text = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1))
    rows = placed.select(
        "conv_id", "turn", "place",
        F.when((initial == 0) | (F.length("role") == 0), 3).otherwise(initial - 1).alias("initial"),
        (F.length(text) == 0).alias("blank"),
        (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("truncated"),
    ).join(first, "place", "left")
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("truncated"), 3).otherwise(0)
    symbol = F.substring(F.lit(SYMBOLS), (F.col("initial") * 4 + fault + 1).cast("int"), F.lit(1))
    ordered = F.sort_array(F.collect_list(F.struct("place", symbol.alias("symbol"))))
    return rows.groupBy("conv_id", F.expr(f"place div {piece}").alias("piece")).agg(
        F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("sequence"),
        F.size(F.collect_set("turn")).cast("long").alias("n_turns"),
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
    )


WORKED = "sequence string, cost array<long>, audit array<string>, blank long, duplicate long, truncated long, illegal long"


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def work_out(sequences: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The transfer matrix (row by row) and the counts of every distinct sequence."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = rule_matrices(rules)
        schema = pa.schema(
            [("sequence", pa.string()), ("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string())), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal"))]
        )
        for batch in batches:
            rows = []
            for sequence in batch.column(0).to_pylist():
                whole = reduce(times, (matrices[s] for s in compress(sequence, rules)))
                flat = [e for line in whole for e in line]
                faults = Counter(SYMBOLS.index(s) % 4 for s in sequence)
                rows.append(
                    (sequence, [e and e[0] for e in flat], [e and str(e[1]) for e in flat], faults[1], faults[2], faults[3],
                     _illegal("".join(INITIALS[SYMBOLS.index(s) // 4] for s in sequence)))
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return sequences.select("sequence").mapInArrow(work, WORKED)


def _state_behind(state: int, letter: str, initial: str) -> int:
    if letter == DELETE:
        return state
    return NEXT[state, initial if letter == KEEP else "a" if state == 2 else "u"]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _emit(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of about `most` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str)) + 64
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _combine(rows: Iterator[dict]) -> Iterator[tuple]:
    """Per conversation one summary row (piece null), then a row per piece with its part of the audit and the state before it."""
    ending = inserts()
    for conv, pieces in itertools.groupby(rows, key=lambda r: r["conv_id"]):
        vector, fixed = {0: (0, "")}, []
        total, cut, turns = Counter(), [], None
        low = high = before = None
        for p in pieces:
            reached: dict[int, tuple[int, str]] = {}
            for i, (cost, audit) in vector.items():
                for j in STATES:
                    more = p["cost"][4 * i + j]
                    if more is not None and (j not in reached or cost + more <= reached[j][0]):
                        found = (cost + more, audit + p["audit"][4 * i + j])
                        reached[j] = min(reached.get(j, found), found)
            least = min(cost for cost, _ in reached.values())
            vector = {j: e for j, e in reached.items() if e[0] <= least + SPREAD}
            # What all ways that are left have in common is settled.
            common = os.path.commonprefix([audit for _, audit in vector.values()])
            fixed.append(common)
            vector = {j: (cost, audit[len(common) :]) for j, (cost, audit) in vector.items()}
            total.update({c: p[c] for c in ("blank", "duplicate", "truncated", "illegal", "n_turns")})
            initials = [INITIALS[SYMBOLS.index(p["sequence"][at]) // 4] for at in (0, -1)]
            if before:
                total["illegal"] += _illegal(before + initials[0])
            if high is not None and p["first_turn"] == high:
                total["n_turns"] -= 1
            before, low = initials[1], p["first_turn"] if low is None else low
            high = p["last_turn"] if p["last_turn"] is not None else high
            cut.append((p["piece"], p["sequence"]))
        best = min((cost + ending[i][j][0], audit + str(ending[i][j][1])) for i, (cost, audit) in vector.items() for j in ENDS if ending[i][j])
        audit = "".join(fixed) + best[1]
        gaps = 0 if low is None else high - low + 1 - total["n_turns"]
        yield (conv, None, gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], best[0], audit, None)
        at = state = 0
        for n, (piece, sequence) in enumerate(cut):
            start, before, left = at, state, iter(sequence)
            todo = len(sequence)
            while at < len(audit) and (todo or n == len(cut) - 1):
                letter = audit[at]
                initial = ""
                if letter != INSERT:
                    initial, todo = INITIALS[SYMBOLS.index(next(left)) // 4], todo - 1
                state = _state_behind(state, letter, initial)
                at += 1
            yield (conv, piece, None, None, None, None, None, None, audit[start:at], before)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def plan_repairs(placed: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, piece, the counts, cost, audit and state: a summary row per conversation (piece null) and one per piece."""
    pieces = settle(cut_pieces(placed, piece), "pieces")
    distinct = settle(pieces.select("sequence").distinct(), "sequences")
    worked = work_out(distinct, learn_grammar(distinct))
    id_type = placed.schema["conv_id"].dataType
    names = ["conv_id", "piece", *COUNTS, "audit", "state"]
    types = [id_type, *[T.LongType()] * 7, T.StringType(), T.LongType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    arrow_types = pa.schema([(n, pa.string() if n == "audit" else pa.int64()) for n in names[1:]])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            full = pa.schema([("conv_id", first.schema.field("conv_id").type), *arrow_types])
            yield from _emit(_combine(_stream(itertools.chain([first], batches))), full)

    # Summaries of pieces in order, row by row: the state is a vector of four, whatever the conversation's size.
    joined = pieces.join(worked, "sequence").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return settle(joined.mapInArrow(combine, schema), "repairs")


def _edited(rows: Iterator[dict]) -> Iterator[tuple]:
    """(conv_id, piece, nth, edit, role, text) of every row that the audits leave or insert; a piece's audit comes before its rows."""
    for (conv, piece), members in itertools.groupby(rows, key=lambda r: (r["conv_id"], r["piece"])):
        plan = next(members)
        state, nth = plan["state"], 0
        for letter in plan["text"]:
            if letter == INSERT:
                role, text, initial = ("assistant" if state == 2 else "user"), "", ""
            else:
                row = next(members)
                role, text, initial = row["role"], row["text"], row["role"][:1]
                if letter == REROLE:
                    role = "assistant" if state == 2 else "user"
            if letter != DELETE:
                yield (conv, piece, nth, letter, role, text)
                nth += 1
            state = _state_behind(state, letter, initial)


def _with_plans(placed: DataFrame, plans: DataFrame, piece: int) -> DataFrame:
    audits = plans.where("piece is not null").select(
        "conv_id", "piece", F.lit(-1).cast("long").alias("place"), "state", F.lit(None).cast("string").alias("role"), F.col("audit").alias("text")
    )
    rows = placed.select("conv_id", F.expr(f"place div {piece}").alias("piece"), "place", F.lit(None).cast("long").alias("state"), "role", "text")
    return audits.unionByName(rows)


def repaired_turns(placed: DataFrame, plans: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, piece, nth, edit, role, text: the repaired conversations, ordered by (piece, nth) within each."""
    fields = [("piece", pa.int64()), ("nth", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    schema = T.StructType(
        [placed.schema["conv_id"], *(T.StructField(n, T.LongType() if t == pa.int64() else T.StringType()) for n, t in fields)]
    )

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            full = pa.schema([("conv_id", first.schema.field("conv_id").type), *fields])
            yield from _emit(_edited(_stream(itertools.chain([first], batches))), full)

    return _with_plans(placed, plans, piece).repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place").mapInArrow(edit, schema)


def repaired_digests(placed: DataFrame, plans: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, repaired_sha256 of `role:text` joined by newlines. One digest is one stream of bytes: a conversation's
    rows pass through one task in order, in constant memory."""
    schema = T.StructType([placed.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def hashed(rows: Iterator[dict]) -> Iterator[tuple]:
        for conv, turns in itertools.groupby(_edited(rows), key=lambda r: r[0]):
            digest = hashlib.sha256()
            for n, turn in enumerate(turns):
                digest.update(f"{chr(10) if n else ''}{turn[4]}:{turn[5]}".encode())
            yield (conv, digest.hexdigest())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            full = pa.schema([("conv_id", first.schema.field("conv_id").type), ("repaired_sha256", pa.string())])
            yield from _emit(hashed(_stream(itertools.chain([first], batches))), full)

    return _with_plans(placed, plans, piece).repartition("conv_id").sortWithinPartitions("conv_id", "piece", "place").mapInArrow(work, schema)


def repair_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summaries, repaired turns, digests).

    Summaries: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, for every conversation that has a
    row. Rows come by turn (whole numbers, nulls first), ties by role and text; equal rows all count, all but the
    first as duplicates. Null role or text is one space. Null conv_id is a conversation. Audits may be as long as
    the conversation; nothing else of a conversation is held in one place. An empty table gives no rows. Other
    columns are ignored.
    """
    placed = place_turns(turns, conv_id, turn, role, text)
    plans = plan_repairs(placed, piece)
    summaries = plans.where("piece is null").select("conv_id", *COUNTS, "audit")
    return summaries, repaired_turns(placed, plans, piece), repaired_digests(placed, plans, piece)


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, told by the checksum of `conv_id:turn` (nulls: one space)."""
    kind = F.crc32(F.concat(_string("conv_id"), F.lit(":"), _string("turn"))) % 20
    role, text = _string("role"), _string("text")
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    hit = turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return hit.drop("copy")


def repair_digest(turns: DataFrame) -> DataFrame:
    """A row per conversation of `turns`, repaired after damage; where no row is left: zeros, no audit, no text."""
    summaries, _, digests = repair_conversations(damage(turns))
    every = turns.groupBy("conv_id").agg(F.lit(1).alias("_one"))
    same = lambda right: every["conv_id"].eqNullSafe(right["conv_id"])
    return every.join(summaries, same(summaries), "left").join(digests, same(digests), "left").select(
        every["conv_id"],
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
