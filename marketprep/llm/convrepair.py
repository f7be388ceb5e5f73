"""Conversation structure repair: the cheapest edits that make the turns of a
conversation an optional system turn and then user and assistant by turns.

The roles' initials must read ``(s?(ua)+)?``.  A row is kept (0), given the
role that is due (3) or deleted (4; blank and repeated rows must be), a turn
without text may be inserted anywhere (3), and a truncated row that stays costs
3 more.  The edits' initials in order are the audit; of the cheapest edits the
ASCII-least audit counts.

The whole choice is one integer minimum.  A way through the rest of a
conversation has one weight: its cost in the high digits, and below them the
audit letters from the left in digits of fixed width (D 1, I 2, K 3, R 4), zero
after the end.  An edit in front of it adds its cost, moves the letters one
place and puts its own into the first.  The nodes are (row, state of the
pattern), and each takes the least integer of its edges from the last row to
the first; comparing two integers is comparing cost, then audit.

Rows are reduced to one code each (initial and fault) before anything is
sorted, and dealt by ranges of (conversation, turn), so that a conversation
with a third of all rows lies in many tasks.  A task solves the conversations
that lie within it; of one that may go on in another task it hands over a
4 x 4 table of weights (state before, state after), and such tables are joined
in order.  Two ways with the same states at both ends and the same cost are
never the beginning of one another (they would differ by inserts that cost), so
the table loses nothing.  The texts travel once, to be joined with their audit;
SHA-256 runs over a conversation's turns in order and thus in one task, as a
stream that holds one batch of rows.

Defined cases: a null role or text is one space; a null conversation id is a
conversation; null turns come first and count in no gap; rows of one turn are
ordered by role, then by the SHA-256 of their text; a role's initial is its
first character as it is, and an empty role has none, so it can't be kept.  A
conversation without rows does not appear, an empty table gives no row, and
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ship, write_table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Audit letters as digits of three bits, in ASCII order; 0 stands after the end.
BITS = 3
DIGITS = {"D": "1", "I": "2", "K": "3", "R": "4"}
_TO_DIGITS = str.maketrans(DIGITS)
_TO_LETTERS = str.maketrans({d: c for c, d in DIGITS.items()})

# States of the pattern: nothing yet, after the system turn, after a user turn,
# after an assistant turn.
STATES = 4
ENDS = (0, 3)
# Codes of a row: 4 x fault + initial.
S, U, A, OTHER = range(4)
OK, BLANK, REPEATED, CUT = range(4)
# Rows whose weights are found in one piece.
BLOCK_ROWS = 256

_BLANK = r"\A[\x20\x09-\x0D]*\z"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


# ------------------------------------------------------------- integer weights

class Weights:
    """Integers of ways with at most ``size`` letters."""

    def __init__(self, size: int) -> None:
        self.size, self.low = size, BITS * size
        self.mask = (1 << self.low) - 1

    def of(self, cost: int, letters: str = "") -> int:
        tail = int(letters.translate(_TO_DIGITS) or "0", 8) << BITS * (self.size - len(letters))
        return (cost << self.low) + tail

    def before(self, cost: int, letter: str, way: int | None) -> int | None:
        """The way with one edit in front of it."""
        if way is None:
            return None
        tail = way & self.mask
        return way - tail + (tail >> BITS) + (cost << self.low) + (int(DIGITS[letter]) << self.low - BITS)

    def read(self, way: int | None) -> tuple[int, str] | None:
        """Cost and audit of a way."""
        if way is None:
            return None
        tail = format(way & self.mask, "o").zfill(self.size)
        return way >> self.low, tail.rstrip("0").translate(_TO_LETTERS)


def _least(*ways: int | None) -> int | None:
    return min((w for w in ways if w is not None), default=None)


def _inserts(w: Weights, v: list[int | None]) -> list[int | None]:
    """Weights before the place of inserted turns, from those behind it."""
    user = _least(v[2], w.before(INSERT, "I", v[3]))
    return [_least(v[0], w.before(INSERT, "I", user)), _least(v[1], w.before(INSERT, "I", user)), user,
            _least(v[3], w.before(INSERT, "I", v[2]))]


def _row(w: Weights, code: int, v: list[int | None]) -> list[int | None]:
    """Weights before a row, from those behind it."""
    fault, initial = divmod(code, 4)
    out = []
    for state in range(STATES):
        ways = [w.before(DELETE, "D", v[state])]
        if fault in (OK, CUT):
            more = TRUNCATED if fault == CUT else 0
            due, to = (A, 3) if state == 2 else (U, 2)
            if initial == due:
                ways.append(w.before(KEEP + more, "K", v[to]))
            elif initial == S and state == 0:
                ways.append(w.before(KEEP + more, "K", v[1]))
            ways.append(w.before(REROLE + more, "R", v[to]))
        out.append(_least(*ways))
    return out


def _through(w: Weights, codes: bytes, v: list[int | None]) -> list[int | None]:
    for code in reversed(codes):
        v = _inserts(w, _row(w, code, v))
    return v


Way = tuple[int, str] | None
Table = list[list[Way]]


def _block(codes: bytes) -> Table:
    """Cheapest way through a block of rows for each state before and after."""
    w = Weights(3 * len(codes) + 2)
    columns = [[w.read(x) for x in _through(w, codes, [w.of(0) if s == to else None for s in range(STATES)])]
               for to in range(STATES)]
    return [[columns[to][at] for to in range(STATES)] for at in range(STATES)]


_blocks = lru_cache(1 << 14)(_block)


def table_of(codes: bytes) -> Table:
    """The same through any number of rows, block by block."""
    return _in_order([_blocks(codes[lo:lo + BLOCK_ROWS]) for lo in range(0, len(codes), BLOCK_ROWS)])


def _in_order(tables: list[Table]) -> Table:
    """Several tables one after another, by halves."""
    if not tables:
        return [[(0, "") if a == b else None for b in range(STATES)] for a in range(STATES)]
    while len(tables) > 1:
        tables = [_join(*tables[k:k + 2]) if k + 1 < len(tables) else tables[k] for k in range(0, len(tables), 2)]
    return tables[0]


def _join(x: Table, y: Table) -> Table:
    """One table after another."""
    size = max((len(w[1]) for r in x for w in r if w), default=0) + max((len(w[1]) for r in y for w in r if w), default=0)
    w = Weights(size)
    out: Table = []
    for row in x:
        best: list[Way] = []
        for to in range(STATES):
            ways = ((a[0] + y[mid][to][0], a[1] + y[mid][to][1]) for mid, a in enumerate(row) if a and y[mid][to])
            best.append(min(ways, key=lambda p: w.of(*p), default=None))
        out.append(best)
    return out


def _closed(table: Table) -> tuple[int, str]:
    """The cheapest way that ends as the pattern must, from its beginning."""
    letters = max((len(a[1]) for a in table[0] if a), default=0)
    w = Weights(letters + 2)
    rest = _inserts(w, [w.of(0) if s in ENDS else None for s in range(STATES)])
    ends = [w.read(x) for x in rest]
    ways = ((a[0] + e[0], a[1] + e[1]) for a, e in zip(table[0], ends) if a and e)
    return min(ways, key=lambda p: w.of(*p))


@lru_cache(1 << 14)
def _short(codes: bytes) -> tuple[int, str]:
    w = Weights(3 * len(codes) + 2)
    last = _inserts(w, [w.of(0) if s in ENDS else None for s in range(STATES)])
    return w.read(_through(w, codes, last)[0])


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of the rows with these codes."""
    return _short(codes) if len(codes) <= BLOCK_ROWS else _closed(table_of(codes))


# ------------------------------------------------------------------ row codes

def _rows(rows: DataFrame) -> DataFrame:
    """Rows with an order that does not depend on how they are dealt."""
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))


def _code() -> Column:
    """``4 x fault + initial``, as far as a row alone tells."""
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)
    fault = F.when(F.col("text").rlike(_BLANK), BLANK).when(F.col("text").rlike(_ENDED), OK).otherwise(CUT)
    return (fault * 4 + initial).cast("int")


def _coded(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, digest, code, n)``: equal rows of a turn once with
    their number, and whether an earlier turn has them.  A conversation that
    lost all its rows keeps one without a code."""
    flat = rows.select("conv_id", F.when(F.col("live"), F.col("turn")).alias("turn"),
                       F.when(F.col("live"), F.col("role")).alias("role"),
                       F.when(F.col("live"), F.col("digest")).alias("digest"),
                       F.when(F.col("live"), _code()).alias("code"))
    per = write_table(flat.groupBy("conv_id", "turn", "role", "digest")
                      .agg(F.max("code").alias("code"), F.count(F.lit(1)).alias("n")), "turns")
    spot = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    again = (per.where("digest is not null").groupBy("conv_id", "role", "digest")
             .agg(F.min(spot).alias("first"), F.count(F.lit(1)).alias("spots")).where("spots > 1")
             .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
    on = per["conv_id"].eqNullSafe(again["_c"]) & (per["role"] == again["_r"]) & (per["digest"] == again["_d"])
    later = (F.col("first").isNotNull() & (spot > F.col("first"))).alias("later")
    return per.join(again, on, "left").select("conv_id", "turn", "role", "digest", "code", "n", later)


class _Part:
    """Rows of one conversation in one task."""

    def __init__(self, conv) -> None:
        self.conv, self.codes = conv, bytearray()
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn, code, n: int, later: bool) -> None:
        if code is None:
            return
        again = REPEATED * 4 + code % 4
        if code // 4 == BLANK:
            self.codes += bytes([code]) * n
        else:
            self.codes += bytes([again if later else code]) + bytes([again]) * (n - 1)
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            if self.first is None:
                self.first = turn


_SEGMENT = ("part int, turns long, first_turn long, last_turn long, rows long, blank long, duplicate long, truncated long, "
            "illegal long, head int, tail int, cost long, audit string, table array<string>")


def _illegal(initial: np.ndarray) -> int:
    a, b = initial[:-1], initial[1:]
    legal = ((a == S) & (b == U)) | ((a == U) & (b == A)) | ((a == A) & (b == U))
    return int(len(a) - legal.sum())


def _segment(p: _Part, part: int, whole: bool) -> tuple:
    codes = np.frombuffer(bytes(p.codes), np.uint8)
    fault, initial = codes // 4, codes % 4
    cost = audit = table = None
    if whole:
        cost, audit = cheapest(bytes(p.codes))
    else:
        table = [None if w is None else f"{w[0]}:{w[1]}" for r in table_of(bytes(p.codes)) for w in r]
    ends = (int(initial[0]), int(initial[-1])) if len(codes) else (None, None)
    return (p.conv, part, p.turns, p.first, p.last, len(codes), *(int((fault == f).sum()) for f in (BLANK, REPEATED, CUT)),
            _illegal(initial), *ends, cost, audit, table)


def _segments(coded: DataFrame) -> DataFrame:
    """Per task and conversation: counts, and the repair of a conversation that
    lies within the task, else its table of weights."""
    ship(coded.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")]
    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order, F.col("digest").asc_nulls_first())
    kind = coded.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, seen = TaskContext.get().partitionId(), None, 0
        out: list[tuple] = []

        def packed() -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        names = ["conv_id", *(f.split()[0] for f in _SEGMENT.split(", "))]
        types: list[pa.DataType] = []
        for b in batches:
            if not types:
                i32, i64 = pa.int32(), pa.int64()
                types = [b.schema.field(0).type, i32, *[i64] * 8, i32, i32, i64, pa.string(), pa.list_(pa.string())]
            cols = [b.column(k).to_pylist() for k in range(5)]
            for conv, turn, code, n, later in zip(*cols):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(_segment(now, part, seen > 1))
                    now, seen = _Part(conv), seen + 1
                now.add(turn, code, n, later)
            if len(out) >= 2000:
                yield packed()
                out.clear()
        if now is not None:
            out.append(_segment(now, part, False))
            yield packed()

    return dealt.select("conv_id", "turn", "code", "n", "later").mapInArrow(run, f"conv_id {kind}, {_SEGMENT}")


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _joined(parts: DataFrame) -> DataFrame:
    """One row per conversation whose rows may lie in several tasks (at most two
    such conversations a task)."""
    cols = [f.split()[0] for f in _SEGMENT.split(", ")]
    per = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("parts"))
    kind = parts.schema["conv_id"].dataType.simpleString()

    def way(x: str | None) -> Way:
        cost, _, letters = (x or "").partition(":")
        return None if x is None else (int(cost), letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, parts_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                turns = illegal = 0
                first = last = tail = None
                for p in parts_:
                    turns += p["turns"] - (p["first_turn"] is not None and p["first_turn"] == last)
                    first = p["first_turn"] if first is None else first
                    last = p["last_turn"] if p["last_turn"] is not None else last
                    illegal += p["illegal"]
                    if p["rows"]:
                        if tail is not None:
                            illegal += _illegal(np.array([tail, p["head"]]))
                        tail = p["tail"]
                tables = [[[way(x) for x in p["table"][STATES * k:STATES * (k + 1)]] for k in range(STATES)] for p in parts_]
                cost, audit = _closed(_in_order(tables))
                rows.append((conv, 0 if first is None else last - first + 1 - turns,
                             *(sum(p[k] for p in parts_) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit))
            if rows:
                names = ["conv_id", *(f.split()[0] for f in _COUNTS.split(", "))]
                types = [b.schema.field(0).type, *[pa.int64()] * 6, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return per.mapInArrow(run, f"conv_id {kind}, {_COUNTS}")


# ------------------------------------------------------------------- operator

def prepared(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, live)`` of a table of turns."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), F.lit(True).alias("live"))


def damage(conversations: DataFrame) -> DataFrame:
    """``prepared`` rows after the damage that ``crc32(conv_id:turn) % 20``
    names: 0 drops a row, 1 empties its text, 2 takes ``.!?`` out, 3 repeats it,
    4 makes it a user's."""
    rows = prepared(conversations)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("_k", F.crc32(F.encode(key, "UTF-8")) % 20)
    k = F.col("_k")
    text = F.when(k == 0, "").when(k == 1, "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(k == 4, "user").otherwise(F.col("role"))
    copies = F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (k != 0).alias("live"),
                       F.explode(copies).alias("_copy")).drop("_copy")


def audits(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` per
    conversation of ``prepared`` rows (``live`` false: the row is gone, only its
    conversation counts); itself a table in the shared folder."""
    found = write_table(_segments(_coded(_rows(rows))), "segments")
    whole = found.where("audit is not null").select(
        "conv_id", F.when(F.col("first_turn").isNull(), F.lit(0)).otherwise(
            F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return write_table(whole.unionByName(_joined(found.where("audit is null"))), "audits")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns ``(conv_id, pos, role, text, edit)`` of ``prepared``
    rows by their ``audits``; those of a conversation follow each other in order.
    Holds one batch of rows in memory, however long a conversation is."""
    ship(rows.sparkSession)
    body = _rows(rows.where("live")).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    head = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "digest")]
    dealt = body.unionByName(head).repartition("conv_id").sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, pos, state = None, "", 0, 0, 0
        out: list[tuple] = []

        def put(role: str, text: str, edit: str) -> None:
            nonlocal pos, state
            out.append((conv, pos, role, text, edit))
            pos, state = pos + 1, {"s": 1, "u": 2, "a": 3}[role[0]]

        def due() -> str:
            return "assistant" if state == 2 else "user"

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                put(due(), "", "I")

        for b in batches:
            id_type = b.schema.field(0).type
            for c, kind_, role, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                if kind_ == 0:
                    inserts()
                    conv, audit, at, pos, state = c, text, 0, 0, 0
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put(role, text, edit)
                elif edit == "R":
                    put(due(), text, edit)
            if b.num_rows:
                yield _turns(out, id_type)
                out = []
        inserts()
        if out:
            yield _turns(out, id_type)

    return dealt.select("conv_id", "kind", "role", "text").mapInArrow(
        run, f"conv_id {kind}, pos long, role string, text string, edit string")


def _turns(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
    cols = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["conv_id", "pos", "role", "text", "edit"])


def digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of ``repaired`` turns as they come:
    SHA-256 of ``role:text`` lines, joined by newlines."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, done, id_type = None, None, [], None
        for b in batches:
            id_type = b.schema.field(0).type
            for c, pos, role, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                if pos == 0:
                    if sha is not None:
                        done.append((conv, sha.hexdigest()))
                    conv, sha = c, hashlib.sha256()
                sha.update(f"{role}:{text}".encode() if pos == 0 else f"\n{role}:{text}".encode())
            if done:
                yield _hashes(done, id_type)
                done = []
        if sha is not None:
            yield _hashes([(conv, sha.hexdigest())], id_type)

    return turns.select("conv_id", "pos", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def _hashes(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], id_type), pa.array([r[1] for r in rows], pa.string())],
                                      ["conv_id", "repaired_sha256"])


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``prepared`` rows its ``audits`` row and the digest of
    its repaired turns (of nothing, where nothing is left)."""
    found = audits(rows)
    hashes = digests(repaired(rows, found)).withColumnRenamed("conv_id", "_c")
    none = F.sha2(F.lit(""), 256)
    return (found.join(hashes, found["conv_id"].eqNullSafe(hashes["_c"]), "left")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", none)).drop("_c"))
