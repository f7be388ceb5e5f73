import hashlib
import itertools
import random
import re
import zlib

import pytest

from marketprep.llm import convrepair as cr

from .helpers import SF

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"
FULL = {"u": "user", "a": "assistant"}


def damaged(rows):
    """Conversations by id, their rows after the damage in order."""
    out = {}
    for conv, turn, role, text in rows:
        got = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        got += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for got in out.values():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(WS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows, found):
    """All edits with up to two turns inserted at a place."""
    gaps = ["", "u", "a", "ua", "au", "uu", "aa"]
    for ins in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product("KUAD", repeat=len(rows)):
            cost, audit, turns = 0, "", []
            for k, gap in enumerate(ins):
                for g in gap:
                    cost, audit = cost + 3, audit + "I"
                    turns.append((FULL[g], ""))
                if k == len(rows):
                    break
                e, (_, role, text) = edits[k], rows[k]
                if e == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                if found[k] in ("blank", "duplicate"):
                    cost = None
                    break
                cost += 3 * (found[k] == "truncated") + 3 * (e != "K")
                audit += "K" if e == "K" else "R"
                turns.append((role if e == "K" else FULL[e.lower()], text))
            if cost is not None and all(r for r, _ in turns) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns)):
                yield cost, audit, turns


def forward(rows, found):
    """The same for longer conversations: ways through the pattern by their end,
    the best of each state and number of letters."""
    ways = {(0, 0): (0, "", ())}

    def relax(into, key, way):
        if key not in into or way[:2] < into[key][:2]:
            into[key] = way

    def insert(ways):
        for _ in range(2):
            for (state, n), (cost, audit, turns) in list(ways.items()):
                role, to = ("assistant", 3) if state == 2 else ("user", 2)
                relax(ways, (to, n + 1), (cost + 3, audit + "I", (*turns, (role, ""))))
        return ways

    for (_, role, text), fault in zip(rows, found):
        new = {}
        for (state, n), (cost, audit, turns) in insert(ways).items():
            relax(new, (state, n + 1), (cost + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            due, to = ("assistant", 3) if state == 2 else ("user", 2)
            if role[:1] == due[0]:
                relax(new, (to, n + 1), (cost + more, audit + "K", (*turns, (role, text))))
            elif role[:1] == "s" and state == 0:
                relax(new, (1, n + 1), (cost + more, audit + "K", (*turns, (role, text))))
            relax(new, (to, n + 1), (cost + more + 3, audit + "R", (*turns, (due, text))))
        ways = new
    return min((w for (state, _), w in insert(ways).items() if state in (0, 3)), key=lambda w: w[:2])


def want(rows, best=forward):
    out = {}
    for conv, got in damaged(rows).items():
        found = faults(got)
        turns = {t for t, _, _ in got if t is not None}
        initials = [r[:1] for _, r, _ in got]
        cost, audit, fixed = best(got, found)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def show(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in rows}
    assert len(out) == len(rows)
    return out


ROLES = ["user", "assistant", "system", "tool", "ann", "ugh", "", None]
TEXTS = ["Yes.", "No!", "cut", "", " \n", None, "é?\n", " ", "a. b", "Yes."]


def made(seed, n, longest, roles=ROLES, texts=TEXTS):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        size = rng.randint(1, longest)
        for t in range(size):
            turn = None if rng.random() < 0.05 else t + (t > 2) * rng.randint(0, 2)
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


def test_all_repairs_of_short_conversations(spark):
    rows = made(1, 60, 2) + [(100 + c, *r) for c, *r in made(4, 3, 3)]
    best = want(rows, lambda got, found: min(every_repair(got, found), key=lambda w: w[:2]) if len(got) < 4 else forward(got, found))
    assert want(rows) == best
    assert show(cr.report(cr.damage(spark.createDataFrame(rows, SCHEMA)))) == best


def test_long_null_and_repeated(spark):
    rows = made(2, 40, 60) + made(3, 30, 30, ["user", "assistant"], ["Yes.", "No!", "Well. ", "cut", "Who?", "A.", "B."])
    rows = [(c if c % 7 else None, *r) for c, *r in rows]
    rows += rows[:40] + [(900, None, None, None), (901, 5, "system", "S."), (None, 3, "user", "x" * 200_000 + ".")]
    rows += [(902, t, "user", f"t{t % 11}.") for t in range(120)] + [(903, 1, "user", "Same.")] * 100
    df = spark.createDataFrame([(*r, "x", 1, "d") for r in rows], SCHEMA + ", audit string, digest int, live string")
    assert show(cr.report(cr.damage(df))) == want(rows)


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    """Blocks and tables of several tasks give what one piece gives."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"{t}.", f"{t}", "ok.", ""])) for t in range(150)]
    rows += made(6, 20, 6)
    monkeypatch.setattr(cr, "BLOCK_ROWS", 7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        found = cr._segments(cr._coded(cr._rows(cr.damage(df)))).where("conv_id = 1").collect()
        assert len(found) > 2
        assert show(cr.report(cr.damage(df))) == want(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("size", [0, 1, 5, 40, 130])
def test_weights_decide_as_cost_and_audit_do(size, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_ROWS", 32)
    rng = random.Random(size)
    names = {cr.S: "system", cr.U: "user", cr.A: "assistant", cr.OTHER: "tool"}
    fault = {cr.OK: "", cr.BLANK: "blank", cr.REPEATED: "duplicate", cr.CUT: "truncated"}
    for _ in range(4):
        codes = bytes(rng.choice([rng.randrange(16), cr.U, cr.A]) for _ in range(size))
        rows = [(0, names[c % 4], "") for c in codes]
        cost, audit, _ = forward(rows, [fault[c // 4] for c in codes])
        assert cr.cheapest(codes) == (cost, audit)
        assert cr._closed(cr.table_of(codes)) == (cost, audit)


def test_turns(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "And?"), (1, 3, "assistant", "No.")]
    got = cr.prepared(spark.createDataFrame(rows, SCHEMA))
    turns = [tuple(r) for r in cr.repaired(got, cr.audits(got)).orderBy("pos").collect()]
    assert turns == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "", "I"), (1, 2, "user", "And?", "K"), (1, 3, "assistant", "No.", "K")]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cr.report(cr.damage(df)).collect() == [] and "audit" in cr.report(cr.damage(df)).columns


def test_query_on_table(spark):
    from marketprep.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert show(QUERIES["op11_conversation_repair"](spark, SF)) == want(rows)
