"""Conversation repair against a plain shortest-path search, with all kinds of rows and cuts."""

import hashlib
import heapq
import random
import zlib

import pytest

from tallyfield.llm import conversation_repair as cr

ROWS = "conv_id long, turn long, role string, text string, seq int, codes string"


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        if h == 2:
            text = "".join(c for c in text if c not in ".!?")
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(h, 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows, faults):
    """Cheapest, then ASCII-least, edits: Dijkstra over (cost, audit) from the first row to the last."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, last, kept = heapq.heappop(heap)
        if (k, last) in done:
            continue
        done.add((k, last))
        if k == len(rows) and last in ("", "a"):
            return cost, audit, kept
        following = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[following]
        heapq.heappush(heap, (cost + 2, audit + "I", k, following, (*kept, f"{name}:")))
        if k == len(rows):
            continue
        _, _, role, text = rows[k]
        heapq.heappush(heap, (cost + 3, audit + "D", k + 1, last, kept))
        if faults[k] in ("blank", "duplicate"):
            continue
        more = faults[k] == "truncated"
        heapq.heappush(heap, (cost + 2 + more, audit + "R", k + 1, following, (*kept, f"{name}:{text}")))
        if role[:1] == following or (role[:1] == "s" and last == ""):
            heapq.heappush(heap, (cost + more, audit + "K", k + 1, role[0], (*kept, f"{role}:{text}")))


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = after_damage([r for r in rows if r[0] == conv])
        faults = faults_of(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = search(own, faults)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, convs=120, most=14):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", None, "é.", "a b. ", "x\n", ".", "long text " * 20 + "end."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "sys", "User"]
    rows = []
    for c in range(convs):
        turn = r.randrange(3)
        for k in range(r.randrange(1, most)):
            turn += r.choice([0, 1, 1, 1, 1, 2, 5])
            alternating = ["user", "assistant"][k % 2]
            text = r.choice(texts) if r.random() < 0.5 else f"say {r.randrange(50)}."
            rows.append((None if c == 7 else c, None if r.random() < 0.05 else turn, alternating if r.random() < 0.7 else r.choice(roles), text))
    return rows


def found(spark, rows, parts=1):
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], ROWS)
    return sorted(map(tuple, cr.repair(df.repartition(parts)).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found(spark, rows, 3) == brute(rows)


@pytest.mark.parametrize("seed,size,fan", [(3, 3, 2), (4, 1, 3)])
def test_long_conversations_in_segments(spark, seed, size, fan, monkeypatch):
    """Segments of a few rows, so most conversations take the long way; one has most rows and lies in several partitions."""
    monkeypatch.setattr(cr, "FAN", fan)
    whole = cr.segmented
    monkeypatch.setattr(cr, "segmented", lambda rows: whole(rows, size, 200))
    monkeypatch.setattr(cr, "_multiply", _multiply_by(fan))
    rows = random_rows(seed, 25, 30)
    r = random.Random(seed)
    rows += [(1000, k // 2 if k % 7 else None, r.choice(["user", "assistant"]), f"text {r.randrange(150)}{r.choice('.!x')}") for k in range(300)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        assert found(spark, rows, 2) == brute(rows)
        parts = cr.segmented(cr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).filter("conv_id = 1000")
        assert parts.select("part").distinct().count() > 1
    finally:
        spark.conf.unset(coalesce)


def test_sql_on_odd_rows():
    import duckdb
    import pandas as pd

    rows = random_rows(9, 60, 12)
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    con.execute("CREATE TABLE conversations AS SELECT cast(conv_id AS bigint) AS conv_id, cast(turn AS bigint) AS turn, cast(role AS varchar) AS role, cast(text AS varchar) AS text FROM given")
    assert sorted(con.execute(cr.SQL).fetchall(), key=repr) == brute(rows)


def _multiply_by(fan):
    def multiply(group):
        import pandas as pd

        from tallyfield.llm import conversation_repair as m

        group = group.sort_values("pos")
        out = m.identity()
        for costs, audits in zip(group["costs"], group["audits"], strict=True):
            out = m.product(out, m._unflat(costs, audits))
        costs, audits = m._flat(out)
        return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1], "pos": group["pos"].iloc[:1] // fan, "costs": [costs], "audits": [audits]})

    return multiply


def test_odd_conversations(spark):
    rows = [(1, None, None, None), (2, 5, "user", "Hi."), (3, 1, "assistant", "Hi."), (4, 1, "system", "S."), (4, 9, "user", "U."), (None, 3, "user", "same."), (None, 3, "user", "same."), (5, 1, "user", "x" * 3_000_000 + ".")]
    rows += [(c, t, "user", "dropped?") for c in range(100, 160) for t in [next(t for t in range(999) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)]]  # all rows dropped
    got = found(spark, rows)
    assert got == brute(rows) and sum(r[1:8] == (0, 0, 0, 0, 0, 0, "") for r in got) >= 60


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("seed", range(5))
def test_grammar_changes_nothing(seed):
    r = random.Random(seed)
    sequences = ["".join(chr(65 + r.randrange(16)) for _ in range(r.randrange(40))) for _ in range(60)]
    rules = ()
    for _ in range(4):
        counts = {}
        for s in sequences:
            for pair in cr.pairs_of(cr.Grammar(rules).compress(s)):
                counts[pair] = counts.get(pair, 0) + 1
        rules += tuple(cr.chosen(list(counts.items()), 8))
    with_rules, without = cr.Grammar(rules), cr.Grammar()
    assert len(rules) > 20 and any(ord(x) > 255 for pair in rules for x in pair)
    for s in sequences:
        assert cr.cheapest(with_rules.matrix(s)) == cr.cheapest(without.matrix(s))
        assert cr._flat(with_rules.matrix(s)) == cr._flat(without.matrix(s))


def test_rules_are_learnt_from_all_sequences(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"Text {c} {t}.") for c in range(200) for t in range(8)]
    segments = cr.segmented(cr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    rules = cr.learn(segments)
    assert {"EI", "IE"} & set(rules) and any(ord(p[0]) > 255 for p in rules)


@pytest.mark.parametrize("seed", range(20))
def test_ropes(seed):
    r = random.Random(seed)

    def rope(text):
        if len(text) < 2 or r.random() < 0.2:
            return cr.Rope(text)
        k = r.randrange(1, len(text))
        return cr.Rope(None, rope(text[:k]), rope(text[k:]))

    texts = ["".join(r.choice("DI") for _ in range(r.randrange(1, 12))) for _ in range(30)]
    for a in texts:
        for b in texts:
            x, y = rope(a), rope(b)
            assert (x < y) == (a < b) and str(x + y) == a + b and x.size == len(a)
            assert (x + y < x + rope(a)) == (b < a)
