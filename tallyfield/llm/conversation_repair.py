"""Conversation structure repair: a dynamic program over grammar-compressed role/fault sequences.

Each row of a conversation is a symbol: initial of its role and first fault.  A repair walks
an automaton of four states (nothing yet, after system, after user, after assistant) by Keep,
Rerole, Delete and Insert; a symbol is a 4 x 4 matrix over (cost, audit), where audits are
ropes, products add costs and join audits, and the lesser of two is the cheaper, then the
ASCII-least.  (Of two audits of equal cost for the same rows neither begins the other, since
what follows would be inserts at a cost; so the lesser of two stays so whatever is joined to
both, and the products are exact.)

Re-Pair: `learn` counts adjacent symbols over all distinct sequences in rounds, and gives the
most frequent pairs that don't touch one another rules of their own, which the next rounds
count as symbols.  A rule has one matrix, the product of its two parts', so audits of common
runs are joined once and shared by all conversations.  The grammar speeds the program up and
decides nothing: what no rule covers is multiplied symbol by symbol, so its bounds (ROUNDS,
RULES) leave every result as it is.

Scale.  Rows are dealt by ranges of (conv_id, turn, role, text's beginning), so a conversation
of any size is spread over tasks, and written as segments of SEGMENT_ROWS at most.  A
conversation in one segment is repaired where it lies.  Of longer ones each segment has its
matrix, matrices are multiplied FAN at a time by levels, and duplicates of rows in other
partitions are found by a slim join.  Only the digest of a repaired conversation, which is
sequential, reads a conversation in one task, segment by segment.

Defined cases: nulls are one space in keys, roles and texts; rows of one turn (ties) go by
role, then text, both by code point, and repeated rows are duplicates; a null conv_id is a
conversation; a role of another initial, or none, can't be kept; empty texts are blank;
texts of any length are whole (a segment closes at SEGMENT_BYTES); a conversation without
rows has zeros; extra columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared as S

SEGMENT_ROWS, SEGMENT_BYTES, FAN = 256, 1 << 20, 64
ROUNDS, RULES = 6, 16
#: Codes of a row: initial (0 s, 1 u, 2 a, 3 another) * 4 + fault (0 none, 1 blank, 2 duplicate, 3 truncated), as letters from "A".
INITIALS, BLANK, DUPLICATE, TRUNCATED = "sua", 1, 2, 3
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Costs.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
#: What may follow in each state: user or assistant; the state after each of them.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
_SPACES, _STOPS = b" \t\n\x0b\x0c\r", b".!?"
SEGMENT = (
    "conv_id long, part int, seq long, codes string, roles array<string>, texts array<string>, "
    "first_turn long, last_turn long, n_turns long, opens boolean, closes boolean"
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# Ropes and matrices


class Rope:
    """A text as two halves, or as it is; never changed, so halves are shared."""

    __slots__ = ("size", "left", "right", "text")

    def __init__(self, text: str | None = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if text is not None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if not self.size else self
        if self.text is not None and other.text is not None and self.size + other.size <= 32:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if x.text is not None:
                out.append(x.text)
            else:
                stack += (x.right, x.left)
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y:
                continue
            if x.text is None and (x.size >= y.size or y.text is not None):
                a += (x.right, x.left)
                b.append(y)
            elif y.text is None:
                b += (y.right, y.left)
                a.append(x)
            else:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                a += [Rope(x.text[n:])] if x.size > n else []
                b += [Rope(y.text[n:])] if y.size > n else []
        return not a and bool(b)


Matrix = list[list[tuple[int, Rope] | None]]


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = []
    for row in a:
        line = []
        for j in range(len(b[0])):
            best = None
            for left, below in zip(row, b, strict=True):
                right = below[j]
                if left is None or right is None:
                    continue
                cost = left[0] + right[0]
                if best is None or cost < best[0]:
                    best = (cost, left[1] + right[1])
                elif cost == best[0] and (audit := left[1] + right[1]) < best[1]:
                    best = (cost, audit)
            line.append(best)
        out.append(line)
    return out


def identity() -> Matrix:
    return [[(0, Rope()) if i == j else None for j in range(4)] for i in range(4)]


def inserts() -> Matrix:
    """No insert, one or two: a third is the first again, at a cost."""
    out = identity()
    for i in range(4):
        j = NEXT[i]
        out[i][j] = (INSERT, Rope("I"))
        if NEXT[j] != i:
            out[i][NEXT[j]] = (2 * INSERT, Rope("II"))
    return out


def symbol(code: str) -> Matrix:
    """Inserts before a row, then the row's edit."""
    initial, fault = divmod(ord(code) - ord("A"), 4)
    out: Matrix = [[(DELETE, Rope("D")) if i == j else None for j in range(4)] for i in range(4)]
    if fault not in (BLANK, DUPLICATE):
        more = UNFINISHED if fault == TRUNCATED else 0
        for i in range(4):
            out[i][NEXT[i]] = (REROLE + more, Rope("R"))
            if initial == 0 and i == START:
                out[i][SYSTEM] = (more, Rope("K"))
            elif initial == NEXT[i] - 1:
                out[i][NEXT[i]] = (more, Rope("K"))
    return product(inserts(), out)


def canonical(codes: str) -> str:
    """Rows that must go are one symbol, whatever their role."""
    return codes.translate(_CANONICAL)


_CANONICAL = {ord("A") + 4 * i + fault: "B" for i in range(4) for fault in (BLANK, DUPLICATE)}


class Grammar:
    """Rules (pairs of symbols; the k-th is chr(256 + k)) and their matrices, from the bottom up."""

    def __init__(self, rules: tuple[str, ...] = ()):
        self.rules = [(pair, chr(256 + k)) for k, pair in enumerate(rules)]
        self.matrices = {chr(ord("A") + k): symbol(chr(ord("A") + k)) for k in range(16)}
        for pair, name in self.rules:
            self.matrices[name] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def compress(self, codes: str) -> str:
        text = canonical(codes)
        for pair, name in self.rules:
            text = text.replace(pair, name)
        return text

    def matrix(self, codes: str) -> Matrix:
        found = [self.matrices[x] for x in self.compress(codes)] or [identity()]
        while len(found) > 1:  # halves of like size, so ropes stay shallow
            found = [product(*found[k : k + 2]) if k + 1 < len(found) else found[k] for k in range(0, len(found), 2)]
        return found[0]


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """(cost, audit) of the best way from nothing to nothing or an assistant's turn."""
    last = product([matrix[START]], inserts())[0]
    cost, audit = min(x for x in (last[START], last[ASSISTANT]) if x is not None)
    return cost, str(audit)


@lru_cache(maxsize=2)
def _grammar(rules: tuple[str, ...]) -> Grammar:
    return Grammar(rules)


@lru_cache(maxsize=50_000)
def _repaired(rules: tuple[str, ...], codes: str) -> tuple[int, str]:
    return cheapest(_grammar(rules).matrix(codes))


# Re-Pair


def pairs_of(text: str) -> Iterator[str]:
    """Adjacent symbols; of a run of one symbol, pairs that don't overlap."""
    taken = False
    for a, b in zip(text, text[1:], strict=False):
        if taken and a == b:
            taken = False
            continue
        taken = a == b
        yield a + b


def _count_pairs(rules):
    def run(batches, schema):
        grammar, counts = _grammar(rules), Counter()
        for batch in batches:
            for codes, n in zip(batch.column("codes").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for pair in pairs_of(grammar.compress(codes)):
                    counts[pair] += n
        if counts:  # as many as there are pairs of symbols at most
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], schema=schema)

    return run


def chosen(counts: list[tuple[str, int]], most: int) -> list[str]:
    """The most frequent pairs of which none can overlap another, so their order doesn't matter."""
    out: list[str] = []
    for pair, n in sorted(counts, key=lambda x: (-x[1], x[0])):
        if n > 1 and len(out) < most and not any(pair[0] == y[1] or pair[1] == y[0] for y in out):
            out.append(pair)
    return out


def learn(segments: DataFrame, rounds: int = ROUNDS, most: int = RULES) -> tuple[str, ...]:
    """Rules for the sequences of all segments, a bounded number."""
    deletes = "".join(chr(c) for c in _CANONICAL)
    codes = F.translate("codes", deletes, "B" * len(deletes))
    sequences = S.stage(segments.groupBy(codes.alias("codes")).agg(F.count("*").alias("n")), "sequences")
    rules: tuple[str, ...] = ()
    for _ in range(rounds):
        counted = S.map_arrow(sequences, _count_pairs(rules), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counted.orderBy(F.desc("n"), "pair").limit(8 * most).collect()
        more = chosen([(r.pair, r.n) for r in top], most)
        if not more:
            break
        rules += tuple(more)
    S.unstage(sequences)
    return rules


# Rows and segments


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage; a dropped row stays as one that is gone, so that its conversation is known."""
    conv, turn = (F.col(c).cast("long").alias(c) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)))
    rows = conversations.select(conv, turn, role.alias("role"), text.alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("h"))
    texts = F.when(F.col("h").isin(0, 1), "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    gone = F.when(F.col("h") == 0, F.array(F.lit(True))).when(F.col("h") == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(F.lit(False)))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), texts.alias("text"), F.explode(gone).alias("gone"))


def print_of(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def fault_of(text: str) -> int:
    words = text.encode().rstrip(_SPACES)
    return BLANK if not words else TRUNCATED if words[-1] not in _STOPS else 0


def _segment(size, most_bytes):
    def rows(batches) -> Iterator[tuple[int, tuple]]:
        part, seq = TaskContext.get().partitionId(), 0
        begun, conv, seen, opens = False, None, set(), True
        codes, roles, texts, turns, n_bytes = [], [], [], [], 0

        def close(closes: bool) -> tuple[int, tuple]:
            told = [t for t in turns if t is not None]
            ends = (told[0], told[-1]) if told else (None, None)
            return n_bytes, (conv, part, seq, "".join(codes), roles, texts, *ends, len(set(told)), opens, closes)

        for batch in batches:
            for c, turn, role, text, gone in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "gone")), strict=True):
                if not begun or c != conv:
                    if begun:
                        yield close(True)
                        seq += 1
                    begun, conv, seen, opens = True, c, set(), True
                    codes, roles, texts, turns, n_bytes = [], [], [], [], 0
                if gone:
                    continue
                if len(codes) >= size or n_bytes >= most_bytes:
                    yield close(False)
                    seq, opens = seq + 1, False
                    codes, roles, texts, turns, n_bytes = [], [], [], [], 0
                fault = fault_of(text)
                if fault != BLANK:
                    mark = print_of(role, text)
                    if mark in seen:
                        fault = DUPLICATE
                    seen.add(mark)
                initial = INITIALS.find(role[0]) if role else -1
                codes.append(chr(ord("A") + 4 * (initial if initial >= 0 else 3) + fault))
                roles.append(role)
                texts.append(text)
                turns.append(turn)
                n_bytes += len(text) + 50
        if begun:
            yield close(True)

    def run(batches, schema):
        yield from S.sized_batches(rows(batches), schema)

    return run


def segmented(rows: DataFrame, size: int = SEGMENT_ROWS, most_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Segments (SEGMENT) of damaged rows in order, written to the shared folder."""
    dealt = rows.withColumn("head", F.left("text", F.lit(64))).repartitionByRange("conv_id", "turn", "role", "head").drop("head")
    return S.stage(S.map_arrow(dealt.sortWithinPartitions("conv_id", "turn", "role", "text"), _segment(size, most_bytes), SEGMENT), "segments")


# Results


class Tally:
    """Counts and digest of one conversation, segment by segment."""

    def __init__(self, conv_id: int | None, cost: int, audit: str):
        self.conv_id, self.cost, self.audit = conv_id, cost, audit
        self.at, self.state, self.digest, self.any = 0, START, hashlib.sha256(), False
        self.faults, self.illegal, self.initial = [0] * 4, 0, None
        self.first = self.last = None
        self.turns = 0

    def _put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) * self.any}{role}:{text}".encode())
        self.any = True

    def _put_next(self, text: str) -> None:
        self.state = NEXT[self.state]
        self._put("user" if self.state == USER else "assistant", text)

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put_next("")
            self.at += 1

    def add(self, codes: str, roles: list[str], texts: list[str], first: int | None, last: int | None, n_turns: int) -> None:
        for code, role, text in zip(codes, roles, texts, strict=True):
            initial, fault = divmod(ord(code) - ord("A"), 4)
            self.faults[fault] += 1
            self.illegal += self.initial is not None and (self.initial, initial) not in LEGAL
            self.initial = initial
            self._inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = initial + 1
                self._put(role, text)
            elif edit == "R":
                self._put_next(text)
        if first is not None:
            self.turns += n_turns - (first == self.last)
            self.first = first if self.first is None else self.first
            self.last = last

    def row(self) -> tuple:
        self._inserts()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, self.audit, self.digest.hexdigest()


_PARTS = ("codes", "roles", "texts", "first_turn", "last_turn", "n_turns")


def _repair_whole(rules):
    def rows(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", *_PARTS)]
            for conv, codes, *rest in zip(*columns, strict=True):
                tally = Tally(conv, *_repaired(rules, canonical(codes)))
                tally.add(codes, *rest)
                yield len(codes) + 300, tally.row()

    def run(batches, schema):
        yield from S.sized_batches(rows(batches), schema)

    return run


def _corrected(codes: str, again: list[int] | None) -> str:
    """codes where the rows with these numbers are duplicates."""
    out = list(codes)
    for k in again or ():
        out[k] = chr((ord(out[k]) - ord("A")) // 4 * 4 + DUPLICATE + ord("A"))
    return "".join(out)


def _prints(batches, schema):
    def rows():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "seq", "codes", "roles", "texts")]
            for conv, part, seq, codes, roles, texts in zip(*columns, strict=True):
                for k, (code, role, text) in enumerate(zip(codes, roles, texts, strict=True)):
                    if (ord(code) - ord("A")) % 4 not in (BLANK, DUPLICATE):
                        yield 60, (conv, part, seq, k, print_of(role, text))

    yield from S.sized_batches(rows(), schema)


def _matrices(rules):
    def rows(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "pos", "codes", "again")]
            for conv, pos, codes, again in zip(*columns, strict=True):
                flat = _flat(_grammar(rules).matrix(_corrected(codes, again)))
                yield 20 * len(codes) + 300, (conv, pos, *flat)

    def run(batches, schema):
        yield from S.sized_batches(rows(batches), schema)

    return run


def _flat(matrix: Matrix) -> tuple[list[int | None], list[str | None]]:
    cells = [x for row in matrix for x in row]
    return [None if x is None else x[0] for x in cells], [None if x is None else str(x[1]) for x in cells]


def _unflat(costs: Iterable, audits: Iterable) -> Matrix:
    cells = [None if a is None else (int(c), Rope(a)) for c, a in zip(costs, audits, strict=True)]
    return [cells[k : k + 4] for k in range(0, 16, 4)]


def _multiply(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("pos")
    found = [_unflat(c, a) for c, a in zip(group["costs"], group["audits"], strict=True)]
    while len(found) > 1:
        found = [product(*found[k : k + 2]) if k + 1 < len(found) else found[k] for k in range(0, len(found), 2)]
    costs, audits = _flat(found[0])
    return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1], "pos": group["pos"].iloc[:1] // FAN, "costs": [costs], "audits": [audits]})


def _finish(batches, schema):
    def rows():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "costs", "audits")]
            for conv, costs, audits in zip(*columns, strict=True):
                cost, audit = cheapest(_unflat(costs, audits))
                yield len(audit) + 50, (conv, cost, audit)

    yield from S.sized_batches(rows(), schema)


def _repair_long(batches, schema):
    """Over rows sorted by conversation: the row with its audit, then its segments in order."""

    def rows():
        tally = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "cost", "audit", "again", *_PARTS)]
            for conv, part, cost, audit, again, codes, *rest in zip(*columns, strict=True):
                if part < 0:
                    if tally:
                        yield len(tally.audit) + 300, tally.row()
                    tally = Tally(conv, cost, audit)
                else:
                    tally.add(_corrected(codes, again), *rest)
        if tally:
            yield len(tally.audit) + 300, tally.row()

    yield from S.sized_batches(rows(), schema)


def _same(a: DataFrame, b: DataFrame, *keys: str):
    on = a[keys[0]].eqNullSafe(b[keys[0]])
    for key in keys[1:]:
        on &= a[key] == b[key]
    return on


def _long(segments: DataFrame, several: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """Results of conversations of more than one segment; several: (conv_id) of those in several partitions."""
    # duplicates of rows in earlier partitions: no more rows than partitions for a text
    split = segments.join(F.broadcast(several), _same(segments, several, "conv_id"), "left_semi")
    prints = S.stage(S.map_arrow(split.select("conv_id", "part", "seq", "codes", "roles", "texts"), _prints, "conv_id long, part int, seq long, k int, mark binary"), "prints")
    firsts = prints.groupBy("conv_id", "mark").agg(F.min("part").alias("first"), F.max("part").alias("last")).filter("last > first").drop("last")
    later = prints.join(firsts, _same(prints, firsts, "conv_id", "mark") & (prints["part"] > firsts["first"]))
    again = later.groupBy(prints["part"], prints["seq"]).agg(F.collect_list(prints["k"]).alias("again"))
    pieces = S.stage(segments.join(again, ["part", "seq"], "left"), "pieces")
    # places of segments in their conversations, by the counts of each partition
    runs = pieces.groupBy("conv_id", "part").agg(F.min("seq").alias("from"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition at most
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    slim = pieces.select("conv_id", "part", "seq", "codes", "again")
    placed = slim.join(runs, _same(slim, runs, "conv_id", "part")).select(slim["conv_id"], (F.col("base") + F.col("seq") - F.col("from")).alias("pos"), "codes", "again")
    schema = "conv_id long, pos long, costs array<int>, audits array<string>"
    matrices = S.stage(S.map_arrow(placed, _matrices(rules), schema), "matrices")
    while (matrices.agg(F.max("pos")).first()[0] or 0) > 0:
        matrices = S.stage(matrices.groupBy("conv_id", F.floor(F.col("pos") / FAN)).applyInPandas(_multiply, schema), "matrices")
    found = S.map_arrow(matrices.select("conv_id", "costs", "audits"), _finish, "conv_id long, cost long, audit string")
    head = found.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("seq"), "cost", "audit")
    rows = pieces.select("conv_id", "part", "seq", "again", *_PARTS).unionByName(head, allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return S.map_arrow(ordered, _repair_long, RESULT)


def repair(conversations: DataFrame) -> DataFrame:
    """Damage, judge and repair every conversation (RESULT)."""
    segments = segmented(damaged(conversations))
    rules = learn(segments)
    # conversations at the ends of partitions, as many as these at most
    ends = segments.groupBy("part").agg(F.min_by("conv_id", "seq").alias("a"), F.max_by("conv_id", "seq").alias("b"))
    ends = ends.select("part", F.explode(F.array_distinct(F.array("a", "b"))).alias("conv_id"))
    several = S.stage(ends.groupBy("conv_id").count().filter("count > 1").select("conv_id"), "several")
    one = segments.filter("opens and closes")
    whole = one.join(F.broadcast(several), _same(one, several, "conv_id"), "left_anti")
    done = S.map_arrow(whole.select("conv_id", *_PARTS), _repair_whole(rules), RESULT)
    cut = segments.filter("not (opens and closes)")
    pieces = cut.unionByName(one.join(F.broadcast(several), _same(one, several, "conv_id"), "left_semi"))
    pieces = S.stage(pieces, "long")
    return done if pieces.isEmpty() else done.unionByName(_long(pieces, several, rules))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _add(v: str, cost: str, edit: str) -> str:
    """SQL: a state's cost (nine digits) and audit with an edit more; null stays null."""
    return f"lpad(cast(cast(left({v}, 9) AS bigint) + {cost} AS varchar), 9, '0') || substr({v}, 10) || '{edit}'"


SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, (c & 1) * 3988292384))) AS t
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' '), ''),
      lambda x: cast(ascii(x) AS bigint))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS h
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again
  FROM hashed
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS k FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM numbered
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), dp AS (
  SELECT conv_id, cast(0 AS bigint) AS k, '000000000' AS v0, cast(NULL AS varchar) AS v1, cast(NULL AS varchar) AS v2, cast(NULL AS varchar) AS v3 FROM counts
  UNION ALL
  SELECT conv_id, k, {_add("v0", "3", "D")}, least({_add("v1", "3", "D")}, CASE WHEN stays AND initial = 's' THEN {_add("v0", "more", "K")} END),
    least({_add("v2", "3", "D")}, CASE WHEN stays THEN least({", ".join(_add(v, "2 + more", "R") for v in ("v0", "v1", "v3"))}) END,
      CASE WHEN stays AND initial = 'u' THEN least({", ".join(_add(v, "more", "K") for v in ("v0", "v1", "v3"))}) END),
    least({_add("v3", "3", "D")}, CASE WHEN stays THEN {_add("v2", "2 + more", "R")} END, CASE WHEN stays AND initial = 'a' THEN {_add("v2", "more", "K")} END)
  FROM (
    SELECT dp.conv_id, j.k, initial, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS more, v0, v1,
      least(v2, {", ".join(_add(v, "2", "I") for v in ("v0", "v1", "v3"))}) AS v2, least(v3, {_add("v2", "2", "I")}, {", ".join(_add(v, "4", "II") for v in ("v0", "v1"))}) AS v3
    FROM dp JOIN judged j ON dp.conv_id IS NOT DISTINCT FROM j.conv_id AND j.k = dp.k + 1
  )
), best AS (
  SELECT c.*, least(v0, v3, {_add("v2", "2", "I")}, {", ".join(_add(v, "4", "II") for v in ("v0", "v1"))}) AS v
  FROM counts c JOIN dp ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n = dp.k
), edits AS (
  SELECT conv_id, i, substr(v, 9 + i, 1) AS edit, i - length(replace(substr(v, 10, i), 'I', '')) AS inserted
  FROM (SELECT conv_id, v, unnest(range(1, length(v) - 8)) AS i FROM best)
), kept AS (
  SELECT e.conv_id, e.i, e.edit, j.role, j.text, row_number() OVER (PARTITION BY e.conv_id ORDER BY e.i) AS nth,
    first_value(CASE WHEN e.edit = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id ORDER BY e.i) AS system_first
  FROM edits e LEFT JOIN judged j ON e.edit <> 'I' AND e.conv_id IS NOT DISTINCT FROM j.conv_id AND j.k = e.i - e.inserted
  WHERE e.edit <> 'D'
), texts AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - system_first) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS h
  FROM kept GROUP BY conv_id
)
SELECT a.conv_id, cast(coalesce(gaps, 0) AS bigint) AS gaps, cast(coalesce(blank, 0) AS bigint) AS blank, cast(coalesce(duplicate, 0) AS bigint) AS duplicate,
  cast(coalesce(truncated, 0) AS bigint) AS truncated, cast(coalesce(illegal, 0) AS bigint) AS illegal, cast(coalesce(left(v, 9), '0') AS bigint) AS cost,
  coalesce(substr(v, 10), '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN texts t ON a.conv_id IS NOT DISTINCT FROM t.conv_id
"""
