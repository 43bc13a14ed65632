"""Conversation structure repair over a suffix-shared automaton (DAWG).

Every row of a conversation becomes one symbol: its role initial (or "other") and whether it is sound,
truncated, or must go (blank or duplicate; then the role plays no part, so that it is one symbol). A conversation is a
word; words end in the vector of costs that holds after them. Sorted by their reversal, words that share an end are
neighbours, and a state of the automaton - one distinct suffix with its end - is built once, when the first word
that runs through it comes: the path of the current word is kept, the next word leaves it where their suffixes part.
Each state holds, per grammar state, the cost to go and the first edit of the best audit, so that the audits
of all conversations are read off along their paths.

Candidates for one grammar state differ in their first initial (a row or an inserted turn can only take
the one role that the grammar wants), so ties in cost are decided by that letter alone.

Words are cut into segments of ``SEGMENT`` rows. Conversations of several segments (a hot conversation included) meet
as min-plus products: per segment the cost between each pair of grammar states, folded from the end, then
every segment is solved with the costs that follow it as its end. Nothing of a whole conversation but 16
numbers a segment meets in one task; SHA-256 of a repaired conversation is sequential by definition
and streams through its segments in order in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.turns import content_key, numbered, streamed_sha256
from tessera.llm.workspace import Workspace

SEGMENT = 512  # rows a word
BLANKS = " \t\n\x0b\f\r"
NEVER = 1 << 40
# grammar (s?(ua)+)?: states 0 nothing yet, 1 after s, 2 after u, 3 after a
WANTS = (2, 2, 3, 2)  # the state that the role wanted next leads to
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
ROLE_OF = {1: "system", 2: "user", 3: "assistant"}
FINAL = "0,x,x,0"


def read_costs(end: str) -> list[int]:
    return [NEVER if c == "x" else int(c) for c in end.split(",")]


def write_costs(costs: list[int]) -> tuple[str, int]:
    """The vector less its least value, as text, and that value."""
    low = min(costs)
    return ",".join("x" if c >= NEVER else str(c - low) for c in costs), low


def state_of(candidates: list[list[tuple[int, str, int]]]) -> list[tuple[int, str, int]]:
    """(cost, first edit, grammar state behind it) per grammar state, inserts included."""
    best = [min(c) for c in candidates]
    out = list(best)
    for q in (2, 3):  # an insert leads to the other of these two, never twice in a row at a lower cost
        to = WANTS[q]
        out[q] = min(best[q], (best[to][0] + 2, "I", to))
    for q in (0, 1):
        out[q] = min(best[q], (out[2][0] + 2, "I", 2))
    return out


def before(symbol: str, after: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The automaton's state for ``symbol`` followed by the suffix whose state is ``after``."""
    role, extra = symbol.lower(), int(symbol.isupper())
    rows = []
    for q in range(4):
        edits = [(after[q][0] + 3, "D", q)]
        if symbol != "-":
            if (role, q) in KEEP:
                edits.append((after[KEEP[role, q]][0] + extra, "K", KEEP[role, q]))
            edits.append((after[WANTS[q]][0] + 2 + extra, "R", WANTS[q]))
        rows.append(edits)
    return state_of(rows)


class SuffixAutomaton:
    """States of the words given so far along the last word; words come sorted by their reversal."""

    def __init__(self):
        self.end, self.backward, self.path, self.built = None, "", [], 0

    def solve(self, word: str, end: str) -> tuple[list[int], list[str], list[int]]:
        """(cost, audit, grammar state at the end) per grammar state at the start."""
        back = word[::-1]
        if end != self.end:
            self.end, self.backward = end, ""
            self.path = [state_of([[(c, "", q)] for q, c in enumerate(read_costs(end))])]
            self.built += 1
        shared = 0
        for x, y in zip(back, self.backward):
            if x != y:
                break
            shared += 1
        del self.path[shared + 1:]
        for symbol in back[shared:]:
            self.path.append(before(symbol, self.path[-1]))
            self.built += 1
        self.backward = back
        costs, audits, exits = [], [], []
        for q in range(4):
            costs.append(min(self.path[-1][q][0], NEVER))
            letters, at, to = [], len(self.path) - 1, q
            if costs[-1] < NEVER:
                while True:
                    _, letter, nxt = self.path[at][to]
                    if letter == "":
                        break
                    letters.append(letter)
                    at, to = at - (letter != "I"), nxt
            audits.append("".join(letters))
            exits.append(to)
        return costs, audits, exits


SOLVED = "word string, end string, cost array<bigint>, audit array<string>, exit array<int>"


def solve_words(words: DataFrame) -> DataFrame:
    """Distinct (word, end) -> costs, audits and exits, each automaton state built once (again only along the
    one path that two neighbouring range partitions share)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton()
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for k in range(0, len(rows), 1000):
                part = rows[k:k + 1000]
                found = [automaton.solve(w, e) for w, e in part]
                yield pa.RecordBatch.from_arrays([
                    pa.array([w for w, _ in part], pa.string()), pa.array([e for _, e in part], pa.string()),
                    pa.array([c for c, _, _ in found], pa.list_(pa.int64())), pa.array([a for _, a, _ in found], pa.list_(pa.string())),
                    pa.array([x for _, _, x in found], pa.list_(pa.int32()))], names=["word", "end", "cost", "audit", "exit"])

    distinct = words.select("word", "end").distinct().withColumn("back", F.reverse("word"))
    return (distinct.repartitionByRange("end", "back").sortWithinPartitions("end", "back")
            .select("word", "end").mapInArrow(run, SOLVED))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rid) after the damage by crc32(``conv_id:turn``) % 20; nulls are one space.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets the role user. ``rid`` numbers the rows.
    """
    space = F.lit(" ")
    tag = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce(F.col("text"), space)
    hit = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), tag.alias("tag"),
                      F.when(tag == 4, "user").otherwise(F.coalesce(F.col("role"), space)).alias("role"),
                      F.when(tag == 1, "").when(tag == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                      F.monotonically_increasing_id().alias("rid"))
    return (hit.filter("tag <> 0")
            .withColumn("copy", F.explode(F.when(F.col("tag") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text", (F.col("rid") * 2 + F.col("copy")).alias("rid")))


def initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def with_faults(rows: DataFrame, ws: Workspace) -> DataFrame:
    """Rows plus ``content``, ``initial`` and the first fault of each: blank, duplicate, truncated or null.

    A row is a duplicate where a row with the same role and text comes earlier in its conversation.
    """
    body = F.btrim("text", F.lit(BLANKS))
    rows = ws.put(rows.select("*", content_key(F.col("role"), F.col("text")).alias("content"), initial().alias("initial"),
                              F.when(body == "", "blank").when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated").alias("own")), "damaged")
    firsts = (rows.groupBy("conv_id", "content").agg(F.min(F.struct("turn", "rid")).alias("m"))
              .select(F.col("m.rid").alias("first")))
    return rows.join(firsts, F.col("rid") == F.col("first"), "left").withColumn(
        "fault", F.when(F.col("own") == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("own"))).drop("own", "first")


def symbol() -> Column:
    return (F.when(F.col("fault").isin("blank", "duplicate"), "-")
            .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))


def solve_segments(segments: DataFrame, ws: Workspace) -> DataFrame:
    """(conv_id, seg, n_segs, word) -> (conv_id, seg, entry int, audit, cost; the cost stands at segment 0)."""
    one = segments.filter("n_segs = 1").select("conv_id", "seg", "word", F.lit(FINAL).alias("end"))
    several = segments.filter("n_segs > 1")
    units = [",".join("0" if x == y else "x" for y in range(4)) for x in range(4)]
    ends = several.select("word", F.explode(F.when(F.col("seg") == F.col("n_segs") - 1, F.array(F.lit(FINAL)))
                                            .otherwise(F.array(*map(F.lit, units)))).alias("end"))
    first = ws.put(solve_words(one.select("word", "end").unionByName(ends)), "solved")
    # segments of one conversation, folded from its end
    between = (several.join(first, "word").filter((F.col("seg") == F.col("n_segs") - 1) == (F.col("end") == FINAL))
               .groupBy("conv_id", "seg", "word").agg(F.collect_list(F.struct("end", "cost")).alias("costs")))
    folded = between.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", "word", "costs"))).alias("segs"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for conv, segs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tail, total, out = FINAL, 0, []
                for s in reversed(segs):
                    costs = {c["end"]: c["cost"] for c in s["costs"]}
                    after = read_costs(tail)
                    now = costs[FINAL] if FINAL in costs else [min(costs[units[x]][q] + after[x] for x in range(4)) for q in range(4)]
                    out.append((s["seg"], s["word"], tail))
                    tail, low = write_costs(now)
                    total += low
                total += read_costs(tail)[0]
                yield pa.RecordBatch.from_arrays([
                    pa.array([conv] * len(out), pa.int64()), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string()),
                    pa.array([x[2] for x in out], pa.string()), pa.array([total] * len(out), pa.int64())], names=["conv_id", "seg", "word", "end", "total"])

    long = ws.put(folded.mapInArrow(fold, "conv_id bigint, seg bigint, word string, end string, total bigint"), "folded")
    second = ws.put(solve_words(long), "solved-again")
    paths = long.join(second, ["word", "end"]).groupBy("conv_id", "total").agg(
        F.array_sort(F.collect_list(F.struct("seg", "exit"))).alias("segs"))
    entered = F.expr("aggregate(segs, cast(array() as array<int>), (a, s) -> concat(a, array(if(size(a) = 0, 0, segs[size(a) - 1].exit[a[size(a) - 1]]))))")
    entries = paths.select("conv_id", "total", F.posexplode(entered).alias("seg", "entry"))
    whole = (long.drop("total").join(second, ["word", "end"]).withColumnRenamed("conv_id", "c").withColumnRenamed("seg", "s")
             .join(entries, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("s") == F.col("seg")))
             .select("conv_id", F.col("s").alias("seg"), "entry", F.expr("audit[entry]").alias("audit"), F.col("total").alias("cost")))
    short = one.join(first, ["word", "end"]).select("conv_id", "seg", F.lit(0).alias("entry"), F.col("audit")[0].alias("audit"), F.col("cost")[0].alias("cost"))
    return short.unionByName(whole)


LINES = "conv_id bigint, seg bigint, at bigint, rid bigint, before string, role string"


def edited_lines(solved: DataFrame) -> DataFrame:
    """(conv_id, seg, entry, audit, rids) -> a row per kept row and one for inserts behind the last: ``before`` holds the
    inserted lines that come first, ``role`` the new role (null: its own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, seg, q, audit, rids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                row, ahead = 0, ""
                for k, letter in enumerate(audit):
                    if letter == "I":
                        q = WANTS[q]
                        ahead += ROLE_OF[q] + ":\n"
                        continue
                    rid, keep_s = rids[row]["rid"], q == 0 and rids[row]["initial"] == "s"
                    row += 1
                    if letter == "D":
                        continue
                    q = 1 if letter == "K" and keep_s else WANTS[q]
                    out.append((conv, seg, k, rid, ahead, ROLE_OF[q] if letter == "R" else None))
                    ahead = ""
                if ahead:
                    out.append((conv, seg, len(audit), None, ahead, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, [
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True)],
                names=["conv_id", "seg", "at", "rid", "before", "role"])

    return solved.select("conv_id", "seg", "entry", "audit", "rids").mapInArrow(run, LINES)


def repair_rows(rows: DataFrame, ws: Workspace, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Repairs conversations (conv_id, turn, role, text, rid; no nulls but in conv_id and turn).

    Returns (report, pieces). The report has a row per conversation: gaps, blank, duplicate, truncated, illegal, cost and
    audit. The pieces (conv_id, seg, piece) hold the repaired conversation: ``role:text`` lines of its segments in order.
    Rows go by turn (nulls first); rows of one turn by role, the text's first 64 characters, its MD5, then as they came.
    """
    faulty = ws.put(with_faults(rows, ws), "faults")
    narrow = faulty.select("conv_id", "turn", F.col("role").alias("by_role"), F.substring("text", 1, 64).alias("head"), "content", "rid",
                           "fault", "initial", symbol().alias("symbol"))
    order = ["turn", "by_role", "head", "content", "rid"]
    placed = numbered(narrow, "conv_id", order, ws, "turns").withColumn("seg", F.expr(f"pos div {segment}"))
    lists = F.array_sort(F.collect_list(F.struct("pos", "symbol", "initial", "rid")))
    segments = (placed.groupBy("conv_id", "seg").agg(lists.alias("rows"))
                .select("conv_id", "seg", F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("word"),
                        F.array_join(F.transform("rows", lambda r: r["initial"]), "").alias("initials"),
                        F.transform("rows", lambda r: F.struct(r["rid"].alias("rid"), r["initial"].alias("initial"))).alias("rids")))
    segments = ws.put(segments, "segments")
    counts = segments.groupBy("conv_id").agg(F.max("seg").alias("last")).withColumnRenamed("conv_id", "c")
    known = ws.put(segments.join(counts, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("n_segs", F.col("last") + 1).drop("c", "last"), "known")
    solved = ws.put(solve_segments(known.select("conv_id", "seg", "n_segs", "word"), ws), "audits")
    pairs = F.expr("size(filter(sequence(1, greatest(length(initials) - 1, 1)), i -> length(initials) > 1 and "
                   "substring(initials, i, 2) not in ('su', 'ua', 'au')))")
    inside = segments.groupBy("conv_id").agg(
        F.sum(pairs).alias("inside"), F.array_sort(F.collect_list(F.struct("seg", F.substring("initials", 1, 1).alias("f"), F.right("initials", F.lit(1)).alias("l")))).alias("ends"))
    seams = F.expr("size(filter(slice(zip_with(ends, slice(ends, 2, size(ends)), (x, y) -> x.l || y.f), 1, size(ends) - 1), p -> p not in ('su', 'ua', 'au')))")
    illegal = inside.select(F.col("conv_id").alias("c1"), (F.col("inside") + seams).cast("long").alias("illegal"))
    # gaps = maxTurn - minTurn + 1 - distinctTurns
    distinct = faulty.filter("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = distinct.groupBy(F.col("conv_id").alias("c2")).agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    faults = faulty.groupBy(F.col("conv_id").alias("c3")).agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    audits = solved.groupBy("conv_id").agg(F.min("cost").alias("cost"), F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "").alias("audit"))
    report = audits
    for part, key in ((illegal, "c1"), (gaps, "c2"), (faults, "c3")):
        report = report.join(part, F.col("conv_id").eqNullSafe(F.col(key)), "left").drop(key)
    report = report.select("conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    chosen = solved.withColumnsRenamed({"conv_id": "c", "seg": "s"}).join(
        segments.select("conv_id", "seg", "rids"), F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("s") == F.col("seg"))).select("conv_id", "seg", "entry", "audit", "rids")
    lines = edited_lines(chosen).join(faulty.select("rid", F.col("role").alias("own"), "text"), "rid", "left")
    line = F.when(F.col("rid").isNull(), F.expr("left(before, length(before) - 1)")).otherwise(
        F.concat("before", F.coalesce("role", "own"), F.lit(":"), "text"))
    pieces = lines.select("conv_id", "seg", "at", line.alias("line")).groupBy("conv_id", "seg").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("piece"))
    return report, ws.put(pieces, "pieces")


def repaired_conversations(conversations: DataFrame, ws: Workspace, segment: int = SEGMENT) -> DataFrame:
    """Damages the rows of ``conversations``, repairs them and reports per conv_id of the table.

    A null conv_id is a conversation too; null role, text or key parts count as one space. Roles whose initial is
    none of s, u, a (an empty role too) can't be kept. Repeated rows are rows of their own. Conversations without a row
    after the damage have zeros, an empty audit and the hash of the empty string. An empty table gives no row.
    """
    every = conversations.select("conv_id").distinct()
    report, pieces = repair_rows(damaged(conversations), ws, segment)
    shas = streamed_sha256(pieces, "conv_id", ["seg"], "piece", "\n").withColumnsRenamed({"conv_id": "p", "sha256": "repaired_sha256"})
    out = (every.withColumnRenamed("conv_id", "e").join(report, F.col("e").eqNullSafe(F.col("conv_id")), "left")
           .join(shas, F.col("e").eqNullSafe(F.col("p")), "left"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("e").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
