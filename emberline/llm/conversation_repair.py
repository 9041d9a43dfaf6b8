"""Operator 13, conversation structure repair: a dynamic program over the turns that stay, with gaps priced by prefix sums."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import running_totals, table

#: Prices of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows and code points of the segments into which conversations are cut.
SEGMENT_ROWS, SEGMENT_POINTS = 1024, 1 << 22

_WHITE = " \t\n\x0b\x0c\r"
#: Role initials after each other that aren't illegal.
_LEGAL = frozenset(("su", "ua", "au"))
#: Output so far: nothing yet, or the last role's initial. Inserts between it and the next kept or reroled turn's role.
STATES = ("", "s", "u", "a")
_INSERTS = {("", "s"): "", ("", "u"): "", ("", "a"): "u", ("s", "u"): "", ("s", "a"): "u", ("u", "a"): "", ("u", "u"): "a", ("a", "u"): "", ("a", "a"): "u"}
#: Inserts that end a conversation.
_ENDS = {"": "", "s": "ua", "u": "a", "a": ""}
_ROLES = {"u": "user", "a": "assistant"}

#: Faults of rows, by their first one.
SOUND, BLANK, DUPLICATE, CUT = range(4)


def _kinds(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) that damage leaves, with its ``kind`` by a checksum of conversation and turn, and ``copy`` (1 for a repeated row).

    Null roles and texts count as one space, null ids and turns likewise in the checksum.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20)).cast("int")
    each = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return each.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def _damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with the role and text that their ``kind`` leaves."""
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.withColumns({"role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "text": text})


def retained(codes: list[tuple[str, int]], start: str) -> dict[str, tuple[int, str]]:
    """For each last output: (least cost, ASCII-least audit) of a segment's rows, whose output so far ends with ``start``.

    codes: (role initial, fault) per row. A turn that stays, kept or reroled, is priced by the least sum of a turn before it,
    the deletions between them, a difference of prefix sums, and the inserts that the two roles need. Per last role
    only the running minimum of cost less prefix sum is kept. Of audits that cost the same the least stays; within a gap
    deletions stand before inserts. Equal costs mean that neither audit begins with the other, so the order holds for
    all that follows.
    """
    deleted = 0  # prefix sum of deletions
    best = {start: (0, "", 0)}  # cost less prefix sum, audit, rows that the audit covers
    for at, (initial, fault) in enumerate(codes):
        if fault not in (BLANK, DUPLICATE):
            due = TRUNCATED if fault == CUT else 0
            now: dict[str, tuple[int, str]] = {}
            for role in ("s", "u", "a"):
                if role == initial:
                    price, letter = due, "K"
                elif role != "s":
                    price, letter = due + REROLE, "R"
                else:
                    continue
                for before, (cost, audit, rows) in best.items():
                    inserts = _INSERTS.get((before, role))
                    if inserts is None:
                        continue
                    whole = cost + deleted + INSERT * len(inserts) + price
                    if role in now and now[role][0] < whole:
                        continue
                    one = (whole, audit + "D" * (at - rows) + "I" * len(inserts) + letter)
                    if role not in now or one < now[role]:
                        now[role] = one
            deleted += DELETE
            for role, (cost, audit) in now.items():
                one = (cost - deleted, audit, at + 1)
                if role not in best or one[0] < best[role][0] or one[0] == best[role][0] and audit < best[role][1] + "D" * (at + 1 - best[role][2]):
                    best[role] = one
        else:
            deleted += DELETE
    return {role: (cost + deleted, audit + "D" * (len(codes) - rows)) for role, (cost, audit, rows) in best.items()}


def joined(tables: list[dict[str, dict[str, tuple[int, str]]]]) -> dict[str, dict[str, tuple[int, str]]]:
    """The table (output before -> output after -> cost and audit) of segments in order, put together pairwise."""
    while len(tables) > 1:
        nexts = []
        for left, right in zip(tables[::2], tables[1::2]):
            both: dict[str, dict[str, tuple[int, str]]] = {}
            for start, mids in left.items():
                out = both[start] = {}
                for mid, (cost, audit) in mids.items():
                    for end, (more, rest) in right.get(mid, {}).items():
                        if end not in out or cost + more < out[end][0] or cost + more == out[end][0] and audit + rest < out[end][1]:
                            out[end] = (cost + more, audit + rest)
            nexts.append(both)
        tables = nexts + tables[len(tables) // 2 * 2 :]
    return tables[0]


def apply_audit(audit: str, last: str, rows: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], str]:
    """(turns, last role's initial) of a segment's rows (role, text) after its edits. A trailing insert belongs to the audit of the last segment."""
    turns, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = rows[at] if edit != "I" else ("", "")
        at += edit != "I"
        if edit != "K":
            role = _ROLES["a" if last == "u" else "u"]
        turns.append((role, text))
        last = role[:1]
    return turns, last


def _segments(conversations: DataFrame, id_column: str) -> DataFrame:
    """(conv, first, rows): conversations after damage, cut into segments of rows in order; first is the first row's number over all.

    rows: struct (at, turn, role, text, fault). Rows are numbered in one sort over all conversations, so a conversation of a
    third of all rows lies in many tasks; segments are its stretches of SEGMENT_ROWS rows and SEGMENT_POINTS code points.
    """
    rows = _kinds(conversations.select(F.col(id_column).alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"))
    rows = rows.withColumns({"points": F.length("text").cast("long"), "tie": F.monotonically_increasing_id()})
    sorted_ = running_totals(rows, ["conv_id", "turn", "role", "text", "tie", "copy"], "points")
    numbered = table(_damaged(sorted_).withColumn("digest", F.sha2("text", 256)).select("conv_id", "turn", "role", "text", "digest", "row_index", "before"))
    same = ["conv_id", "role", "digest"]
    firsts = numbered.groupBy(*same).agg(F.min("row_index").alias("first_at"), F.count("*").alias("c")).where("c > 1").withColumnsRenamed({c: f"_{c}" for c in same})
    is_same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    again = numbered.select(*same, "row_index").join(table(firsts), is_same).where("row_index > first_at").select(F.col("row_index").alias("again"))
    marked = numbered.join(again, F.col("row_index") == F.col("again"), "left")
    last = F.right(F.rtrim("text", F.lit(_WHITE)), F.lit(1))
    fault = F.when(last == "", BLANK).when(F.col("again").isNotNull(), DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(SOUND)
    one = F.struct(F.col("row_index").alias("at"), "turn", "role", "text", fault.cast("int").alias("fault"))
    stretch = [F.floor(F.col("row_index") / SEGMENT_ROWS).alias("a"), F.floor(F.col("before") / SEGMENT_POINTS).alias("b")]
    cut = marked.groupBy("conv_id", *stretch).agg(F.array_sort(F.collect_list(one)).alias("rows"))
    return table(cut.select(F.col("conv_id").alias("conv"), F.col("rows")[0]["at"].alias("first"), "rows"))


_TABLE = "array<struct<before:string,after:string,cost:long,audit:string>>"
_SUMS = "blank long, duplicate long, truncated long, illegal long, turns long, least long, most long"
_STRETCH = f"first long, n long, initial string, final string, {_SUMS}, paths {_TABLE}"


def _priced(segments: DataFrame) -> DataFrame:
    """One row per segment: its table of the :func:`retained` program for each output before it, and sums over its rows."""
    names = [f.split()[0] for f in _STRETCH.split(", ")]

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            for first, rows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                codes = [(r["role"][:1], r["fault"]) for r in rows]
                turns = [r["turn"] for r in rows if r["turn"] is not None]
                faults = [f for _, f in codes]
                paths = [{"before": s, "after": e, "cost": c, "audit": a} for s in STATES for e, (c, a) in retained(codes, s).items()]
                illegal = sum(a + b not in _LEGAL for (a, _), (b, _) in zip(codes, codes[1:]))
                values = (first, len(rows), codes[0][0], codes[-1][0], faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, len(set(turns)), min(turns, default=None), max(turns, default=None), paths)
                for k, v in zip(names, values):
                    out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 7, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[k], t) for k, t in zip(names, kinds))], names=["conv", *names])

    codes_only = segments.select("conv", "first", F.transform("rows", lambda r: F.struct(r["turn"].alias("turn"), r["role"].alias("role"), r["fault"].alias("fault"))).alias("rows"))
    return codes_only.mapInArrow(run, f"conv {_kind(segments)}, {_STRETCH}")


def _kind(df: DataFrame) -> str:
    return df.schema["conv"].dataType.simpleString()


def _solved(priced: DataFrame) -> DataFrame:
    """One row per conversation: sums, the cheapest edits, and of each segment the output before it and its piece of the audit."""
    sums = ["blank", "duplicate", "truncated", "illegal"]

    def solve(parts: list[dict]) -> tuple:
        parts.sort(key=lambda p: p["first"])
        tables = []
        for p in parts:
            one: dict[str, dict] = {}
            for x in p["paths"]:
                one.setdefault(x["before"], {})[x["after"]] = (x["cost"], x["audit"])
            tables.append(one)
        ends = [(cost + INSERT * len(_ENDS[e]), audit + "I" * len(_ENDS[e])) for e, (cost, audit) in joined(tables)[""].items()]
        cost, audit = min(ends)
        total = {k: sum(p[k] for p in parts) for k in sums}
        total["illegal"] += sum(a["final"] + b["initial"] not in _LEGAL for a, b in zip(parts, parts[1:]))
        # turns are in order, so a turn that two segments share is the last of one and the first of the next with any
        some = [p for p in parts if p["least"] is not None]
        turns = sum(p["turns"] for p in some) - sum(a["most"] == b["least"] for a, b in zip(some, some[1:]))
        gaps = some[-1]["most"] - some[0]["least"] + 1 - turns if some else 0
        pieces, at = [], 0
        for p in parts:
            left, begin = p["n"], at
            while left:
                left -= audit[at] != "I"
                at += 1
            pieces.append(audit[begin:at])
        pieces[-1] += audit[at:]
        return gaps, *total.values(), cost, audit, [{"first": p["first"], "audit": x} for p, x in zip(parts, pieces)]

    def run(batches):
        for batch in batches:
            done = [solve(parts) for parts in batch.column(1).to_pylist()]
            kinds = [*[pa.int64()] * 6, pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("audit", pa.string())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([d[i] for d in done], k) for i, k in enumerate(kinds))], names=["conv", "gaps", *sums, "cost", "audit", "pieces"])

    stretch = [c for c in priced.columns if c != "conv"]
    whole = priced.groupBy("conv").agg(F.collect_list(F.struct(*stretch)).alias("parts"))
    return table(whole.mapInArrow(run, f"conv {_kind(priced)}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<struct<first:long,audit:string>>"))


def _pieces(segments: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv, first, rows, audit): segments with their pieces of the audits, each conversation's in order within one partition."""
    pieces = solved.select(F.explode("pieces").alias("p")).select(F.col("p.first").alias("first"), F.col("p.audit").alias("audit"))
    both = segments.join(pieces, "first").select("conv", "first", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("rows"), "audit")
    return both.repartition("conv").sortWithinPartitions("conv", "first")


def _walked(batches):
    """For each segment in order: (conversation, whether another one begins, its repaired turns)."""
    began, conv, last = False, None, ""
    for batch in batches:
        for now, rows, audit in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            new = not began or now != conv
            turns, last = apply_audit(audit, "" if new else last, [(r["role"], r["text"]) for r in rows])
            began, conv = True, now
            yield now, new, turns


def _digests(segments: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv, repaired_sha256). A conversation is hashed as it streams by, so none is held in memory."""

    def run(batches):
        kind, out, conv, state, more = None, ([], []), None, None, False
        names = ["conv", "repaired_sha256"]

        def first_kind():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for now, new, turns in _walked(first_kind()):
            if new:
                if state is not None:
                    out[0].append(conv)
                    out[1].append(state.hexdigest())
                conv, state, more = now, hashlib.sha256(), False
            for role, text in turns:
                state.update((("\n" if more else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                more = True
            if len(out[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], kind), pa.array(out[1])], names=names)
                out = ([], [])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([*out[0], conv], kind), pa.array([*out[1], state.hexdigest()])], names=names)

    return _pieces(segments, solved).mapInArrow(run, f"conv {_kind(segments)}, repaired_sha256 string")


def repaired_turns(conversations: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(conv_id, place, role, text): the turns of the repaired conversations, numbered from 0. Rules as in :func:`repair`."""
    segments = _segments(conversations, id_column)

    def run(batches):
        kind, place = None, 0

        def first_kind():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for now, new, turns in _walked(first_kind()):
            place = 0 if new else place
            roles, texts = [r for r, _ in turns], [t for _, t in turns]
            yield pa.RecordBatch.from_arrays(
                [pa.array([now] * len(turns), kind), pa.array(range(place, place + len(turns)), pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["conv", "place", "role", "text"]
            )
            place += len(turns)

    out = _pieces(segments, _solved(_priced(segments))).mapInArrow(run, f"conv {_kind(segments)}, place long, role string, text string")
    return out.withColumnRenamed("conv", id_column)


def repair(conversations: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """One row per conversation (conv_id, null too): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged first (see :func:`_kinds`), then taken by turn, nulls first; rows of one turn by their role and text
    before damage, so that rows that are equal in all may stand in any order. A row's first fault counts: blank, duplicate
    (role and text stood before), truncated. The edits are the cheapest whose role initials are (s?(ua)+)?, of these the
    ASCII-least audit. A conversation that loses all its rows has zeros, an empty audit and the hash of an empty string.
    Other columns are ignored; an empty table gives no rows.

    Conversations are cut into segments; a segment's cheapest edits for each output before it don't depend on other
    segments, so all are priced in parallel and put together per conversation, where only costs and audits meet. Texts
    meet their piece of the audit in one more exchange.
    """
    segments = _segments(conversations, id_column)
    solved = _solved(_priced(segments))
    ids = conversations.select(F.col(id_column).alias("conv_id")).distinct()
    renamed = solved.drop("pieces").withColumnRenamed("conv", "_a")
    digests = _digests(segments, solved).withColumnRenamed("conv", "_b")
    out = ids.join(renamed, F.col("conv_id").eqNullSafe(F.col("_a")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("_b")), "left")
    zero = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zero), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
