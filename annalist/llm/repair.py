"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A repaired conversation is empty, or an optional system row followed by pairs of user and assistant. Each row may be
kept (K, 0), get the role that is due (R, 1) or go (D, 2); an empty row with the role that is due may be put in
anywhere (I, 5). Rows without a visible character and rows that were there before must go. A row whose text stops
without a full stop costs 5 more unless it goes. Of the cheapest edits the one with the ASCII-least letters counts.

A search looks at one byte per row only. Texts stay in Spark: they are sorted by conversation, and pass through
twice as a stream, once as digests for the search and once for the repaired rows. So the longest
conversation costs a task a digest and a few numbers per row, never its texts.

Defined cases: null roles and texts are one space; null turns come first; rows of one turn are ordered by role and
text; a null ``conv_id`` is a conversation of its own; an empty table gives empty tables; other columns are ignored.
A conversation all of whose rows are ``absent`` has no repaired rows, zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.words import batched, partitions_for, ship
from annalist.session import materialize

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: what was written last: nothing, system, user, assistant
START, SYSTEM, USER, ASSISTANT = range(4)
#: the role that is due next, by what was written last; at the start a system row may be kept as well
DUE = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: a row for the search: 4 * what it is (0: no role of ours) + 2 if it must go + 1 if it is cut off
MUST_GO, IS_CUT = 2, 1
_FAR = 1 << 60


class Prefix:
    """The edits up to a node, as a chain that prefixes share."""

    __slots__ = ("before", "letter", "depth")

    def __init__(self, before: Prefix | None, letter: str) -> None:
        self.before, self.letter = before, letter
        self.depth = before.depth + 1 if before else 0

    def less(self, other: Prefix) -> bool:
        """Whether these letters come first; looks back to the last common edit only."""
        a, b, shorter = self, other, self.depth < other.depth
        while a.depth > b.depth:
            a = a.before
        while b.depth > a.depth:
            b = b.before
        if a is b:
            return shorter
        while a.before is not b.before:
            a, b = a.before, b.before
        return a.letter < b.letter if a.letter != b.letter else shorter

    def chain(self) -> list[Prefix]:
        out, at = [], self
        while at is not None:
            out.append(at)
            at = at.before
        return out[::-1]


def _edits(code: int, last: int) -> list[tuple[int, str, int]]:
    """What may be done with a row: cost, letter, and what is written last then."""
    out = [(DELETE, "D", last)]
    if not code & MUST_GO:
        extra, role, due = CUT_OFF * (code & IS_CUT), code >> 2, DUE[last]
        if role == due or (role == SYSTEM and last == START):
            out.append((KEEP + extra, "K", role))
        if role != due:
            out.append((REROLE + extra, "R", due))
    return out


def _suffix_bounds(codes: bytes) -> list[tuple[int, ...]]:
    """For each row and role due, the least that the rows from there on cost, whatever the letters.

    Bounds that forget the role that is due now and then are weaker: their gap adds up along a conversation, and on 4,000
    rows the search did not end within minutes. These leave it the order of the letters and the proof.
    """
    after = (0, 2 * INSERT, INSERT, 0)  # what is missing at the end
    bounds = [after]
    for i in range(len(codes) - 1, -1, -1):
        now = [min(c + after[q] for c, _, q in _edits(codes[i], last)) for last in range(4)]
        for _ in range(2):  # an insert leads to another role that is due
            now = [min(now[q], INSERT + now[DUE[q]]) for q in range(4)]
        after = tuple(now)
        bounds.append(after)
    return bounds[::-1]


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the best edits, by depth-first branch and bound.

    A node is a row and what was written last. Its table holds the best prefix that reached it: prefixes that cost more, or as much
    with later letters, are cut off, as are those whose bound exceeds the incumbent. When the stack is empty the
    incumbent is proved.
    """
    n, bounds = len(codes), _suffix_bounds(codes)
    best: list[list[tuple[int, Prefix | None]]] = [[(_FAR, None)] * 4 for _ in range(n + 1)]
    incumbent, path = _FAR, []
    root = Prefix(None, "")
    best[0][START] = (0, root)
    stack = [(0, START, 0, root)]
    while stack:
        i, last, cost, prefix = stack.pop()
        if best[i][last][1] is not prefix:
            continue  # a better prefix has reached the node
        bound = cost + bounds[i][last]
        if bound > incumbent or (bound == incumbent and not _may_be_less(prefix, path)):
            continue
        if i == n and last in (START, ASSISTANT):
            if cost < incumbent or (cost == incumbent and prefix.less(path[-1])):
                incumbent, path = cost, prefix.chain()
            continue
        moves = [(c, x, i + 1, q) for c, x, q in _edits(codes[i], last)] if i < n else []
        moves.append((INSERT, "I", i, DUE[last]))
        found = []
        for step, letter, j, q in moves:
            total = cost + step
            known, least = best[j][q]
            if total > known or total + bounds[j][q] > incumbent:
                continue
            child = Prefix(prefix, letter)
            if total == known and not child.less(least):
                continue
            best[j][q] = (total, child)
            found.append((total + bounds[j][q], letter, (j, q, total, child)))
        found.sort(key=lambda f: f[:2], reverse=True)  # the most promising one is looked at first
        stack.extend(f[2] for f in found)
    return incumbent, "".join(p.letter for p in path)


def _may_be_less(prefix: Prefix, path: list[Prefix]) -> bool:
    """Whether edits that begin like ``prefix`` may come before the incumbent's."""
    same = path[min(prefix.depth, len(path) - 1)]
    return prefix is same or prefix.less(same)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the checksum of conversation and turn; dropped ones are ``absent``."""
    blank_null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank_null("conv_id"), blank_null("turn")).cast("binary")) % 20
    text = blank_null("text")
    broken = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(blank_null("role")).alias("role"),
        broken.alias("text"),
        (kind == 0).alias("absent"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _rows(conversations: DataFrame) -> DataFrame:
    space = F.lit(" ")
    absent = F.coalesce("absent", F.lit(False)) if "absent" in conversations.columns else F.lit(False)
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.when(~absent, F.coalesce("role", space)), F.lit("")).alias("role"),
        F.coalesce(F.when(~absent, F.coalesce("text", space)), F.lit("")).alias("text"),
        absent.alias("absent"),
    )


def _in_order(rows: DataFrame, parts: int, *first: str) -> DataFrame:
    """Conversations whole and in order, one after the other within a partition."""
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "text")


def _search_columns() -> list[Column]:
    """What the search needs of a row; the digest tells repeated rows."""
    visible = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    blank = F.length(visible) == 0
    cut = ~F.substring(visible, -1, 1).isin(".", "!", "?")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return [
        F.col("conv_id"),
        F.col("turn"),
        F.substring("role", 1, 1).alias("initial"),
        blank.alias("blank"),
        cut.alias("cut"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        F.col("absent"),
    ]


_FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """What is kept of a conversation while its rows pass."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.codes, self.seen, self.turns = conv_id, bytearray(), set(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last: str | None = None

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, digest: bytes) -> None:
        repeated = digest in self.seen
        self.seen.add(digest)
        if turn is not None:
            self.turns.add(turn)
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut and not blank and not repeated
        flags = MUST_GO if blank or repeated else IS_CUT * cut
        self.codes.append(4 * INITIAL.get(initial, 0) + flags)

    def figures(self) -> tuple:
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        cost, audit = cheapest_edits(bytes(self.codes))
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def repair_plans(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, and cost and letters of the best edits.

    Takes ``conv_id, turn, role, text`` and, if there is one, ``absent``: such rows only name their conversation. Gives ``conv_id``, ``gaps``
    (turns missing between the first and the last), ``blank``, ``duplicate``, ``truncated`` (rows by their first fault), ``illegal``
    (neighbours whose roles may not follow each other), ``cost`` and ``audit``.
    """
    ship(conversations.sparkSession)
    rows = _rows(conversations)
    parts = partitions_for(rows.sparkSession, conversations.count(), 200_000)
    id_type = rows.schema["conv_id"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved() -> Iterator[tuple]:
            now: _Conversation | None = None
            for batch in batches:
                for conv_id, *row, absent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            yield now.figures()
                        now = _Conversation(conv_id)
                    if not absent:
                        now.add(*row)
            if now is not None:
                yield now.figures()

        numbers = [pa.field(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        schema = pa.schema([pa.field("conv_id", arrow_id), *numbers, pa.field("audit", pa.string())])
        yield from batched(solved(), schema)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)
    narrow = _in_order(rows, parts).select(*_search_columns())
    return narrow.mapInArrow(search, f"conv_id {id_type.simpleString()}, {_FIGURES}")


def repaired_rows(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit, role, text``.

    ``edit`` tells what was done (K, R or I). Within a partition, conversations are whole, one after
    the other and in order.
    """
    ship(conversations.sparkSession)
    present = _rows(conversations).filter(~F.col("absent")).drop("absent")
    parts = partitions_for(present.sparkSession, conversations.count(), 200_000)
    both = present.unionByName(plans.select("conv_id", "audit"), allowMissingColumns=True)
    both = both.withColumn("_row", F.col("audit").isNull())
    id_type = present.schema["conv_id"].dataType

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written() -> Iterator[tuple]:
            conv_id, audit, at, last, position = None, "", 0, START, 0
            for batch in batches:
                for c, role, text, plan in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    if plan is not None:
                        conv_id, audit, at, last, position = c, plan, 0, START, 0
                    else:
                        letter = audit[at]
                        at += 1
                        if letter != "D":
                            last = INITIAL[role[0]] if letter == "K" else DUE[last]
                            yield conv_id, position, letter, role if letter == "K" else ROLE[last], text
                            position += 1
                    while at < len(audit) and audit[at] == "I":
                        last = DUE[last]
                        yield conv_id, position, "I", ROLE[last], ""
                        at, position = at + 1, position + 1

        texts = [pa.field(c, pa.string()) for c in ("edit", "role", "text")]
        yield from batched(written(), pa.schema([pa.field("conv_id", arrow_id), pa.field("position", pa.int64()), *texts]), 1024)

    ordered = _in_order(both, parts, "_row").select("conv_id", "role", "text", "audit")
    return ordered.mapInArrow(edit, f"conv_id {id_type.simpleString()}, position long, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines ``role:text``, of rows in the order that ``repaired_rows`` gives."""
    id_type = repaired.schema["conv_id"].dataType

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums() -> Iterator[tuple]:
            now, sha = None, None
            for batch in batches:
                for c, position, role, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    if position == 0:
                        if sha is not None:
                            yield now, sha.hexdigest()
                        now, sha = c, hashlib.sha256()
                    else:
                        sha.update(b"\n")
                    sha.update(f"{role}:{text}".encode())
            if sha is not None:
                yield now, sha.hexdigest()

        yield from batched(sums(), pa.schema([pa.field("conv_id", arrow_id), pa.field("repaired_sha256", pa.string())]))

    lines = repaired.select("conv_id", "position", "role", "text")
    return lines.mapInArrow(add_up, f"conv_id {id_type.simpleString()}, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The plans with the digest of the repaired conversation; of no rows it is that of the empty text."""
    plans = materialize(repair_plans(conversations), "repair-plans")
    found = digests(repaired_rows(conversations, plans)).withColumnRenamed("conv_id", "_conv_id")
    joined = plans.join(found, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(nothing)))
