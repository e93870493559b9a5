"""Conversation structure repair: the cheapest edits that give every conversation the roles ``s?(ua)+`` (or no rows).

Edits and costs: Keep 0, Rerole (to user or assistant) 3, Delete 4, Insert of an empty row (user or assistant) 3; a
truncated row that stays adds 3, blank and duplicate rows have to go. Of several cheapest edit lists the one whose initials
are ASCII-least is taken.

The grammar in Chomsky normal form has one nonterminal (p, q) for every two states of a conversation (nothing yet, after
system, after user, after assistant) that rows can lead between: (p, q) -> (p, r) (r, q), and (p, q) -> row by an edit of
that row. The cell of a span holds, for each nonterminal, the least (cost, audit) pair. Insertions are a closure in front of
every row and at the end, so cells never need spans without rows. Since r runs over all states, every way to split a span
gives the same cell; so one split of each span is enough, and cells of 1, 2, 4, 8 ... rows are combined bottom-up: work and
memory grow with the rows, not with their cube. Edit lists of equal cost for one span are never prefixes of each other (more
letters would mean more insertions, hence a higher cost), so the least parts make the least whole.

Faults are found in Spark. Only one letter a row reaches the parser; texts are read again in order, a batch at a time, when
the repaired rows are put out, so a long conversation costs a task its letters and the hashes, not its texts. A conversation
is one sequence with one digest: its rows are put in order in one task (sorted with spilling).

Defined results: null role or text counts as one space. Rows go by turn (nulls first), then role, then MD5 of the text. Rows
whose role starts with none of s, u, a can be reroled or deleted. A null conv_id is a conversation of its own. Other columns
are not read, whatever their names. An empty table gives an empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabmill.llm.common import WS_CHARS, Stages

#: The costs of the edits and of a truncated row that stays.
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {NOTHING: (NOTHING, SYSTEM, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT), ASSISTANT: (USER, ASSISTANT)}
#: The productions (p, q) -> (p, r) (r, q).
RULES = [((p, q), (p, r), (r, q)) for p in _NEXT for r in _NEXT[p] for q in _NEXT[r]]

Cell = dict[tuple[int, int], tuple[int, str]]

#: Least insertions that lead from state to state.
CLOSURE: Cell = {(p, q): (INSERT * n, "I" * n) for p, q, n in [
    *[(p, p, 0) for p in _NEXT], (NOTHING, USER, 1), (NOTHING, ASSISTANT, 2), (SYSTEM, USER, 1), (SYSTEM, ASSISTANT, 2),
    (USER, ASSISTANT, 1), (ASSISTANT, USER, 1)]}


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for head, a, b in RULES:
        if a in left and b in right:
            (c, x), (d, y) = left[a], right[b]
            found = (c + d, x + y)
            if head not in out or found < out[head]:
                out[head] = found
    return out


def _row_cell(letter: str) -> Cell:
    """The edits of a row: 'd' a row that has to go, else the initial of its role ('x': none of s, u, a), in upper case if
    truncated. Insertions in front of the row are part of its cell."""
    cell: Cell = {(p, p): (DELETE, "D") for p in _NEXT}
    if letter != "d":
        extra, role = TRUNCATED if letter.isupper() else 0, letter.lower()
        if role == "s":
            cell[NOTHING, SYSTEM] = (extra, "K")
        for p, q, own in [(NOTHING, USER, "u"), (SYSTEM, USER, "u"), (ASSISTANT, USER, "u"), (USER, ASSISTANT, "a")]:
            cell[p, q] = (extra, "K") if role == own else (extra + RETYPE, "R")
    return join(CLOSURE, cell)


ROW_CELLS = {letter: _row_cell(letter) for letter in "dsuaxSUAX"}


def parse(letters: str) -> tuple[int, str]:
    """Least cost and audit of a conversation, given the letter of every row."""
    if not letters:
        return 0, ""
    cells = [ROW_CELLS[x] for x in letters]
    while len(cells) > 1:
        cells = [join(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    root = join(cells[0], CLOSURE)
    return min(root[end] for end in ((NOTHING, NOTHING), (NOTHING, ASSISTANT)) if end in root)


def _parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, tuple[int, str]] = {}
    for batch in batches:
        found = []
        for letters in batch.column("letters").to_pylist():
            if letters not in seen:
                if len(seen) > 10000:
                    seen.clear()
                seen[letters] = parse(letters)
            found.append(seen[letters])
            if len(letters) > 64:
                del seen[letters]
        keep = [i for i, name in enumerate(batch.schema.names) if name != "letters"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in keep], pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            [*[batch.schema.names[i] for i in keep], "cost", "audit"])


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def faults(rows: DataFrame) -> DataFrame:
    """The rows in order: conv_id, n (from 1), turn, role, text, fault (blank, duplicate, truncated or null), illegal (its
    initial and that of the row before it are not su, ua or au) and letter (what the parser reads)."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("h", F.md5("text")).withColumn("body", F.rtrim("text", F.lit(WS_CHARS)))
    same = Window.partitionBy("conv_id", "role", "h").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("copy", F.row_number().over(same))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "h", "copy")
    before = F.lag("role").over(order)
    fault = (F.when(F.col("body") == "", "blank").when(F.col("copy") > 1, "duplicate")
             .when(~F.right("body", F.lit(1)).isin(".", "!", "?"), "truncated"))
    first = F.when(_initial(F.col("role")).isin("s", "u", "a"), _initial(F.col("role"))).otherwise("x")
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("n"), "turn", "role", "text", fault.alias("fault"),
        (before.isNotNull() & ~F.concat(_initial(before), _initial(F.col("role"))).isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(order))).alias("new_turn"))
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(first)).otherwise(first)
    return rows.withColumn("letter", letter)


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``faults``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    count = lambda c: F.count_if(c).cast("long")
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "letter"))), lambda x: x["letter"]), "")
    per = rows.groupBy("conv_id").agg(
        F.coalesce((F.max("turn") - F.min("turn") + 1 - count(F.col("new_turn"))).cast("long"), F.lit(0)).alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"), letters.alias("letters"))
    names = per.columns[:-1]
    types = {f.name: f.dataType.simpleString() for f in per.schema}
    return per.mapInArrow(_parse_all, ", ".join(f"{n} {types[n]}" for n in names) + ", cost long, audit string")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None, None) at the start of a conversation, then (conv_id, role, text) of its repaired rows. A conversation
    comes as its audit (n = 0), then its rows in order."""
    audit, at, place = "", 0, 0

    def new_rows(conv, upto_row: bool):
        """The rows inserted before the next edit of a given row."""
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield conv, ("user", "assistant")[place % 2], ""
            at, place = at + 1, place + 1

    conv = None
    for batch in batches:
        for conv_now, n, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "n", "role", "text")]):
            if n == 0:
                yield from new_rows(conv, False)
                conv, audit, at, place = conv_now, text, 0, 0
                yield conv, None, None
                continue
            yield from new_rows(conv, True)
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                yield conv, role, text
                continue
            yield conv, role if edit == "K" else ("user", "assistant")[place % 2], text
            place += 1
    yield from new_rows(conv, False)


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size >= limit:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def _rows(key: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbered():
            n = 0
            for conv, role, text in _replay(batches):
                n = 0 if role is None else n + 1
                if role is not None:
                    yield conv, n, role, text
        yield from _batches(numbered(), pa.schema([("conv_id", key), ("n", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
    return run


def _digests(key: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digested():
            conv, state, empty = None, None, True
            for conv_now, role, text in _replay(batches):
                if role is None:
                    if state is not None:
                        yield conv, state.hexdigest()
                    conv, state, empty = conv_now, hashlib.sha256(), True
                else:
                    state.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            if state is not None:
                yield conv, state.hexdigest()
        yield from _batches(digested(), pa.schema([("conv_id", key), ("repaired_sha256", pa.string())]))
    return run


def _stream(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows, conversation by conversation."""
    audits = done.select("conv_id", F.lit(0).alias("n"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = rows.select("conv_id", "n", "role", "text").unionByName(audits)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "n")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (conv_id, turn, role, text): the report of every conversation; the repaired rows (conv_id, n, role, text);
    and (conv_id, repaired_sha256) of the repaired ``role:text`` lines."""
    from pyspark.sql.pandas.types import to_arrow_type
    stages = Stages(rows.sparkSession, "conversation-repair")
    marked = stages.write(faults(rows.select("conv_id", "turn", "role", "text")), "rows")
    done = stages.write(report(marked), "report")
    key, name = to_arrow_type(rows.schema["conv_id"].dataType), rows.schema["conv_id"].dataType.simpleString()
    stream = _stream(marked, done)
    return (done, stream.mapInArrow(_rows(key), f"conv_id {name}, n long, role string, text string"),
            stream.mapInArrow(_digests(key), f"conv_id {name}, repaired_sha256 string"))
