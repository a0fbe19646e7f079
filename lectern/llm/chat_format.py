"""Chat formatting: a hidden Markov model finds the turns of a transcript, which are then rendered in one canonical form.

A transcript is a table of lines (conv_id, line_no, line). The states are the first and the further lines of a turn of each role. A line
shows a symbol: the kind of its speaker marker ("User:", "Assistant:", "System:", an unknown "Name:", or none) with the class of its
length. Initial, transition and emission probabilities are counted, with add-one smoothing, from transcripts whose roles are known
(`fit`; the counts are sums of a fixed number of cells). Viterbi then recovers the states.

A transcript may be of any length, and one may hold most lines: all lines are numbered densely (`number_lines`, by ranges, so that no
conversation meets in one task) and cut into blocks of BLOCK_LINES numbers, and a block's best paths between any two states are one matrix
(maximum in place of sum, sum in place of product). First tasks make the matrices of their blocks, then one small pass over each
transcript's matrices fixes the states at the block bounds, then each block is decoded between them; the result is the Viterbi path of
the whole. Turns that cross a bound carry the number of their first line over, and so does the state before a block when states are counted.

A rendered turn is "<|role|>", its text without the marker, and "<|end|>", each on a line of its own.

Defined results: a null line counts as empty; rows of a null conv_id are one transcript; rows of a null line_no are left out; of rows with one line_no the
smaller text comes first, and repeated rows are lines of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_position
from .common import materialise

ROLES = ("system", "user", "assistant")
#: State 2r begins a turn of role r, state 2r + 1 goes on with it.
STATES = 2 * len(ROLES)
#: What a marker may be called, by role.
MARKERS = {"system": ("system", "sys", "instructions"), "user": ("user", "human", "question", "q", "customer"), "assistant": ("assistant", "ai", "bot", "answer", "a", "agent")}
#: A marker: the speaker, perhaps after # or between < >, then a colon.
MARKER = r"^\s*(?:#+\s*|<)?([A-Za-z][A-Za-z ]{0,18}?)>?\s*:\s*"
LENGTHS = (1, 40, 120, 400)
SYMBOLS = (len(ROLES) + 2) * (len(LENGTHS) + 1)
BLOCK_LINES = 1 << 12
_MARKER = re.compile(MARKER)
_KIND = {name: r for r, role in enumerate(ROLES) for name in MARKERS[role]}


def symbol(line: str) -> int:
    """Kind of marker (role, other, none) and class of length."""
    found = _MARKER.match(line)
    kind = len(ROLES) + 1 if not found else _KIND.get(found[1].lower(), len(ROLES))
    return kind * (len(LENGTHS) + 1) + sum(len(line) >= n for n in LENGTHS)


class Hmm:
    """Logarithms of the initial, transition and emission probabilities."""

    def __init__(self, initial: np.ndarray, step: np.ndarray, emission: np.ndarray):
        self.initial, self.step, self.emission = initial, step, emission

    @classmethod
    def counted(cls, initial: np.ndarray, step: np.ndarray, emission: np.ndarray) -> Hmm:
        """From counts. A transcript begins a turn, and only the role of the line before goes on: other paths are ruled out."""
        may_start = np.arange(STATES) % 2 == 0
        may_step = may_start[None, :] | (np.arange(STATES)[:, None] // 2 == np.arange(STATES)[None, :] // 2)
        with np.errstate(divide="ignore"):
            a, b = np.log((initial + 1) * may_start), np.log((step + 1) * may_step)
        c = np.log(emission + 1)
        norm = lambda x: x - np.logaddexp.reduce(x, axis=-1, keepdims=True)
        return cls(norm(a), norm(b), norm(c))

    def matrix(self, symbols: list[int]) -> np.ndarray:
        """[i, j]: best log probability of the block's lines, ending in j, after state i on the line before."""
        out = np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)
        for s in symbols:
            out = (out[:, :, None] + self.step[None]).max(1) + self.emission[:, s]
        return out

    def first(self, symbols: list[int]) -> np.ndarray:
        """The same for the first block: best log probability of ending in each state."""
        v = self.initial + self.emission[:, symbols[0]]
        for s in symbols[1:]:
            v = (v[:, None] + self.step).max(0) + self.emission[:, s]
        return v

    def path(self, symbols: list[int], before: int, last: int) -> list[int]:
        """States of the block's lines, the last one given; before: the state of the line before, or -1."""
        v = (self.initial if before < 0 else self.step[before]) + self.emission[:, symbols[0]]
        back = []
        for s in symbols[1:]:
            through = v[:, None] + self.step
            back.append(through.argmax(0))
            v = through.max(0) + self.emission[:, s]
        out = [last]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def number_lines(lines: DataFrame) -> DataFrame:
    """conv_id, line_no, line, symbol, pos (dense, over all transcripts in the order of their ids), and state if lines have it."""
    more = ["state"] if "state" in lines.columns else []
    rows = lines.where(F.col("line_no").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("line_no").cast("long").alias("line_no"), F.coalesce("line", F.lit("")).alias("line"), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("symbol", pa.array([symbol(x) for x in batch.column(2).to_pylist()], pa.int32()))

    schema = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes) + ", symbol int"
    return with_position(rows.mapInArrow(run, schema), [F.col("conv_id"), F.col("line_no"), F.col("line"), *map(F.col, more)], "pos")


def _numbered(lines: DataFrame) -> DataFrame:
    return lines if "pos" in lines.columns else number_lines(lines)


def fit(lines: DataFrame, block_lines: int = BLOCK_LINES) -> Hmm:
    """From lines with a column `state` (conv_id, line_no, line, state): counts of a fixed number of cells come to the driver."""
    rows = _numbered(lines.where(F.col("state").isNotNull())).where(F.col("state").isNotNull()).select("conv_id", "pos", "state", "symbol", F.floor(F.col("pos") / F.lit(block_lines)).alias("block"))
    # the line before stands in the same block but for a block's first line: then it is the last of a block before, one row for each
    last = rows.groupBy("block").agg(F.max_by(F.struct("conv_id", "state"), "pos").alias("end"))
    carried = last.select(F.col("block").alias("b"), F.lag("end").over(Window.orderBy("block")).alias("carried"))
    within = F.lag(F.struct("conv_id", "state")).over(Window.partitionBy("block").orderBy("pos"))
    known = rows.withColumn("within", within).join(carried, F.col("block") == F.col("b")).withColumn("prior", F.coalesce("within", "carried"))
    before = F.when(F.col("prior").isNotNull() & F.col("conv_id").eqNullSafe(F.col("prior.conv_id")), F.col("prior.state"))
    seen = known.select("state", "symbol", before.alias("before")).groupBy("state", "symbol", "before").count().collect()
    initial, step, emission = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, SYMBOLS))
    for row in seen:
        emission[row["state"], row["symbol"]] += row["count"]
        if row["before"] is None:
            initial[row["state"]] += row["count"]
        else:
            step[row["before"], row["state"]] += row["count"]
    return Hmm.counted(initial, step, emission)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Runs of rows that are equal in the first `keys` columns of sorted batches."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != now:
                if rows:
                    yield now, rows
                now, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield now, rows


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def _in_runs(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _table(held, names, kinds)
            held = []
    yield _table(held, names, kinds)


def recover_states(lines: DataFrame, model: Hmm, block_lines: int = BLOCK_LINES) -> DataFrame:
    """conv_id, line_no, line, pos, state, block: the Viterbi path of each transcript."""
    rows = _numbered(lines).select("conv_id", F.floor(F.col("pos") / F.lit(block_lines)).alias("block"), "pos", "symbol", "line_no", "line")
    i64, f64 = pa.int64(), pa.list_(pa.float64())

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for (conv_id, block), own in _groups(batches, 2):
                found = [x[1] for x in own]
                yield conv_id, block, model.first(found).tolist(), model.matrix(found).ravel().tolist()

        yield from _in_runs(each(), ["conv_id", "block", "first", "matrix"], [i64, i64, f64, f64], 512)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for (conv_id,), own in _groups(batches, 1):
                best = [np.array(own[0][1])]
                steps = [np.array(x[2]).reshape(STATES, STATES) for x in own[1:]]
                for m in steps:
                    best.append((best[-1][:, None] + m).max(0))
                ends = [int(best[-1].argmax())]
                for v, m in zip(reversed(best[:-1]), reversed(steps), strict=True):
                    ends.append(int((v + m[:, ends[-1]]).argmax()))
                ends.reverse()
                for (block, *_), before, last in zip(own, [-1, *ends], ends, strict=False):
                    yield conv_id, block, before, last

        yield from _in_runs(each(), ["conv_id", "block", "before", "last"], [i64, i64, pa.int32(), pa.int32()])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for (conv_id, block), own in _groups(batches, 2):
                states = model.path([x[1] for x in own], own[0][4], own[0][5])
                for x, state in zip(own, states, strict=True):
                    yield conv_id, block, x[0], x[2], x[3], state

        yield from _in_runs(each(), ["conv_id", "block", "pos", "line_no", "line", "state"], [i64, i64, i64, i64, pa.string(), pa.int32()])

    # a block of one transcript has block_lines rows at most, and the matrices need none of their texts
    short = rows.select("conv_id", "block", "pos", "symbol").repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    summed = short.mapInArrow(matrices, "conv_id long, block long, first array<double>, matrix array<double>")
    fixed = summed.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(bounds, "conv_id long, block long, before int, last int")
    fixed = fixed.withColumnsRenamed({"conv_id": "c", "block": "b"})
    joined = rows.join(fixed, rows["conv_id"].eqNullSafe(fixed["c"]) & (rows["block"] == fixed["b"])).select("conv_id", "block", "pos", "symbol", "line_no", "line", "before", "last")
    return joined.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos").mapInArrow(decode, "conv_id long, block long, pos long, line_no long, line string, state int")


def role_accuracy(lines: DataFrame, model: Hmm) -> DataFrame:
    """conv_id, n_lines, n_right: of the lines of known state, how many get their role back."""
    rows = number_lines(lines)
    found = recover_states(rows, model).select("pos", F.col("state").alias("found"))
    right = F.sum((F.floor(F.col("state") / 2) == F.floor(F.col("found") / 2)).cast("long"))
    return rows.where(F.col("state").isNotNull()).join(found, "pos").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_lines"), right.alias("n_right"))


def turns(lines: DataFrame, model: Hmm, block_lines: int = BLOCK_LINES) -> DataFrame:
    """One row per recovered turn: conv_id, first_line, n_lines, role, rendered."""
    decoded = materialise(recover_states(lines, model, block_lines), "states")
    starts = F.when(F.col("state") % 2 == 0, F.struct("pos", "line_no"))
    last = decoded.groupBy("conv_id", "block").agg(F.max(starts).alias("last_start"))
    # one row per block: what a block that goes on with a turn carries over
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.last("last_start", ignorenulls=True).over(earlier).alias("carried"))
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = decoded.withColumn("own_start", F.last(starts, ignorenulls=True).over(within))
    marked = marked.join(carried, marked["conv_id"].eqNullSafe(carried["c"]) & (marked["block"] == carried["b"]))
    marked = marked.withColumn("first", F.coalesce("own_start", "carried"))
    text = F.when(F.col("state") % 2 == 0, F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    gathered = marked.select("conv_id", "first", F.struct("pos", text.alias("text")).alias("x"), F.floor(F.col("state") / 2).cast("int").alias("r"))
    # the lines of one turn only
    out = gathered.groupBy("conv_id", "first").agg(F.max("r").alias("r"), F.count(F.lit(1)).alias("n_lines"), F.array_sort(F.collect_list("x")).alias("xs"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("r") + 1)
    body = F.array_join(F.transform("xs", lambda x: x["text"]), "\n")
    return out.select("conv_id", F.col("first.line_no").alias("first_line"), "n_lines", role.alias("role"), F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("\n<|end|>\n")).alias("rendered"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as transcripts with the states they have: conv_id, line_no, line, state, in one of four manners of marking.

    By conv_id: "User:" and so on; "Human:" and "AI:"; "Q:" and "A:"; or markers on two turns of three only. Line number = turn * 2^32 + line.
    A null role has no marker and no state.
    """
    role = F.col("role")
    manner, bare = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(4)), F.pmod(F.coalesce("conv_id", F.lit(0)) + F.col("turn"), F.lit(3)) == 0
    named = [("System: ", "User: ", "Assistant: "), ("System: ", "Human: ", "AI: "), ("Instructions: ", "Q: ", "A: "), ("### System: ", "### User: ", "### Assistant: ")]
    mark = F.lit("")
    for k, names in enumerate(named):
        for r, name in zip(ROLES, names, strict=True):
            mark = F.when((manner == k) & (role == r) & ~((manner == 3) & bare), F.lit(name)).otherwise(mark)
    split = conversations.where(F.col("turn").isNotNull()).select("conv_id", "turn", "role", mark.alias("mark"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "own"))
    known = F.lit(None).cast("int")
    for r, name in enumerate(ROLES):
        known = F.when(F.col("role") == name, F.lit(2 * r) + F.when(F.col("i") == 0, 0).otherwise(1)).otherwise(known)
    return split.select("conv_id", (F.col("turn").cast("long") * (1 << 32) + F.col("i")).alias("line_no"), F.when(F.col("i") == 0, F.concat("mark", "own")).otherwise(F.col("own")).alias("line"), known.alias("state"))
