"""Transcript parsing: roles of lines by a hidden Markov model, then canonical turns.

A line is seen through its speaker marker (`User:`, `### Assistant`, `<|system|>` ...), its length, whether it opens a row, how many lines
the row has, and whether it ends in a question mark. States are the roles. Start, transition (within a row, and from row to row) and
feature tables are counted by Spark over the labelled conversations; markers have fixed tables. Viterbi finds the roles; runs of lines
with one role become turns.

A conversation is cut into chunks of CHUNK turn numbers. A chunk is reduced to the best score from each role before it to each role at its
end; these small tables are chained along the conversation, and chunks are then decoded apart, so a conversation of any length is never in
one task. A chunk with more than MOST_ROWS rows (repeated turn numbers) is cut further by turn, and a turn number with more rows than that
at every MOST_ROWS-th row in order of text, so the cuts are in the order of the rows.

Defined cases: rows are ordered by turn (null first), then text; a null or empty text is one empty line; rows with a null conv_id are one
conversation; a null or unknown role teaches nothing; with nothing to learn from the tables are even; repeated rows are turns of their
own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railmart.llm import common

ROLES = ("system", "user", "assistant")
CHUNK = 256
MOST_ROWS = 4_096
STAY = 0.98
MARKER = re.compile(
    r"^\s*(?:#{1,6}\s*|\*\*|<\||\[)?(?P<name>system|instructions?|user|human|customer|question|q|assistant|ai|bot|model|answer|a)"
    r"(?:\*\*|\|>|\])?\s*(?P<end>[:：>]|\|>|$)\s*", re.IGNORECASE,
)
SPEAKER = {"system": 1, "instruction": 1, "instructions": 1, "user": 2, "human": 2, "customer": 2, "question": 2, "q": 2}
#: Chance of no marker, and of one of the system, the user, the assistant, for a line of each role.
MARKERS = np.array([[0.60, 0.36, 0.02, 0.02], [0.60, 0.02, 0.36, 0.02], [0.60, 0.02, 0.02, 0.36]])
#: Number of values of each learned feature.
WIDTHS = (6, 2, 4, 2)


def marker_of(line: str) -> tuple[int, str]:
    """0 for none, else 1 to 3 by role; and the line without it. Marker words of one letter need a colon."""
    found = MARKER.match(line)
    if not found or (len(found["name"]) == 1 or found["end"] == "") and found["end"] not in (":", "：") and not line.strip().startswith(("#", "<|", "[", "**")):
        return 0, line
    return SPEAKER.get(found["name"].lower(), 3), line[found.end() :]


def seen_in(text: str | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Markers, learned features (lines x 4) and the lines without markers of one row."""
    lines = (text or "").split("\n")
    marks, left = zip(*map(marker_of, lines), strict=True)
    many = int(np.searchsorted([1, 3, 8], len(lines)))
    rows = [(int(np.searchsorted([0, 20, 60, 150, 400], len(x))), int(i == 0), many, int(x.rstrip().endswith("?"))) for i, x in enumerate(lines)]
    return np.array(marks), np.array(rows), list(left)


class Model:
    """Logarithms of the tables. moves[0] is for lines within a row, moves[1] for lines that open one."""

    def __init__(self, start: np.ndarray, move: np.ndarray, tables: list[np.ndarray]):
        stay = np.full((3, 3), (1 - STAY) / 2) + np.eye(3) * (STAY - (1 - STAY) / 2)
        self.start = np.log((start + 1) / (start + 1).sum())
        self.moves = np.log(np.array([stay, (move + 1) / (move + 1).sum(axis=1, keepdims=True)]))
        self.tables = [np.log((t + 1) / (t + 1).sum(axis=1, keepdims=True)) for t in tables]

    def emissions(self, marks: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.log(MARKERS)[:, marks].T.copy()
        for j, table in enumerate(self.tables):
            out += table[:, rows[:, j]].T
        return out

    def steps(self, marks: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For each line, scores by role before and role of the line; a marker after a row's first line allows any change."""
        opens = np.where((rows[:, 1] == 1) | (marks > 0), 1, 0)
        return self.moves[opens] + self.emissions(marks, rows)[:, None, :]

    def begun(self, steps: np.ndarray) -> np.ndarray:
        """The same for lines that begin a conversation (their first line opens a row)."""
        first = self.start + (steps[0] - self.moves[1])[0]
        return np.concatenate([np.repeat(first[None, None], 3, axis=1), steps[1:]])

    def summary(self, steps: np.ndarray) -> np.ndarray:
        """Best score from each role before the lines to each role of the last."""
        total = steps[0]
        for step in steps[1:]:
            total = (total[:, :, None] + step[None]).max(axis=1)
        return total

    def decoded(self, steps: np.ndarray, enter: np.ndarray, leave: int | None) -> np.ndarray:
        """Roles by Viterbi; enter: score of each role before; leave: role of the last line, if it is settled."""
        back = np.empty((len(steps), 3), np.int64)
        score = enter
        for t, step in enumerate(steps):
            both = score[:, None] + step
            back[t], score = both.argmax(axis=0), both.max(axis=0)
        role = np.empty(len(steps), np.int64)
        role[-1] = int(score.argmax()) if leave is None else leave
        for t in range(len(steps) - 1, 0, -1):
            role[t - 1] = back[t, role[t]]
        return role


def train(conversations: DataFrame) -> Model:
    """Counts over all given conversations; columns conv_id, turn, role, text."""
    known = conversations.filter(F.col("role").isin(*ROLES))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [np.zeros((3, w), np.int64) for w in WIDTHS]
            for role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, rows, _ = seen_in(text)
                for j, s in enumerate(sums):
                    np.add.at(s[ROLES.index(role)], rows[:, j], 1)
            flat = [(j, r, v, int(s[r, v])) for j, s in enumerate(sums) for r in range(3) for v in range(s.shape[1])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat, strict=True)], names=["f", "r", "v", "n"])

    tables = [np.zeros((3, w)) for w in WIDTHS]
    counts = known.select("role", "text").mapInArrow(features, "f long, r long, v long, n long").groupBy("f", "r", "v").agg(F.sum("n").alias("n"))
    for f, r, v, n in counts.collect():
        tables[f][r, v] = n
    # The row before is the one with the next smaller turn number of the conversation; equal numbers count as one row.
    turns = known.groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    start, move = np.zeros(3), np.zeros((3, 3))
    for a, b, n in turns.join(after, ["conv_id", "turn"]).groupBy("role", "next").agg(F.count("*").alias("n")).collect():
        move[ROLES.index(a), ROLES.index(b)] = n
    first = known.groupBy("conv_id").agg(F.min_by("role", F.struct("turn", "role")).alias("role")).groupBy("role").agg(F.count("*").alias("n"))
    for a, n in first.collect():
        start[ROLES.index(a)] = n
    return Model(start, move, tables)


def chunked(conversations: DataFrame) -> DataFrame:
    """conv, turn, text and the chunk (three numbers, in order along the conversation)."""
    rows = conversations.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), "text")
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62))))
    crowd = rows.groupBy("conv", "part", "turn").agg(F.count("*").alias("n"))
    whole = crowd.groupBy("conv", "part").agg(F.sum("n").alias("n")).filter(F.col("n") > MOST_ROWS).select(F.col("conv").alias("c"), F.col("part").alias("p"))
    crowd = crowd.join(whole, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    crowd = crowd.select("c", F.col("turn").alias("t"), F.when(F.col("n") > MOST_ROWS, F.monotonically_increasing_id()).alias("crowd"), F.lit(True).alias("apart"))
    crowd = common.stored(crowd, "crowded-turns")
    joined = rows.join(crowd, F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    at = F.when(F.col("apart"), F.coalesce("turn", F.lit(0))).otherwise(F.lit(0))
    joined = joined.select("conv", "part", at.cast("long").alias("at"), "turn", "text", "crowd")
    columns = ["conv", "part", "at", "cut", "turn", "text"]
    out = joined.filter("crowd IS NULL").withColumn("cut", F.lit(0).cast("long")).select(*columns)
    if crowd.filter("crowd IS NOT NULL").limit(1).count():
        out = out.unionByName(cut_in_order(joined.filter("crowd IS NOT NULL")).select(*columns))
    return out


def cut_in_order(rows: DataFrame) -> DataFrame:
    """The rows with their `cut`: the place of the row among those of its `crowd` in order of text, divided by MOST_ROWS.

    Equal texts may be in several ranges, as their order is of no account."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            crowd = batch.column("crowd").to_numpy()
            begins = np.flatnonzero(np.append(True, crowd[1:] != crowd[:-1]))
            place = np.arange(len(crowd)) - np.repeat(begins, np.diff(np.append(begins, len(crowd))))
            if crowd[0] == last:
                place[: begins[1] if len(begins) > 1 else None] += seen
            last, seen = crowd[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(crowd), part), pa.int64()), pa.array(place, pa.int64())], names=[*batch.schema.names, "range", "place"]
            )

    by_text = F.coalesce("text", F.lit(""))
    ranged = rows.repartitionByRange("crowd", by_text, F.xxhash64(F.monotonically_increasing_id())).sortWithinPartitions("crowd", by_text)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = common.stored(ranged.mapInArrow(counted, f"{ddl}, range long, place long"), "crowded-rows")
    before = F.sum("n").over(Window.partitionBy("crowd").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = placed.groupBy("crowd", "range").agg(F.count("*").alias("n")).select("crowd", "range", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.join(F.broadcast(counts), ["crowd", "range"]).withColumn("cut", F.floor((F.col("before") + F.col("place")) / MOST_ROWS).cast("long"))


def parsed(conversations: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, part, role, text, rendered: the turns found in each row, in order (part counts within the row)."""
    kept = conversations.sparkSession.sparkContext.broadcast(model)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = common.stored(chunked(conversations), "chat-chunks")
    key = ["conv", "part", "at", "cut"]

    def ordered(table: pa.Table) -> tuple[list, np.ndarray, list[int]]:
        items = sorted(zip(table["turn"].to_pylist(), table["text"].to_pylist(), strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
        seen = [seen_in(text) for _, text in items]
        return list(zip(items, (s[2] for s in seen), strict=True)), kept.value.steps(np.concatenate([s[0] for s in seen]), np.concatenate([s[1] for s in seen])), [len(s[2]) for s in seen]

    def both(steps: np.ndarray) -> bytes:
        return np.array([kept.value.summary(steps), kept.value.summary(kept.value.begun(steps))]).tobytes()

    def summed(names: tuple, table: pa.Table) -> pa.Table:
        _, steps, _ = ordered(table)
        return pa.table({**{k: pa.array([n.as_py()], table.schema.field(k).type) for k, n in zip(key, names, strict=True)}, "best": pa.array([both(steps)], pa.binary())})

    def chained(_: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([(k, "ascending") for k in key[1:]])
        tables = np.array([np.frombuffer(b, np.float64).reshape(2, 3, 3)[int(i == 0)] for i, b in enumerate(table["best"].to_pylist())])
        roles = kept.value.decoded(tables, np.zeros(3), None)
        return table.drop_columns(["best"]).append_column("leave", pa.array(roles)).append_column("enter", pa.array(np.append(-1, roles[:-1])))

    def turns(table: pa.Table, enter: int, leave: int) -> pa.Table:
        items, steps, counts = ordered(table)
        score = np.zeros(3) if enter < 0 else np.where(np.arange(3) == enter, 0.0, -1e9)
        role = kept.value.decoded(kept.value.begun(steps) if enter < 0 else steps, score, None if leave < 0 else leave)
        out, at = [], 0
        for ((turn, text), lines), n in zip(items, counts, strict=True):
            mine = role[at : at + n]
            cuts = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), n]
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                body = "\n".join(lines[a:b]).strip()
                name = ROLES[mine[a]]
                out.append((turn, k, name, body, f"<|{name}|>\n{body}\n<|end|>"))
            at += n
        columns = list(zip(*out, strict=True))
        conv = pa.array([table["conv"][0].as_py()] * len(out), table.schema.field("conv").type)
        return pa.table([conv, *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True))],
                        names=["conv_id", "turn", "part", "role", "text", "rendered"])

    def alone(_: tuple, table: pa.Table) -> pa.Table:
        return turns(table, -1, -1)

    def settled(_: tuple, table: pa.Table) -> pa.Table:
        return turns(table, table["enter"][0].as_py(), table["leave"][0].as_py())

    ddl = f"conv_id {kind}, turn long, part long, role string, text string, rendered string"
    long = rows.select(*key).distinct().groupBy("conv").agg(F.count("*").alias("chunks")).filter("chunks > 1")
    long = common.stored(long.select(F.col("conv").alias("c")), "long-chats")
    many = rows.join(long, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    few = rows.join(long, F.col("conv").eqNullSafe(F.col("c")), "left_anti")
    sums = many.groupBy(*key).applyInArrow(summed, f"conv {kind}, part long, at long, cut long, best binary")
    ends = sums.groupBy("conv").applyInArrow(chained, f"conv {kind}, part long, at long, cut long, leave long, enter long")
    ends = common.stored(ends, "chat-ends").select(*[F.col(k).alias(f"{k}_") for k in key], "leave", "enter")
    same = F.col("conv").eqNullSafe(F.col("conv_"))
    for k in key[1:]:
        same = same & (F.col(k) == F.col(f"{k}_"))
    placed = many.join(ends, same).select(*rows.columns, "enter", "leave")
    return few.groupBy("conv").applyInArrow(alone, ddl).unionByName(placed.groupBy(*key).applyInArrow(settled, ddl))


def query(spark, sf_dir: str) -> DataFrame:
    talks = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    model = train(talks.filter(~common.held_out("conv_id")))
    return parsed(talks, model).select("conv_id", common.held_out("conv_id").alias("held_out"), "turn", "part", "role", "rendered")
