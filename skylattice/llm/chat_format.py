"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is a text; some turns begin with a speaker marker, many do not.
States are (role, begins a turn or goes on).  What is seen of a line comes from
the text alone: its marker, whether a blank line comes before, its length class,
its last sign and its first.  Transition and emission counts come from labelled
transcripts, Viterbi recovers the best states, and each turn is rendered in one
canonical form with the markers taken off.

A transcript may be of any length: it comes in pages of bounded size, cut from
sorted rows as they stream by, and no page knows turns or roles.  A page gives
the best score from each state before it to each state at its end (a max-plus
matrix); the matrices of a transcript are chained, which fixes the states at the
pages' borders, and each page then decodes between them.  That is exact Viterbi,
and no task ever holds a whole transcript of many pages.

Nulls and empties: a null text has no line; blank lines are no lines but are kept
within a turn.  A transcript without lines gives no turn.  A null conversation id
is a conversation of its own; a null turn comes first.  Null and unknown roles
count as nothing in training.  Turns of one number are in the order of their role
and text, repeated rows are lines that repeat.  Without labelled rows, smoothing
leaves markers' priors alone.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import storage

ROLES = ("system", "user", "assistant")
#: States: role r begins a turn (2r), role r goes on (2r + 1).
STATES = 2 * len(ROLES)
#: Speaker markers at the start of a line, by role; fixed values.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "question", "q", "me", "client"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model"),
}
#: Sizes of the line features: marker, blank before, length, last sign, first sign.
SIZES = (4, 2, 6, 4, 4)
#: Text of a page, in characters (a longer line stays whole).
PAGE_CHARS = 30_000
BLANK = "^[\\x20\\x09-\\x0D]*$"
SMOOTH = 0.5


def marker(line: Column) -> Column:
    """0: none, 1 to 3: a marker of system, user or assistant."""
    name = F.lower(F.regexp_extract(line, r"^\s*[\[#*]*\s*([A-Za-z]+)\s*[\]*]*\s*:", 1))
    out = F.lit(0)
    for k, role in enumerate(ROLES, 1):
        out = F.when(name.isin(*MARKERS[role]), F.lit(k)).otherwise(out)
    return out


def unmarked(line: Column) -> Column:
    """The line without its marker."""
    return F.when(marker(line) > 0, F.regexp_replace(line, r"^\s*[\[#*]*\s*[A-Za-z]+\s*[\]*]*\s*:\s*", "")).otherwise(line)


def lines_of(pages: DataFrame) -> DataFrame:
    """conv_id, chunk, line_no, line, gap (blank lines before it): the lines with a word of each page's text; other columns go along."""
    rest = [c for c in pages.columns if c not in ("conv_id", "chunk", "text")]
    split = pages.select("conv_id", "chunk", *rest, F.split("text", "\n").alias("_s"))
    at = F.filter(F.transform("_s", lambda x, i: F.when(~x.rlike(BLANK), i)), lambda i: i.isNotNull())
    split = split.withColumn("_p", at)
    entry = F.transform("_p", lambda p, k: F.struct(F.get("_s", p).alias("line"), (p - F.coalesce(F.get("_p", k - 1), F.lit(-1)) - 1).alias("gap")))
    return split.select("conv_id", "chunk", *rest, F.posexplode(entry).alias("line_no", "x")).select("conv_id", "chunk", *rest, F.col("line_no").cast("long"), "x.line", "x.gap")


def observed(lines: DataFrame) -> DataFrame:
    """Adds f0..f4, the features of each line (of lines_of)."""
    text = F.rtrim("line")
    last, start = F.substring(text, -1, 1), F.substring(F.ltrim("line"), 1, 1)
    return lines.withColumns({
        "f0": marker(F.col("line")), "f1": (F.col("gap") > 0).cast("int"),
        "f2": F.least(F.lit(5), F.floor(F.log2(F.length("line") + 1) / 2).cast("int")),
        "f3": F.when(last == "?", 1).when(last == ":", 2).when(last.isin(".", "!"), 3).otherwise(0),
        "f4": F.when(start.rlike("[0-9#*>|-]"), 3).when(start != F.lower(start), 1).when(start != F.upper(start), 2).otherwise(0),
    })


def train(labelled: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """(log transitions [state before or start, state], log emissions by feature). labelled: observed lines with their state s (NULL: unknown) and the state before, which is STATES at the start and NULL where it is not known.

    Counts are grouped before they leave the executors: a table of states and features only.
    """
    counts = labelled.where(F.col("s").isNotNull()).groupBy("s", "before", *(f"f{k}" for k in range(len(SIZES)))).agg(F.count("*").alias("n")).collect()
    move = np.full((STATES + 1, STATES), SMOOTH)
    emit = [np.full((STATES, size), SMOOTH) for size in SIZES]
    for k, role_name in enumerate(ROLES):  # a marker speaks for its role, seen in training or not
        emit[0][2 * k, k + 1] += 20
    for r in counts:
        if r["before"] is not None:
            move[r["before"], r["s"]] += r["n"]
        for k in range(len(SIZES)):
            emit[k][r["s"], r[f"f{k}"]] += r["n"]
    for k in range(len(ROLES)):  # only the role itself goes on
        for before in range(STATES + 1):
            if before // 2 != k or before == STATES:
                move[before, 2 * k + 1] = 1e-12
    return np.log(move / move.sum(1, keepdims=True)), [np.log(e / e.sum(1, keepdims=True)) for e in emit]


def emissions(table: pa.Table, emit: list[np.ndarray]) -> np.ndarray:
    """Log probability of each line in each state."""
    return sum(emit[k][:, table.column(f"f{k}").to_numpy()].T for k in range(len(SIZES)))


def chunk_matrices(scores: np.ndarray, first: np.ndarray, length: np.ndarray, move: np.ndarray) -> np.ndarray:
    """For each chunk (lines first to first + length), the best score from each state before it (the last row: the start) to each state of its last line.

    All chunks take each step together, the longest ones first.
    """
    order = np.argsort(-length, kind="stable")
    at, n = first[order], length[order]
    best = move[None] + scores[at][:, None, :]
    for t in range(1, int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -t))
        best[:k] = (best[:k, :, :, None] + move[None, None, :STATES, :]).max(2) + scores[at[:k] + t][:, None, :]
    out = np.empty_like(best)
    out[order] = best
    return out


def decode_chunks(scores: np.ndarray, first: np.ndarray, length: np.ndarray, move: np.ndarray, before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The best states of the lines of each chunk between its given borders."""
    order = np.argsort(-length, kind="stable")
    at, n = first[order], length[order]
    best, back = move[before[order]] + scores[at], []
    for t in range(1, int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -t))
        step = best[:k, :, None] + move[None, :STATES, :]
        back.append(step.argmax(1))
        best[:k] = step.max(1) + scores[at[:k] + t]
    states = np.empty(len(scores), np.int32)
    now = last[order].copy()
    states[at + n - 1] = now
    for t in range(len(back), 0, -1):
        k = len(back[t - 1])
        now[:k] = back[t - 1][np.arange(k), now[:k]]
        states[at[:k] + t - 1] = now[:k]
    return states


def borders(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, last state) of each chunk of one transcript."""
    best, back = matrices[0][STATES], []
    for m in matrices[1:]:
        step = best[:, None] + m[:STATES]
        back.append(step.argmax(0))
        best = step.max(0)
    last = [int(best.argmax())]
    for b in reversed(back):
        last.append(int(b[last[-1]]))
    last.reverse()
    return list(zip([STATES, *last[:-1]], last))


#: Lines that one task step works on, about.
STEP_LINES = 50_000


def roles(lines: DataFrame, move: np.ndarray, emit: list[np.ndarray], folder: str) -> DataFrame:
    """conv_id, chunk, line_no, line, gap, state, within (turns that began in the chunk so far) of observed lines. Many chunks share a step; a chunk is never in two."""
    lines = storage.save(lines, f"{folder}/lines")
    steps = max(8, -(-lines.count() // STEP_LINES))
    features = [f"f{k}" for k in range(len(SIZES))]
    lines = lines.withColumn("step", F.pmod(F.xxhash64("conv_id", "chunk"), F.lit(steps)))

    def chunks(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """The lines in order, and where each chunk starts and how long it is."""
        group = group.sort_by([("conv_id", "ascending"), ("chunk", "ascending"), ("line_no", "ascending")])
        conv, none, chunk = group.column("conv_id").fill_null(0).to_numpy(), group.column("conv_id").is_null().to_numpy(), group.column("chunk").to_numpy()
        new = np.concatenate(([True], (conv[1:] != conv[:-1]) | (none[1:] != none[:-1]) | (chunk[1:] != chunk[:-1])))
        first = np.flatnonzero(new)
        return group, first, np.diff(np.append(first, len(new)))

    def matrix(group: pa.Table) -> pa.Table:
        group, first, length = chunks(group)
        m = chunk_matrices(emissions(group, emit), first, length, move)
        return pa.table({**{c: group.column(c).take(pa.array(first)) for c in ("conv_id", "chunk")}, "m": pa.array([x.tobytes() for x in m], pa.binary())})

    def chain(group: pa.Table) -> pa.Table:
        group = group.sort_by([("conv_id", "ascending"), ("chunk", "ascending")])
        names = group.column("conv_id").to_pylist()
        matrices = [np.frombuffer(m.as_buffer(), np.float64).reshape(STATES + 1, STATES) for m in group.column("m")]
        edges = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        pairs = [p for a, b in zip(edges, edges[1:]) for p in borders(matrices[a:b])]
        return pa.table({"conv_id": group.column("conv_id"), "chunk": group.column("chunk"), "before": pa.array([p[0] for p in pairs], pa.int32()), "last": pa.array([p[1] for p in pairs], pa.int32())})

    def states(group: pa.Table) -> pa.Table:
        group, first, length = chunks(group)
        before, last = (group.column(c).to_numpy()[first] for c in ("before", "last"))
        s = decode_chunks(emissions(group, emit), first, length, move, before, last)
        begun = np.cumsum(s % 2 == 0)
        within = begun - np.repeat(begun[first] - (s[first] % 2 == 0), length)
        return pa.table({**{c: group.column(c) for c in ("conv_id", "chunk", "line_no", "line", "gap")}, "state": pa.array(s), "within": pa.array(within.astype(np.int64))})

    made = lines.select("step", "conv_id", "chunk", "line_no", *features).groupBy("step").applyInArrow(matrix, "conv_id long, chunk long, m binary")
    by_conversation = made.withColumn("step", F.pmod(F.xxhash64("conv_id"), F.lit(steps)))
    ends = storage.save(by_conversation.groupBy("step").applyInArrow(chain, "conv_id long, chunk long, before int, last int"), f"{folder}/borders")
    joined = lines.join(ends, F.equal_null(lines["conv_id"], ends["conv_id"]) & (lines["chunk"] == ends["chunk"])).select("step", lines["conv_id"], lines["chunk"], "line_no", "line", "gap", *features, "before", "last")
    return joined.groupBy("step").applyInArrow(states, "conv_id long, chunk long, line_no long, line string, gap int, state int, within long")


def render(decoded: DataFrame) -> DataFrame:
    """conv_id, turn_no, role, n_lines, rendered: a row for each recovered turn, in canonical form."""
    per_chunk = decoded.groupBy("conv_id", "chunk").agg(F.max("within").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = per_chunk.select(F.col("conv_id").alias("_c"), F.col("chunk").alias("_k"), earlier.alias("base"))
    x = decoded.join(base, F.equal_null("conv_id", "_c") & (F.col("chunk") == F.col("_k"))).withColumn("turn_no", (F.col("base") + F.col("within") - 1).cast("long"))
    x = x.withColumn("role", F.element_at(F.array(*map(F.lit, ROLES)), F.floor(F.col("state") / 2).cast("int") + 1))
    shown = F.when(F.col("state") % 2 == 0, unmarked(F.col("line"))).otherwise(F.concat(F.repeat(F.lit("\n"), F.col("gap")), "line"))
    turns = x.groupBy("conv_id", "turn_no").agg(F.first("role").alias("role"), F.count("*").alias("n_lines"), F.sort_array(F.collect_list(F.struct("chunk", "line_no", shown.alias("line")))).alias("l"))
    body = F.array_join(F.col("l.line"), "\n")
    return turns.select("conv_id", "turn_no", "role", "n_lines", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), body, F.lit("\n<|end|>\n")).alias("rendered"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Transcripts of a table of turns, as logs write them, in pages: conv_id, chunk (ascends within a conversation), text, and for training and tests truth (the state of each line with a word, -1: unknown) and starts (is it the first page?).

    By the conversation, turns begin with a full marker, with a short one, with
    one for the user only, or with none; all but the third kind have a blank
    line between turns.  Rows are sorted over all tasks, so a conversation, or
    a turn number, of any size is dealt over many and streams by.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    long_name = F.initcap("role")
    short = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise("Context")
    name = F.when(style == 0, long_name).when(style == 1, short).when((style == 2) & (F.col("role") == "user"), F.lit("Human"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").where(F.col("text").isNotNull())
    marked = F.concat(F.coalesce(F.concat(name, F.lit(": ")), F.lit("")), F.col("text"))
    state = 2 * (F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1)
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", marked.alias("marked"), F.coalesce(state, F.lit(-1)).alias("state"), (style != 2).alias("spaced"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 36
        page, made = 0, []
        conv, held, truth, size, starts = None, [], [], 0, True

        def end() -> None:
            nonlocal page, held, truth, size
            if held:
                made.append((conv, first + page, "\n".join(held), truth, starts))
                page, held, truth, size = page + 1, [], [], 0

        def table() -> pa.RecordBatch:
            columns = list(zip(*made)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.bool_()))], names=["conv_id", "chunk", "text", "truth", "starts"])

        seen = False
        for batch in batches:
            for c, marked, state, spaced in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if not seen or c != conv:
                    end()
                    conv, starts, fresh, seen = c, True, True, True
                text = marked.split("\n")
                for k, line in enumerate([""] + text if spaced and not fresh else text):
                    if size > PAGE_CHARS and held[-1].strip():  # blank lines stay with the line that they come before
                        end()
                        starts = False
                    begins = True if not k else begins
                    held.append(line)
                    size += len(line) + 1
                    if line.strip(" \t\n\x0b\f\r"):
                        truth.append(-1 if state < 0 else state + (not begins))
                        begins = False
                fresh = False
            if len(made) > 200:
                yield table()
                made = []
        end()
        yield table()

    return rows.mapInArrow(cut, "conv_id long, chunk long, text string, truth array<int>, starts boolean")


def known_lines(pages: DataFrame) -> DataFrame:
    """Observed lines of pages with their state s (NULL: unknown) and the state before."""
    lines = observed(lines_of(pages))
    state = lambda k: F.when(F.get("truth", k) >= 0, F.get("truth", k))
    at = F.col("line_no").cast("int")
    before = F.when(at > 0, state(at - 1)).otherwise(F.when(F.col("starts"), F.lit(STATES)))
    return lines.withColumns({"s": state(at), "before": before}).drop("truth", "starts")


def decoded(pages: DataFrame, folder: str, fold: int = 5) -> DataFrame:
    """The lines of all pages with their recovered states; trained on conversations whose hash modulo fold is not 0."""
    known = known_lines(pages.where(F.pmod(F.xxhash64("conv_id", F.lit(7)), F.lit(fold)) != 0))
    move, emit = train(known)
    return roles(observed(lines_of(pages.select("conv_id", "chunk", "text"))), move, emit, folder)


def chat_format(conversations: DataFrame, fold: int = 5) -> DataFrame:
    """conv_id, turn_no, role, n_lines, rendered_sha256, rendered of each recovered turn of each transcript.

    Trained on conversations whose hash modulo fold is not 0.
    """
    folder = storage.work_dir(conversations.sparkSession, "chat")
    pages = storage.save(transcripts(conversations), f"{folder}/pages")
    turns = render(storage.save(decoded(pages, folder, fold), f"{folder}/decoded"))
    return turns.select("conv_id", "turn_no", "role", "n_lines", F.sha2("rendered", 256).alias("rendered_sha256"), "rendered")
