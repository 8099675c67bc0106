"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is lines, some with a speaker marker ("User:", "### Human:", "<|im_start|>user",
"[BOT]"), some without.  Hidden states are a role with "begins a turn" or "goes on"; a line's
observation joins its marker with line features (after a blank line, a question, length, list or
code).  Start, transition and emission odds are counted on conversations whose roles are known,
and Viterbi finds the likeliest states; turns are then rendered in one canonical form.

A transcript comes in ordered parts of bounded size.  Viterbi over many parts is an associative
product of (max, +) matrices: each part gives the matrix of its best scores from any state
before it to any state at its end, matrices of neighbouring parts multiply in a tree, and going
back down fixes the states at every boundary; then each part is decoded alone.  Whatever is keyed
by conversation alone is a count with partial sums or has one row for many parts; texts are only
ever keyed by conversation and part.

A turn's first line loses its marker if the state's role is the marker's and the marker is
written as the part's markers of that role mostly are; another one ("Answer: 4" among "Agent:")
is a part of the body.

Semantics: null texts are empty; turns order by turn (null first), then role and text; repeated
rows are turns of their own; a conversation without a line of text has no turns; all rows with a
null conv_id are one conversation.  Null, negative and repeated turn numbers can put any number
of turns at one place: conversations with over FULL turns in a part are cut by rank instead.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch, few_enough

ROLES = ("system", "user", "assistant")
#: Turns of one part, and children of one node of the tree.
TURNS_A_PART, FAN = 64, 64
#: Turns of a part from which a conversation is cut by rank, not by turn number.
FULL = 4 * TURNS_A_PART
#: Parts whose counts of turns are summed as one; shares of a key in a join with too many keys to broadcast.
BLOCK, SALTS = 4096, 64

#: Names by which transcripts mark each role.
NAMES = {
    "system": "system sys instructions instruction context",
    "user": "user human customer question prompt q",
    "assistant": "assistant ai bot answer model agent response a",
}
_ROLE_OF = {n: r for r, names in enumerate(NAMES.values()) for n in names.split()}
_NAME = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
_MARKER = re.compile(rf"\s*(?:<\|im_start\|>\s*({_NAME})\s*$|[\[<]\s*({_NAME})\s*[\]>]:?|(?:[#*>\-]+\s*)?({_NAME})\s*\**\s*:\**)\s*", re.I)
_LIST = re.compile(r"\s*(?:[-*•]\s|\d+[.)]\s|```|\|)")
BLANK = " \t\r\x0b\x0c"
#: Observations: marker (none or a role) x after a blank line x first x question x length x list.
SYMBOLS = 4 * 2 * 2 * 2 * 3 * 2
STATES = 2 * len(ROLES)  # role r begins a turn: 2 r; goes on: 2 r + 1


def marker(line: str) -> tuple[int, str]:
    """(role or -1, the line less its marker)."""
    m = _MARKER.match(line)
    return (_ROLE_OF[(m[1] or m[2] or m[3]).lower()], line[m.end() :]) if m else (-1, line)


def bodies(lines: list[str], states: list[int]) -> list[str]:
    """The lines less the markers of turns; a marker unlike the usual one of its role here is a part of the text."""
    written: dict[int, tuple[int, str, str]] = {}
    for n, (line, s) in enumerate(zip(lines, states, strict=True)):
        m = _MARKER.match(line) if s % 2 == 0 else None
        if m:
            name = m[1] or m[2] or m[3]
            form = " ".join(m[0].split()).lower()
            written[n] = (_ROLE_OF[name.lower()], form, form.replace(name.lower(), "name"))
    forms, shapes = Counter(w[:2] for w in written.values()), Counter(w[2] for w in written.values())
    weight = {w: (forms[w[:2]], shapes[w[2]]) for w in written.values()}
    usual: dict[int, tuple[int, int]] = {}
    for w, n in weight.items():
        usual[w[0]] = max(usual.get(w[0], n), n)
    real = {n for n, w in written.items() if w[0] == states[n] // 2 and weight[w] == usual[w[0]]}
    return [marker(line)[1] if n in real else line for n, line in enumerate(lines)]


def observe(text: str, first: bool) -> tuple[list[str], np.ndarray]:
    """The lines with text, and their observations."""
    lines, seen = [], []
    blank = False
    for line in text.split("\n"):
        if not line.strip(BLANK):
            blank = True
            continue
        role, _ = marker(line)
        size = 0 if len(line) < 40 else 1 if len(line) < 200 else 2
        code = role + 1
        for n, x in ((2, blank), (2, first and not lines), (2, line.rstrip().endswith("?")), (3, size), (2, bool(_LIST.match(line)))):
            code = code * n + int(x)
        lines.append(line)
        seen.append(code)
        blank = False
    return lines, np.array(seen, np.int64)


@dataclass
class Hmm:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def product(self, seen: np.ndarray) -> np.ndarray:
        """best[a, b]: of the paths through the part, from state a before it to state b at its end."""
        best = np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)
        for o in seen:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + self.emit[:, o]
        return best

    def decode(self, seen: np.ndarray, before: int, after: int) -> np.ndarray:
        """The best states given the state before the part (-1: it begins the transcript) and at its end (-1: any)."""
        score = self.start + self.emit[:, seen[0]] if before < 0 else self.step[before] + self.emit[:, seen[0]]
        back = np.zeros((len(seen), STATES), np.int64)
        for i, o in enumerate(seen[1:], 1):
            ways = score[:, None] + self.step
            back[i] = ways.argmax(axis=0)
            score = ways.max(axis=0) + self.emit[:, o]
        out = np.empty(len(seen), np.int64)
        out[-1] = score.argmax() if after < 0 else after
        for i in range(len(seen) - 1, 0, -1):
            out[i - 1] = back[i, out[i]]
        return out


def train(turns: DataFrame) -> Hmm:
    """Counts states and observations of parts whose roles are known.

    turns: part text (string) and roles (array<string> of its lines with text, "+" before a role that begins).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for text, first, roles in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                _, seen = observe(text or "", first)
                states = [2 * ROLES.index(r.lstrip("+")) + (not r.startswith("+")) for r in roles]
                if len(states) != len(seen):
                    continue  # a text that holds what looks like a line end of its own
                for kind, a, b in [*((1, s, o) for s, o in zip(states, seen.tolist(), strict=True)), *((2, a, b) for a, b in zip(states, states[1:], strict=False)), *((3, s, 0) for s in states[:1] if first)]:
                    total[kind, a, b] = total.get((kind, a, b), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in total], pa.int64()) for i in range(3)] + [pa.array(list(total.values()), pa.int64())], names=["kind", "a", "b", "n"])

    counts = turns.select("text", "first", "roles").mapInArrow(run, "kind long, a long, b long, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    start, step, emit = np.ones(STATES), np.ones((STATES, STATES)), np.full((STATES, SYMBOLS), 0.05)
    for r in counts:
        {1: emit, 2: step, 3: start.reshape(-1, 1)}[r["kind"]][r["a"], r["b"]] += r["n"]
    start[1::2] = 0  # a transcript begins with a turn
    for a in range(STATES):
        for b in range(1, STATES, 2):
            if a // 2 != b // 2:
                step[a, b] = 0  # who goes on is who spoke
    with np.errstate(divide="ignore"):
        return Hmm(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), np.log(emit / emit.sum(axis=1, keepdims=True)))


def parse_transcripts(parts: DataFrame, model: Hmm) -> DataFrame:
    """conv, turn (from 0), role, text, canonical of every recovered turn.

    parts: conv (string), part (long, in order from 0 on, each once), text; each part of bounded size.
    """
    spark = parts.sparkSession
    scratch = Scratch(spark, "chat")
    sent = spark.sparkContext.broadcast(model)
    full = parts.where(F.col("text").rlike(f"[^{BLANK}\n]")).select("conv", "part", "text")
    firsts = full.groupBy("conv").agg(F.min("part").alias("part"), F.count("*").alias("n"))
    parts = scratch.write(full.join(firsts, ["conv", "part"], "left").select("conv", "part", "text", F.col("n").isNotNull().alias("first"), (F.coalesce("n", F.lit(2)) > 1).alias("more")))
    several = parts.where("more")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use: Hmm = sent.value
        for batch in batches:
            products, openings = [], []
            for text, first in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                _, seen = observe(text, first)
                whole = use.product(seen)
                opening = use.start + use.emit[:, seen[0]]
                if len(seen) > 1:
                    opening = (opening[:, None] + use.product(seen[1:])).max(axis=0)
                products.append(whole.ravel().tolist())
                openings.append(opening.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(products, pa.list_(pa.float64())), pa.array(openings, pa.list_(pa.float64()))], names=["conv", "part", "matrix", "opening"])

    long = bool(several.limit(1).count())
    if long:
        nodes = scratch.write(several.select("conv", "part", "text", "first").mapInArrow(matrices, "conv string, part long, matrix array<double>, opening array<double>"))
        around = _boundaries(nodes, scratch)
        placed = parts.join(around, ["conv", "part"], "left")
    else:
        placed = parts.withColumn("before", F.lit(None).cast("long")).withColumn("after", F.lit(None).cast("long"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use: Hmm = sent.value
        for batch in batches:
            conv, part, begins, at, role, line = [], [], [], [], [], []
            for c, p, text, first, before, after in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                lines, seen = observe(text, first)
                states = use.decode(seen, -1 if before is None else before, -1 if after is None else after)
                states = states.tolist()
                turn = 0
                for n, (s, x) in enumerate(zip(states, bodies(lines, states), strict=True)):
                    turn += s % 2 == 0
                    conv.append(c)
                    part.append(p)
                    begins.append(turn)
                    at.append(n)
                    role.append(ROLES[s // 2])
                    line.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.string()), pa.array(part, pa.int64()), pa.array(begins, pa.int64()), pa.array(at, pa.int64()), pa.array(role, pa.string()), pa.array(line, pa.string())], names=["conv", "part", "begun", "at", "role", "line"])

    lines = placed.select("conv", "part", "text", "first", "before", "after").mapInArrow(decode, "conv string, part long, begun long, at long, role string, line string")
    lines = scratch.write(lines)
    scratch.drop(parts)
    lines = lines.join(_turns_before(lines), ["conv", "part"]) if long else lines.withColumn("earlier", F.lit(0))
    turn = lines.groupBy("conv", (F.col("earlier") + F.col("begun") - 1).alias("turn")).agg(F.first("role").alias("role"), F.sort_array(F.collect_list(F.struct("part", "at", "line"))).alias("lines"))
    text = F.trim(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit(" \t\r\n"))
    return turn.select("conv", "turn", "role", text.alias("text")).withColumn("canonical", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def _turns_before(lines: DataFrame) -> DataFrame:
    """conv, part, earlier: turns begun in earlier parts, by sums of BLOCK parts and sums inside such a block."""
    begun = lines.groupBy("conv", "part", F.floor(F.col("part") / BLOCK).alias("block")).agg(F.max("begun").alias("n"))
    blocks = begun.groupBy("conv", "block").agg(F.sum("n").alias("n"))

    def before(*keys: str, by: str) -> Column:
        return F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    entering = blocks.select("conv", "block", before("conv", by="block").alias("entering"))
    inside = begun.select("conv", "block", "part", before("conv", "block", by="part").alias("inside"))
    return inside.join(entering, ["conv", "block"]).select("conv", "part", (F.col("entering") + F.col("inside")).alias("earlier"))


def _boundaries(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """States around the parts; inner nodes carry the opening scores of their first part multiplied through."""
    levels = [nodes]
    while levels[-1].groupBy("conv").count().where("count > 1").limit(1).count():

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                products, openings = [], []
                for children in batch.column(2).to_pylist():
                    whole, opening = None, np.array(children[0]["opening"])
                    for c in children:
                        m = np.array(c["matrix"]).reshape(STATES, STATES)
                        if whole is not None:
                            opening = (opening[:, None] + m).max(axis=0)
                        whole = m if whole is None else (whole[:, :, None] + m[None]).max(axis=1)
                    products.append(whole.ravel().tolist())
                    openings.append(opening.tolist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(products, pa.list_(pa.float64())), pa.array(openings, pa.list_(pa.float64()))], names=["conv", "part", "matrix", "opening"])

        levels.append(scratch.write(_grouped(levels[-1]).mapInArrow(multiply, "conv string, part long, matrix array<double>, opening array<double>")))
    placed = levels[-1].select("conv", "part", F.lit(-1).cast("long").alias("before"), F.lit(-1).cast("long").alias("after"))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, before, after, children in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                score, back = None, []
                for i, c in enumerate(children):
                    m = np.array(c["matrix"]).reshape(STATES, STATES)
                    if i == 0:
                        score = np.array(c["opening"]) if before < 0 else m[before]
                        back.append(np.full(STATES, before))
                    else:
                        ways = score[:, None] + m
                        back.append(ways.argmax(axis=0))
                        score = ways.max(axis=0)
                state = int(score.argmax()) if after < 0 else after
                for i in range(len(children) - 1, -1, -1):
                    prior = int(back[i][state])
                    rows.append((conv, children[i]["child"], prior, state))
                    state = prior
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), *[pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)]], names=["conv", "part", "before", "after"])

    for below in reversed(levels[:-1]):
        kids = _grouped(below)
        above, placed = placed, scratch.write(placed.join(kids, ["conv", "part"]).select("conv", "before", "after", "children").mapInArrow(descend, "conv string, part long, before long, after long"))
        scratch.drop(above, below)
    return placed


def _grouped(level: DataFrame) -> DataFrame:
    """conv, part of the parent, children: at most FAN of them."""
    return level.groupBy("conv", F.floor(F.col("part") / FAN).alias("part")).agg(F.sort_array(F.collect_list(F.struct(F.col("part").alias("child"), "matrix", "opening"))).alias("children"))


# --- transcripts of a table of known turns -------------------------------------------------------

#: How transcripts write a marker for (system, user, assistant), and what stands between turns.
STYLES = (
    (("System: ", "User: ", "Assistant: "), "\n"),
    (("### System:\n", "### Human:\n", "### Assistant:\n"), "\n\n"),
    (("<|im_start|>system\n", "<|im_start|>user\n", "<|im_start|>assistant\n"), "\n"),
    (("[CONTEXT] ", "[Q] ", "[A] "), "\n"),
    (("**Instructions:** ", "**Customer:** ", "**Agent:** "), "\n\n"),
)
#: One turn in so many has lost its marker.
LOST = 6


def transcripts(turns: DataFrame) -> DataFrame:
    """conv, part, first, text, roles: transcripts as they are found, from known turns (conv_id, turn, role, text).

    The style goes by conversation; one turn in LOST has no marker.
    """
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none"))
    place = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    known = F.coalesce(F.when(F.col("role").isin(*ROLES), F.col("role")), F.lit("user"))
    body = F.coalesce("text", F.lit(""))
    style = F.pmod(F.crc32(conv.cast("binary")), F.lit(len(STYLES)))
    lost = F.pmod(F.crc32(F.concat_ws(":", conv, place.cast("string")).cast("binary")), F.lit(LOST)) == 0

    def written(marks: Column) -> Column:
        out = F.lit("")
        for s, (names, _) in enumerate(STYLES):
            for r, name in zip(ROLES, names, strict=True):
                out = F.when((style == s) & (marks == r), F.lit(name)).otherwise(out)
        return out

    between = F.lit("\n")
    for s, (_, gap) in enumerate(STYLES):
        between = F.when(style == s, F.lit(gap)).otherwise(between)
    text = F.concat(F.when(lost, F.lit("")).otherwise(written(known)), body)
    full = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    roles = F.transform(full, lambda x, i: F.concat(F.when(i == 0, F.lit("+")).otherwise(F.lit("")), known))
    rows = turns.select(conv.alias("conv"), F.floor(F.greatest(place, F.lit(0)) / TURNS_A_PART).alias("part"), place.alias("place"), known.alias("known"), F.concat(text, between).alias("text"), roles.alias("roles"))
    rows = _cut_by_rank(rows)
    parts = rows.groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("place", "known", "text", "roles"))).alias("t"))
    return parts.select("conv", "part", (F.col("part") == 0).alias("first"), F.array_join(F.transform("t", lambda x: x["text"]), "").alias("text"), F.flatten(F.transform("t", lambda x: x["roles"])).alias("roles"))


def _cut_by_rank(rows: DataFrame) -> DataFrame:
    """rows, those of conversations with a part of over FULL turns with the part of their rank in (place, known, text).

    A global sort spreads a conversation, and rows that are all equal, over tasks; a row's rank is its place in its
    task's run and the counts of the runs before, of which a conversation has no more than there are tasks.
    """
    over = rows.groupBy("conv", "part").agg(F.count("*").alias("n")).where(F.col("n") > FULL).select("conv").distinct()
    if not over.limit(1).count():
        return rows
    scratch = Scratch(rows.sparkSession, "turns")
    over = scratch.write(over.withColumn("over", F.lit(True)))
    if few_enough(over):
        marked = rows.join(F.broadcast(over), "conv", "left")
    else:
        shares = over.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        marked = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(shares, ["conv", "salt"], "left")
    given = scratch.write(marked.where("over").select(*rows.columns, F.monotonically_increasing_id().alias("tie")))
    # the id holds the number of the task above 33 bits of the place in its run
    ranked = scratch.write(given.orderBy("conv", "place", "known", "text", "tie").withColumn("id", F.monotonically_increasing_id()).withColumn("run", F.shiftright("id", 33)))
    scratch.drop(given)
    runs = ranked.groupBy("conv", "run").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = scratch.write(runs.select("conv", "run", "low", before.alias("before")))
    placed = ranked.join(F.broadcast(runs) if few_enough(runs) else runs, ["conv", "run"])
    rank = F.col("id") - F.col("low") + F.col("before")
    return marked.where("over is null").select(*rows.columns).unionByName(placed.withColumn("part", F.floor(rank / TURNS_A_PART)).select(*rows.columns))
