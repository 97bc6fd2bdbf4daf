"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a sequence of lines, given in ordered segments. States say whose turn a line
belongs to and whether it begins that turn. A line shows a speaker marker (or none), its length and whether
it asks. Viterbi decoding runs in blocks: a block of segments is a max-plus matrix of best scores from
the state before it to the state at its end, and blocks of a long transcript are combined in a tree, so no task holds a whole transcript.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yieldcast.llm.common import scratch

ROLES = ("system", "user", "assistant")
BLOCK = 64               # segments in a block, and blocks in a node of the tree
STATES = 2 * len(ROLES)  # role r begins in state 2 r and goes on in 2 r + 1
START = STATES
_NAMES = {
    "system": "system instruction instructions context",
    "user": "user human question q customer prompter prompt me",
    "assistant": "assistant ai bot model answer a agent gpt chatbot",
}
_CLASS = {name: 1 + r for r, role in enumerate(ROLES) for name in _NAMES[role].split()}
_OTHER = 4               # a marker that names no role, as "Speaker 2:"
_ANY = "|".join(sorted(_CLASS, key=len, reverse=True))
_MARKER = re.compile(
    rf"\s*(?:[\[<(]\|?\s*(?P<a>{_ANY})\s*\|?[\])>]\s*:?"
    rf"|[#*>\-\s]{{0,6}}(?P<b>{_ANY})\s*(?:\*\*)?\s*:(?:\*\*)?"
    rf"|\#+\s*(?P<c>{_ANY})\s*$"
    rf"|[#*>\-\s]{{0,6}}(?P<d>(?:speaker|person|participant)\s*\w{{0,3}})\s*:)\s*", re.I)
FEATURES = ("marker", "length", "asks")
_VALUES = {"marker": 5, "length": 5, "asks": 2}


def observe(line: str) -> tuple[tuple[int, int, int], str]:
    """((marker class, length class, asks), the line without its marker)."""
    m = _MARKER.match(line)
    kind, rest = 0, line
    if m:
        name = m["a"] or m["b"] or m["c"]
        kind = _CLASS[name.lower()] if name else _OTHER
        rest = line[m.end():]
    body = rest.strip()
    words = body.count(" ") + 1 if body else 0
    return (kind, 0 if not words else 1 + (words > 5) + (words > 20) + (words > 60), int(body.endswith("?"))), body


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


# -- the model ---------------------------------------------------------------

def _count_task(batches: Iterator) -> Iterator:
    """Counts of (feature, state, value) and of steps inside a turn, summed per batch."""
    from collections import Counter

    import pyarrow as pa

    for batch in batches:
        seen: Counter = Counter()
        for role, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            r = ROLES.index(role)
            lines = _lines(text.as_py())
            for k, line in enumerate(lines):
                state = 2 * r + (k > 0)
                for name, value in zip(FEATURES, observe(line)[0]):
                    seen[name, state, value] += 1
                if k:
                    seen["step", 2 * r + (k > 1), 2 * r + 1] += 1
            seen["end", r, min(len(lines), 2)] += 1
        rows = [(f, s, v, n) for (f, s, v), n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 4, (pa.string(), pa.int32(), pa.int32(), pa.int64()))],
                                         ["feature", "state", "value", "n"])


def train(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> dict:
    """Log probabilities from labelled raw turns: counts of line features per state and of steps between states, plus one.

    Rows whose role is none of ROLES, or null, teach nothing.
    """
    known = turns.where(F.col(role).isin(*ROLES))
    counts = (known.select(F.col(role).alias("role"), F.col(text).cast("string").alias("text"))
              .mapInArrow(_count_task, "feature string, state int, value int, n long")
              .groupBy("feature", "state", "value").agg(F.sum("n").alias("n")).collect())
    now = known.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.col(role).alias("role"))
    prior = known.select(F.col(conv).alias("c"), (F.col(turn) + 1).alias("t"), F.col(role).alias("prior"))
    pairs = now.join(prior, ["c", "t"], "left").groupBy("prior", "role").agg(F.count(F.lit(1)).alias("n")).collect()

    def logs(weights):
        total = sum(weights)
        return [math.log(w / total) for w in weights]

    seen = {(r["feature"], r["state"], r["value"]): r["n"] for r in counts}
    follow = {(r["prior"], r["role"]): r["n"] for r in pairs}
    emit = {f: [logs([1 + seen.get((f, s, v), 0) for v in range(_VALUES[f])]) for s in range(STATES)] for f in FEATURES}
    step = [[-math.inf] * STATES for _ in range(STATES + 1)]
    for r, name in enumerate(ROLES):
        short, long_ = seen.get(("end", r, 1), 0), seen.get(("end", r, 2), 0)
        inner = seen.get(("step", 2 * r + 1, 2 * r + 1), 0)
        nexts = logs([1 + follow.get((name, x), 0) for x in ROLES])
        for state, goes, ends in ((2 * r, long_, short), (2 * r + 1, inner, long_)):
            go, end = logs([1 + goes, 1 + ends])
            step[state][2 * r + 1] = go
            for x in range(len(ROLES)):
                step[state][2 * x] = end + nexts[x]
    for x, p in enumerate(logs([1 + follow.get((None, x), 0) for x in ROLES])):
        step[START][2 * x] = p
    return {"emit": emit, "step": step}


# -- decoding ----------------------------------------------------------------

def _scores(observed, model):
    """One row of emission scores per line."""
    import numpy as np

    tables = [np.array(model["emit"][f]).T for f in FEATURES]
    return sum(t[[o[k] for o in observed]] for k, t in enumerate(tables))


def _through(scores, model):
    """Max-plus matrix of a run of lines: best score from each state before it (START too) to each state at its end."""
    import numpy as np

    step = np.array(model["step"])
    now = step + scores[0]
    for row in scores[1:]:
        now = (now[:, :, None] + step[None, :STATES]).max(axis=1) + row
    return now


def _best_states(scores, model, before: int, end: int) -> list[int]:
    """Viterbi path of a run of lines between two given states."""
    import numpy as np

    step = np.array(model["step"])
    now, back = step[before] + scores[0], []
    for row in scores[1:]:
        ways = now[:, None] + step[:STATES]
        back.append(ways.argmax(axis=0))
        now = ways.max(axis=0) + row
    path = [end]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _block_lines(segments) -> list[tuple[int, int, str]]:
    """(seq, line number, line) of a block's segments in order; nulls first, equal seq by text."""
    ordered = sorted(segments, key=lambda s: (s["seq"] is not None, s["seq"] or 0, s["text"] or ""))
    return [(s["seq"], k, line) for s in ordered for k, line in enumerate(_lines(s["text"]))]


def _matrix_task(batches: Iterator, model: dict) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        out = []
        for segments in batch.column(2).to_pylist():
            observed = [observe(line)[0] for _, _, line in _block_lines(segments)]
            out.append(_through(_scores(observed, model), model).ravel().tolist())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], ["c", "block", "m"])


def _shape(flat):
    import numpy as np

    return np.array(flat, dtype=float).reshape(STATES + 1, STATES)


def _product(pdf):
    """One node: the max-plus product of its children."""
    pdf = pdf.sort_values("block")
    now = _shape(pdf["m"].iloc[0])
    for flat in pdf["m"].iloc[1:]:
        now = (now[:, :, None] + _shape(flat)[None, :STATES]).max(axis=1)
    return pdf[["c", "up"]].head(1).assign(m=[now.ravel().tolist()])


def _descend(pdf):
    """Given a node's states before it and at its end, those of each child."""
    pdf = pdf.sort_values("block").reset_index(drop=True)
    before, end = int(pdf["s"][0]), int(pdf["e"][0])
    mats = [_shape(flat) for flat in pdf["m"]]
    now, back = mats[0][before], []
    for m in mats[1:]:
        ways = now[:, None] + m[:STATES]
        back.append(ways.argmax(axis=0))
        now = ways.max(axis=0)
    path = [end]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    return pdf[["c", "block"]].assign(s=[before, *path[:-1]], e=path)


def _boundary_states(matrices: DataFrame, ctype: str) -> DataFrame:
    """(c, block, s, e): the state before each block and at its end on the best path of its transcript."""
    levels = [matrices]
    while levels[-1].agg(F.max("block")).first()[0]:
        up = levels[-1].withColumn("up", F.floor(F.col("block") / BLOCK).cast("long"))
        levels.append(scratch(up.groupBy("c", "up").applyInPandas(_product, f"c {ctype}, up long, m array<double>")
                                  .withColumnRenamed("up", "block")))
    first = F.slice("m", START * STATES + 1, STATES)
    states = levels.pop().select("c", "block", F.lit(START).alias("s"), (F.array_position(first, F.array_max(first)) - 1).cast("int").alias("e"))
    for below in reversed(levels):
        nodes = states.withColumnRenamed("block", "up")
        states = (below.withColumn("up", F.floor(F.col("block") / BLOCK).cast("long")).join(nodes, ["c", "up"])
                  .groupBy("c", "up").applyInPandas(_descend, f"c {ctype}, block long, s int, e int"))
    return states


def _piece_task(batches: Iterator, model: dict, ctype: str) -> Iterator:
    """Pieces of turns in each block; a piece without a start goes on from an earlier block."""
    import pyarrow as pa

    fields = [("seq", pa.int64()), ("line", pa.int32()), ("role", pa.string()), ("text", pa.string())]
    for batch in batches:
        out = []
        for segments, before, end in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            lines = _block_lines(segments)
            seen = [observe(line) for _, _, line in lines]
            states = _best_states(_scores([o for o, _ in seen], model), model, before, end)
            pieces: list[dict] = []
            for (seq, k, _), (_, body), state in zip(lines, seen, states):
                if state % 2 == 0 or not pieces:
                    begins = state % 2 == 0
                    pieces.append({"seq": (-1 if seq is None else seq) if begins else None, "line": k if begins else None,
                                   "role": ROLES[state // 2], "text": [body]})
                else:
                    pieces[-1]["text"].append(body)
            out.append([p | {"text": "\n".join(p["text"])} for p in pieces])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct(fields)))], ["c", "block", "pieces"])


def format_chats(segments: DataFrame, model: dict, conv: str = "conv_id", seq: str = "seq", text: str = "text") -> DataFrame:
    """One row per recovered turn: conv_id, start_seq, start_line, role, text, rendered.

    ``rendered`` is ``<|im_start|>role\\ntext<|im_end|>``, text without markers and outer white space. Segments of a
    transcript are ordered by seq (nulls first, reported as -1; equal seq by text), split at line feeds, and their borders tell the model
    nothing. Rows that repeat exactly stand once. Null texts are one empty line. Null conversation ids are one
    transcript. Seqs below 0 belong to the first block. An empty table gives an empty result. Only the three named columns are read.
    """
    ctype = dict(segments.dtypes)[conv]
    rows = segments.select(F.col(conv).alias("c"), F.col(seq).cast("long").alias("seq"), F.col(text).cast("string").alias("text")).distinct()
    blocks = scratch(rows.groupBy("c", F.greatest(F.floor(F.coalesce("seq", F.lit(0)) / BLOCK), F.lit(0)).cast("long").alias("block"))
                         .agg(F.collect_list(F.struct("seq", "text")).alias("segments")))
    matrices = scratch(blocks.mapInArrow(partial(_matrix_task, model=model), f"c {ctype}, block long, m array<double>"))
    # null conversations need a null-safe key
    states = _boundary_states(matrices.withColumn("c", F.struct("c")), f"struct<c:{ctype}>").withColumnRenamed("block", "b").withColumnRenamed("c", "k")
    placed = blocks.join(states, F.col("c").eqNullSafe(F.col("k.c")) & (F.col("block") == F.col("b"))).select("c", "block", "segments", "s", "e")
    pieces = scratch(placed.mapInArrow(
        partial(_piece_task, model=model, ctype=ctype),
        f"c {ctype}, block long, pieces array<struct<seq:long,line:int,role:string,text:string>>"))

    # The start of a turn that goes on from an earlier block: the last start before it, found in two levels of windows.
    at = F.struct(F.col("seq"), F.col("line"))
    last = pieces.select("c", "block", F.floor(F.col("block") / BLOCK).alias("g"), F.try_element_at(
        F.filter("pieces", lambda p: p["seq"].isNotNull()), F.lit(-1)).alias("p")) \
        .select("c", "block", "g", F.when(F.col("p").isNotNull(), F.struct("p.seq", "p.line", "p.role")).alias("start"))
    near = last.withColumn("in_group", F.last("start", ignorenulls=True).over(
        Window.partitionBy("c", "g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    whole = last.groupBy("c", "g").agg(F.max_by("start", F.when(F.col("start").isNotNull(), F.col("block"))).alias("start"))
    earlier = whole.select(F.col("c").alias("wc"), F.col("g").alias("wg"), F.last("start", ignorenulls=True).over(
        Window.partitionBy("c").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)).alias("before_group"))
    carried = near.join(earlier, F.col("c").eqNullSafe(F.col("wc")) & (F.col("g") == F.col("wg"))).select(
        F.col("c").alias("kc"), F.col("block").alias("kb"), F.coalesce("in_group", "before_group").alias("carried"))
    each = (pieces.join(carried, F.col("c").eqNullSafe(F.col("kc")) & (F.col("block") == F.col("kb")))
            .select("c", "block", "carried", F.posexplode("pieces").alias("pos", "piece")))
    start = F.when(F.col("piece.seq").isNotNull(), F.struct("piece.seq", "piece.line", "piece.role")).otherwise(F.col("carried"))
    turns = (each.select("c", "block", "pos", "piece.text", start.alias("start"))
             .groupBy("c", "start").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "text"))).alias("parts")))
    body = F.btrim(F.array_join(F.transform("parts", lambda p: p["text"]), "\n"), F.lit(" \t\r\n"))
    return turns.select(F.col("c").alias(conv), F.col("start.seq").alias("start_seq"), F.col("start.line").alias("start_line"),
                        F.col("start.role").alias("role"), body.alias("text")).withColumn(
        "rendered", F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>")))
