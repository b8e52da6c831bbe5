"""Reply trees as conversations: paths from root to leaf, ranked, formatted and read back.

A message points to the one it answers. The paths are found by self-joins that double the step: after k
rounds each leaf has its nearest 2^k ancestors. A path's score is the mean of its messages' scores;
the ``best`` paths of each tree are formatted, ties going to the smaller leaf.

The template puts ``<|im_start|>``, the role and a new line before each text, and a new line and ``<|im_end|>`` after it.
Control strings of this and other common templates inside a text get one more backslash before
those they have, which leaves no bare one and is undone by taking one away. Roles are in JSON's notation.

A null role or text is an empty one, a null score 0. Messages whose parent is null or missing are roots. Messages
on a circle have no root and are left out, as are those without a tree or an id. Ids must be unique
within a tree. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from eventloom.llm.tables import extended, written

LOSS_ROLE = "assistant"

# The strings that chat templates use as controls.
CONTROLS = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_CONTROL = "|".join(map(re.escape, CONTROLS))
_BARE = re.compile(rf"(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"\\(\\*)({_CONTROL})")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)\n<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _BARE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def format_turns(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the (start, end) code points under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"<|im_start|>{escape(json.dumps(role, ensure_ascii=False)[1:-1])}\n"
        body = escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "\n<|im_end|>\n"]
        at += len(head) + len(body) + len("\n<|im_end|>\n")
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((json.loads(f'"{unescape(found[1])}"'), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def reply_paths(messages: DataFrame, tree: str, node: str, parent: str) -> DataFrame:
    """(tree, leaf, node, depth): every message of each path, ``depth`` counted from the leaf."""
    known = messages.where(F.col(tree).isNotNull() & F.col(node).isNotNull())
    nodes = written(known.select(F.col(tree).alias("tree"), F.col(node).alias("node"), F.col(parent).alias("up")), "nodes")
    ids = nodes.select("tree", F.col("node").alias("up"))
    jumps = written(nodes.where("up IS NOT NULL").join(ids, ["tree", "up"], "left_semi").select("tree", "node", "up"), "jumps")
    leaves = nodes.join(jumps.select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti")
    paths = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("depth")), "paths")
    roots = nodes.join(jumps.select("tree", "node"), ["tree", "node"], "left_anti").select("tree", "node")
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    step = 1
    while step < largest:
        longer = paths.join(jumps, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("depth") + step).alias("depth"))
        paths = written(paths.unionByName(longer), "paths")
        step *= 2
        if step < largest:
            further = jumps.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
            jumps = written(jumps.join(further, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")), "jumps")
            if not jumps.take(1):
                break
    rooted = paths.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf").distinct()
    return paths.join(rooted, ["tree", "leaf"], "left_semi").select("tree", "leaf", "node", "depth")


def best_conversations(
    messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None = None, best: int = 1
) -> DataFrame:
    """(tree, leaf, score, turns): the best paths of each tree, ``turns`` an array of (role, text) from the root on."""
    value = F.lit(0.0) if score is None else F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    said = messages.select(
        F.col(tree).alias("tree"), F.col(node).alias("node"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"), value.alias("value")
    )
    paths = written(reply_paths(messages, tree, node, parent), "reply-paths")
    scored = paths.join(said.select("tree", "node", "value"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.avg("value").alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= best).drop("place")
    turns = F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("at"), "role", "text")))
    return (
        paths.join(chosen, ["tree", "leaf"])
        .join(said.drop("value"), ["tree", "node"])
        .groupBy("tree", "leaf", "score")
        .agg(F.transform(turns, lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))
    )


def formatted(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conversations`` without ``turns``, with ``formatted`` and ``loss``, an array of (start, end)."""
    own = [c for c in conversations.columns if c != "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [format_turns([(t["role"], t["text"]) for t in turns], loss_role) for turns in batch.column(len(own)).to_pylist()]
            texts = pa.array([text for text, _ in out], pa.string())
            loss = pa.array([[{"start": a, "end": b} for a, b in spans] for _, spans in out], span)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], texts, loss], names=[*own, "formatted", "loss"])

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    picked = conversations.select(*own, "turns")
    schema = extended(picked.drop("turns").schema, formatted="string", loss="array<struct<start:bigint,end:bigint>>")
    return picked.mapInArrow(run, schema)


def read_back(conversations: DataFrame) -> DataFrame:
    """(tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of the result of ``formatted``."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_turns(text)
                masked = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                said = hashlib.sha256()
                for role, body in turns:
                    said.update(f"{role}\n{body}\n".encode())
                out.append((len(turns), said.hexdigest(), len(masked), hashlib.sha256(masked.encode()).hexdigest(), len(text)))
            cols = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols, kinds)], names=["tree", *names])

    picked = conversations.select("tree", "formatted", "loss")
    kinds = dict(zip(names, ["long", "string", "long", "string", "long"]))
    return picked.mapInArrow(run, extended(picked.select("tree").schema, **kinds))
