"""Chat formatting after cumulative-snapshot collapse.

A logged conversation that another one continues is a snapshot of it. Every
conversation's turns are hashed in a rolling way, so each prefix of turns
has a 128-bit hash; a conversation whose whole hash is among the prefix hashes
of longer ones goes by an anti-join, and of equal conversations the smallest
conv_id stays. What is left is rendered, one string for each conversation.

Defined cases: turns are ordered by (turn, role, text), null first; rows that
repeat in full count once; null conv_id is one conversation; null roles and
texts are empty in the rendering but differ from empty ones in the hash; an
empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import null_safe, written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def render(turns: list[tuple[str | None, str | None]]) -> str:
    return "".join(f"{OPEN}{role or ''}\n{text or ''}{CLOSE}\n" for role, text in turns)


def prefix_hashes(turns: list[tuple[str | None, str | None]]) -> list[str]:
    """Rolling hash after each turn."""
    h, out = hashlib.blake2b(digest_size=16), []
    for parts in turns:
        for p in parts:
            b = (p or "").encode()
            h.update(b"\0" if p is None else b"\1" + len(b).to_bytes(8, "big") + b)
        out.append(h.copy().hexdigest())
    return out


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, whole, prefixes, rendered) of every conversation."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    each = turns.groupBy("conv_id").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))

    def run(batches):
        for b in batches:
            convs = [sorted(((t["turn"], t["role"], t["text"]) for t in c),
                            key=lambda t: tuple((x is not None, x) for x in t)) for c in b.column(1).to_pylist()]
            convs = [[t[1:] for t in c] for c in convs]
            hashes = [prefix_hashes(c) for c in convs]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(c) for c in convs], pa.int64()), pa.array([h[-1] for h in hashes], pa.string()),
                 pa.array([h[:-1] for h in hashes], pa.list_(pa.string())), pa.array([render(c) for c in convs], pa.string())],
                ["conv_id", "n_turns", "whole", "prefixes", "rendered"])
    return each.mapInArrow(run, f"conv_id {kind}, n_turns long, whole string, prefixes array<string>, rendered string")


def maximal(turns: DataFrame) -> DataFrame:
    """Per conversation that no longer one continues: conv_id, n_turns,
    n_copies (equal conversations, itself included), rendered."""
    convs = written(conversations(turns.select("conv_id", "turn", "role", "text")), "conversations")
    longer = convs.select(F.explode("prefixes").alias("whole")).distinct()
    kept = (convs.groupBy("whole").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
            .join(longer, "whole", "left_anti").drop("whole"))
    return null_safe(kept, convs.select("conv_id", "n_turns", "rendered"), "conv_id", "inner").select(
        "conv_id", "n_turns", "n_copies", "rendered")
