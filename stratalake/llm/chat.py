"""Preference formatting of chat conversations.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns
(same role, same text) is rendered once as the prompt; what follows it in either is
rendered as a completion with the spans that training counts: the text and the end
mark of the turns of ``LEARNED`` roles. Turns of other roles, and all headers, are masked.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADER = "<|im_start|>{role}\n"
END = "<|im_end|>\n"
LEARNED = ("assistant",)

SPANS = "array<struct<start: int, length: int>>"
PAIR = f"pair_id long, prompt_turns int, prompt string, chosen string, chosen_spans {SPANS}, rejected string, rejected_spans {SPANS}"


def render(turns: list[tuple], learned=LEARNED) -> tuple[str, list[tuple[int, int]]]:
    """Text of the turns (role, text), and the learned spans (start, length) in code points."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = HEADER.format(role=role or "")
        body = (text or "") + END
        if role in learned:
            spans.append((at + len(head), len(body)))
        out += [head, body]
        at += len(head) + len(body)
    return "".join(out), spans


def common_turns(a: list[tuple], b: list[tuple]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _turns(df: DataFrame, name: str, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("pair_id"))
    return rows.agg(F.sort_array(F.collect_list(turn)).alias(name))


def format_pairs(
    chosen: DataFrame,
    rejected: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned=LEARNED,
) -> DataFrame:
    """One row per id of either side: the columns of ``PAIR``.

    Turns are ordered by turn, then role and text (nulls first); a null role or text
    is rendered as empty, but differs from an empty one. A conversation that is missing
    on one side has no turns there; equal conversations have empty completions. Rows
    with a null id belong to no pair. A conversation is one row of the result and is
    held by one task; conversations are spread by id. Other columns are ignored.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        for batch in batches:
            out: dict[str, list] = {k: [] for k in names}
            for row in batch.to_pylist():
                a, b = ([(t["role"], t["text"]) for t in row[k] or []] for k in ("chosen", "rejected"))
                n = common_turns(a, b)
                (one, one_spans), (two, two_spans) = render(a[n:], learned), render(b[n:], learned)
                made = (row["pair_id"], n, render(a[:n])[0], one, one_spans, two, two_spans)
                for k, v in zip(names, made):
                    out[k].append(v)
            arrays = []
            for k in names:
                if k.endswith("spans"):
                    arrays.append(pa.array([[{"start": s, "length": m} for s, m in v] for v in out[k]], span))
                else:
                    arrays.append(pa.array(out[k], {"pair_id": pa.int64(), "prompt_turns": pa.int32()}.get(k, pa.string())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["pair_id", "prompt_turns", "prompt", "chosen", "chosen_spans", "rejected", "rejected_spans"]
    cols = (id_col, turn_col, role_col, text_col)
    both = _turns(chosen, "chosen", *cols).join(_turns(rejected, "rejected", *cols), "pair_id", "full")
    return both.mapInArrow(run, PAIR)


def with_foreign_reply(conversations: DataFrame) -> DataFrame:
    """A rejected side for a table of conversations: each conversation with its last
    assistant turn's text taken from the last assistant turn of its neighbour (id with
    the lowest bit flipped), or without that turn if the neighbour has none."""
    said = conversations.where((F.col("role") == "assistant") & F.col("conv_id").isNotNull())
    last = said.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    own = last.select("conv_id", F.col("last.turn").alias("at"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("reply"), F.lit(True).alias("has"))
    rows = conversations.select("conv_id", "turn", "role", "text").join(own, "conv_id", "left").join(other, "conv_id", "left")
    swap = F.coalesce((F.col("turn") == F.col("at")) & (F.col("role") == "assistant"), F.lit(False))
    return rows.where(~swap | F.coalesce("has", F.lit(False))).select(
        "conv_id", "turn", "role", F.when(swap, F.col("reply")).otherwise(F.col("text")).alias("text")
    )
