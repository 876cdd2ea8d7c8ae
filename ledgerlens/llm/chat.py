"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, and that reply alone trainable.
Turns after the last reply, or a conversation without a reply, give one further example with nothing trainable, so
that no turn is lost. The template is `### <role>: <text></turn>\n`; a backslash before a backslash, `### `, `</turn>` or a
colon (the last in roles) escapes them, so that control strings in a text stay text and every example parses back.

Defined results: null text and null role: empty. Rows of one turn number keep their order by role, then text. A null
conversation id is a conversation of its own. Repeated rows stay repeated turns. Other columns are ignored. The
expansion is quadratic in the turns of a conversation by nature; examples are streamed one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's control strings.
OPEN, CLOSE, SEP = "### ", "</turn>", ": "
TARGET_ROLE = "assistant"
EXAMPLE = "conv_id long, example int, is_last boolean, formatted string, loss_start long, loss_end long"
PARSED = "conv_id long, example int, n_turns long, turns_sha256 string, reply string, formatted_chars long"

_ESCAPE = re.compile(r"\\|### |</turn>")
_ESCAPE_ROLE = re.compile(r"\\|### |</turn>|:")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*?): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text lies in it."""
    head = OPEN + _ESCAPE_ROLE.sub(lambda m: "\\" + m[0], role) + SEP
    body = escape(text)
    return head + body + CLOSE + "\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted example; ValueError if it isn't one."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return found


def examples(conversations: DataFrame, target_role: str = TARGET_ROLE) -> DataFrame:
    """EXAMPLE rows from rows (conv_id, turn, role, text)."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for conv, turns in zip(batch["conv_id"], batch["turns"], strict=True):
                prefix, k = "", 0
                for i, t in enumerate(turns):
                    text, a, b = turn(t["role"], t["text"])
                    start = len(prefix)
                    prefix += text
                    last = i == len(turns) - 1
                    if t["role"] == target_role or last:
                        target = t["role"] == target_role
                        held.append((conv, k, last, prefix, start + a if target else 0, start + b if target else 0))
                        size += len(prefix)
                        k += 1
                    if size > 4_000_000:
                        yield pd.DataFrame(held, columns=["conv_id", "example", "is_last", "formatted", "loss_start", "loss_end"])
                        held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=["conv_id", "example", "is_last", "formatted", "loss_start", "loss_end"])

    return whole.mapInPandas(expand, EXAMPLE)


def read_back(formatted: DataFrame) -> DataFrame:
    """PARSED rows: the last example of a conversation gives its turns, each example its trainable text."""
    import hashlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                n = digest = None
                if r.is_last:
                    turns = parse(r.formatted)
                    n, digest = len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode("utf-8", "surrogatepass")).hexdigest()
                out.append((r.conv_id, r.example, n, digest, unescape(r.formatted[r.loss_start : r.loss_end]), len(r.formatted)))
            yield pd.DataFrame(out, columns=["conv_id", "example", "n_turns", "turns_sha256", "reply", "formatted_chars"])

    return formatted.mapInPandas(run, PARSED)


def digest(parsed: DataFrame) -> DataFrame:
    """One row for each conversation."""
    reply = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "")
    return (
        parsed.groupBy("conv_id")
        .agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), reply.alias("loss"), F.sum("formatted_chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_examples")
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and the contract's conversation -7, whose texts hold control strings; rows that are there under that
    id already are further turns of it."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    text = "\\### Assistant: </turn> ok"
    probe = rows.sparkSession.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    return rows.unionByName(probe)
