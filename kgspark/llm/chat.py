"""Chat formatting with loss masks aligned to token offsets.

A turn is rendered as ``### role:``, a line end, the text, ``</turn>`` and a line end. Inside texts and roles every
backslash and control string gets a backslash in front, so the rendering can be read back. A whole
rendered conversation is encoded once with character offsets; the sorted assistant spans are
intersected with the sorted token spans by binary search, which marks the tokens under the loss, and
the marked characters are the intersections, so a token that also covers a marker adds none of it.

Rows are range-partitioned by (conversation, turn) and sorted there, so a conversation of any length
is spread over tasks and rendered in order, ``BLOCK`` characters at a time at most plus one turn. Block
borders lie between turns, where the tokenizer always starts a new word (after a line end, before
``#``), so ids of the blocks in order are the ids of the whole.

Defined cases: null text or role counts as empty; rows of one turn number follow in order of role and
text, rows without turn come first; repeated rows are repeated turns; rows without ``conv_id`` form one
conversation; a conversation without assistant text has an empty mask; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kgspark.llm.common import small_batches
from kgspark.llm.tokens import encoder

BLOCK = 1_000_000
END = "</turn>\n"
_CONTROL = re.compile(r"(\\|### |</turn>)")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\\n]|\\.)*):\n((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int]:
    """The rendered turn and where its text begins."""
    head = "### " + escape(role).replace("\n", "\\\n") + ":\n"
    return head + escape(text) + END, len(head)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a rendered conversation or block."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def mask_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Tokens that overlap a span, and the overlapped characters of every span. Both inputs are sorted."""
    mask, under = np.zeros(len(offsets), np.uint8), []
    starts, ends = offsets[:, 0], np.maximum.accumulate(offsets[:, 1]) if len(offsets) else offsets[:, 1]
    for a, b in spans:
        first, last = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        if a < b and first < last:
            mask[first:last] = 1
            under.append((max(a, int(starts[first])), min(b, int(ends[last - 1]))))
    return mask, under


def format_conversations(turns: DataFrame, role: str = "assistant", block: int = BLOCK, vocabulary: str = "byte_bpe_50k",
                         folder: str | None = None) -> DataFrame:
    """Blocks (conv_id, turn, part, formatted, ids, mask, spans), ordered by (turn, part) within a conversation.

    ids are little-endian uint32, mask one byte per token (1: under the loss), spans the characters of
    ``formatted`` under the loss. ``turn`` is that of the block's first row.
    """
    spark = turns.sparkSession
    small_batches(spark)
    src = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    src = src.repartitionByRange("conv_id", "turn").sortWithinPartitions(*order)
    kinds = {c: src.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, part long, formatted string, ids binary, mask binary, spans array<struct<first:long,last:long>>"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, conv, open_, size = encoder(vocabulary, folder).full, 0, None, [], 0
        out: list[tuple] = []
        names: list[str] = ["conv_id", "turn", "part", "formatted", "ids", "mask", "spans"]
        kind = None

        def close() -> None:
            nonlocal part, open_, size
            texts, spans, at = [], [], 0
            for _, who, text in open_:
                shown, head = render(who, text)
                if who == role:
                    spans.append((at + head, at + len(shown) - len(END)))
                texts.append(shown)
                at += len(shown)
            whole = "".join(texts)
            e = enc.encode(whole, add_special_tokens=False)
            mask, under = mask_tokens(np.array(e.offsets, np.int64).reshape(-1, 2), spans)
            out.append((conv, open_[0][0], part, whole, np.array(e.ids, "<u4").tobytes(), mask.tobytes(), [{"first": a, "last": b} for a, b in under]))
            part, open_, size = part + 1, [], 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            types = [*kind, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for b in batches:
            kind = kind or [b.column(0).type, b.column(1).type]
            for c, t, who, text in zip(*(x.to_pylist() for x in b.columns)):
                if open_ and (c != conv or size >= block):
                    close()
                    if sum(len(o[3]) for o in out) >= block:
                        yield batch()
                conv = c
                open_.append((t, who, text))
                size += len(text) + len(who)
        if open_:
            close()
        if out:
            yield batch()

    return src.mapInArrow(blocks, schema)


def digests(blocks: DataFrame, role: str = "assistant") -> DataFrame:
    """Read conversations back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, n_loss_tokens.

    A digest is sequential by nature, so the blocks of a conversation are read in order by one task,
    one block in memory at a time.
    """
    src = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")
    kind = src.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, state, conv, type_ = [], None, None, None

        def done() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            types = [type_, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"])

        def close() -> None:
            n, turns, chars, loss, formatted, tokens, under = state
            rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, tokens, under))

        for b in batches:
            type_ = b.column(0).type
            for c, text, mask, spans in zip(*(b.column(k).to_pylist() for k in ("conv_id", "formatted", "mask", "spans"))):
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for who, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{who}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s in spans:
                    said = unescape(text[s["first"]:s["last"]])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += len(mask)
                state[6] += sum(mask)
            if len(rows) >= 4096:
                yield done()
        if state is not None:
            close()
        if rows:
            yield done()

    return src.mapInArrow(read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long")
