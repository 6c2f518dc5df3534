"""Conversations as one text, with the tokens a model should learn from.

A whole conversation is rendered and encoded once. The encoder gives the span
of every token; the spans of the assistants' texts are known from rendering.
Both are sorted, so the tokens of a text are found by binary search, and the
loss covers the part of each token that lies within the text.

    <turn>role
    text</turn>

Inside roles and texts a backslash is doubled and every control string gets
a backslash after its first letter, so that it is no longer one. In roles a
line feed gets a backslash too. Removing the first of every two letters
``\\x`` gives the text back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import map_batches, merged

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
OPEN, CLOSE = "<turn>", "</turn>"
CONTROL = [OPEN, CLOSE, "<|endoftext|>"]
LEARNED = "assistant"
TURN = re.compile(r"<turn>((?:[^\\\n]|\\.)*)\n(.*?)</turn>\n", re.DOTALL)
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
OUT = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_tokens", SPAN),
        T.StructField("loss_spans", SPAN),
    ]
)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for word in CONTROL:
        text = text.replace(word, word[0] + "\\" + word[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text, and the spans in it of what is learned."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
        body = escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE + "\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def loss_of(starts: np.ndarray, ends: np.ndarray, turns: list[tuple[int, int]]) -> tuple[list, list]:
    """Token ranges that touch each turn's span, and the letters of the span
    that those tokens cover."""
    tokens, letters = [], []
    for a, b in turns:
        i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        if a < b and i < j:
            tokens.append({"start": i, "end": j})
            s, e = merged(np.maximum(starts[i:j], a), np.minimum(ends[i:j], b))
            letters += [{"start": int(x), "end": int(y)} for x, y in zip(s, e, strict=True) if x < y]
    return tokens, letters


_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """The encoder; turn marks are tokens of their own and spans hold spaces."""
    if path not in _TOKENIZERS:
        from tokenizers import AddedToken, Tokenizer, processors

        t = Tokenizer.from_file(path)
        t.add_special_tokens([AddedToken(w, special=True, normalized=False) for w in CONTROL])
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def _conversations(batches, limit: int) -> Iterator[list[tuple[int, list[tuple[str, str]]]]]:
    """Whole conversations, some ``limit`` letters at a time, from sorted rows."""
    ready, size, who, turns = [], 0, None, None
    for batch in batches:
        for conv, role, text in zip(batch["conv"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if turns is None or conv != who:
                if turns is not None:
                    ready.append((who, turns))
                    if size > limit:
                        yield ready
                        ready, size = [], 0
                who, turns = conv, []
            turns.append((role or "", text or ""))
            size += len(text or "")
    if turns is not None:
        ready.append((who, turns))
    if ready:
        yield ready


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    tokenizer_path: str = TOKENIZER,
) -> DataFrame:
    """One row for each conversation: conv_id, n_turns, formatted, token_ids,
    loss_tokens (ranges of tokens) and loss_spans (ranges of letters).

    Rows are ordered by turn, then role, then text, nulls first; repeated rows
    are turns of their own. A null role or text is empty. Rows with a null id
    are one conversation. Other columns are not used. A conversation is in
    memory while it is rendered and encoded; the rows of one are never
    collected into a list by Spark, but stream in sorted order.
    """
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def work(batches):
        encoder = tokenizer(tokenizer_path)
        for some in _conversations(batches, 1 << 19):
            drawn = [render(turns) for _, turns in some]
            out = {f.name: [] for f in OUT.fields}
            for (conv, turns), (text, spans), found in zip(some, drawn, encoder.encode_batch([t for t, _ in drawn], add_special_tokens=False), strict=True):
                at = np.array(found.offsets, np.int64).reshape(-1, 2)
                tokens, letters = loss_of(at[:, 0], at[:, 1], spans)
                for name, value in (("conv_id", conv), ("n_turns", len(turns)), ("formatted", text), ("token_ids", found.ids), ("loss_tokens", tokens), ("loss_spans", letters)):
                    out[name].append(value)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), span, span]
            yield pa.record_batch([pa.array(out[f.name], k) for f, k in zip(OUT.fields, kinds, strict=True)], names=OUT.names)

    return ordered.mapInArrow(work, OUT)


def read_back(chats: DataFrame) -> DataFrame:
    """What formatted texts and masks say: digests of turns and of what is learned."""

    def work(rows: pa.Table):
        out = []
        for conv, text, spans in zip(rows["conv_id"].to_pylist(), rows["formatted"].to_pylist(), rows["loss_spans"].to_pylist(), strict=True):
            turns = parse(text)
            said = sha256()
            for role, body in turns:
                said.update(f"{role}\n{body}\n".encode())
            learned = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            out.append((conv, len(turns), said.hexdigest(), len(learned), sha256(learned.encode()).hexdigest(), len(text)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(chats.select("conv_id", "formatted", "loss_spans"), work, schema, "formatted")
