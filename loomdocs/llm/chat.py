"""Chat formatting in budgeted, turn-aligned windows with loss masks (operator 1)."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_texts, tasks_for
from .token_output import share_encoder

#: A turn ends with its line, so tokenizers that part words at a line's end count turns as they count their window.
OPEN, CLOSE, HEAD = "<s>", "</s>\n", "[INST]"
#: The template's control strings, and with one or more backslashes their escaped forms.
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
#: The turn mark: <s>[INST]role[/INST]text</s> and a line end
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>\n", re.S)
#: Tokens that a turn's marks count for.
MARK_TOKENS = 6


def escape(text: str) -> str:
    """Put a backslash into every control string (and one more into an escaped one)."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The turn in the template, and where its text begins."""
    head = f"{OPEN}{HEAD}{escape(role)}[/INST]"
    return f"{head}{escape(text)}{CLOSE}", len(head)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def estimate_tokens(text: str) -> int:
    """Tokens of a text without a tokenizer: one for four bytes, and the marks."""
    return -(-len(text.encode("utf-8", "surrogatepass")) // 4) + MARK_TOKENS


def windows_of(turns, budget: int, history: int):
    """Turn-aligned windows of a conversation, streamed.

    turns: (role, text, tokens) in order; tokens may be left out and are then
    estimated. With prefix sums P of the turns' tokens a window takes the longest
    run of new turns a..b with P[b] - P[a] within the budget that the system turn
    and the repeated history leave; the history is the longest run before a
    within `history` tokens and what the first new turn leaves. The system turn
    stands in every window; only a window with one new turn may be above the
    budget. Yields (first new turn, last new turn, turns as (role, text, tokens,
    is_new)).
    """
    head, held, sums = [], [], [0]  # sums[i]: tokens before held[i], from some turn on
    fixed = new = n = first = 0

    def window():
        return first, n - 1, [*head, *[(*t, i >= new) for i, t in enumerate(held)]]

    for role, text, *counted in turns:
        tokens = counted[0] if counted else estimate_tokens(text)
        if n == 0 and role == "system":
            head, fixed, n = [(role, text, tokens, True)], tokens, 1
            continue
        if n > first and fixed + sums[-1] - sums[0] + tokens > budget:
            yield window()
            head = [(*t[:3], False) for t in head]
            at = min(bisect_left(sums, sums[-1] - min(history, budget - fixed - tokens)), len(held))
            held, sums, first = held[at:], sums[at:], n
            new = len(held)
        held.append((role, text, tokens))
        sums.append(sums[-1] + tokens)
        n += 1
    if n > first:
        yield window()


def render(turns) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]]]:
    """Text of a window; code-point spans under the loss mask; spans of its new turns."""
    parts, loss, new, at = [], [], [], 0
    for role, text, _, is_new in turns:
        formatted, begin = format_turn(role, text)
        if is_new:
            new.append((at, at + len(formatted)))
            if role == "assistant":
                loss.append((at + begin, at + len(formatted) - len(CLOSE)))
        parts.append(formatted)
        at += len(formatted)
    return "".join(parts), loss, new


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_OUT = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("formatted", pa.string()), ("loss_spans", _SPANS), ("new_spans", _SPANS)])
_OUT_DDL = "conv_id long, window long, first_turn long, last_turn long, formatted string, loss_spans array<struct<start:long,end:long>>, new_spans array<struct<start:long,end:long>>"


def _by_conversation(batches, columns):
    """Rows of sorted batches, as (conv_id, iterator of its rows)."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", *columns)], strict=True))
    for conv_id, own in groupby(rows, key=lambda r: r[0]):
        yield conv_id, (r[1:] for r in own)


def _with_tokens(rows: DataFrame, tokenizer: str | None) -> DataFrame:
    """Add the tokens of each formatted turn, before any shuffle."""

    def count(batch):
        texts = [format_turn(role, text)[0] for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        tokens = [len(ids) // 4 for ids in shared.value.get().encode(texts)]
        yield batch.append_column("tokens", pa.array(tokens, pa.int64()))

    if tokenizer is None:
        return rows.withColumn("tokens", F.ceil(F.octet_length("text") / 4).cast("long") + MARK_TOKENS)
    shared = share_encoder(rows.sparkSession, tokenizer)
    return map_texts(rows, count, "conv_id long, turn long, role string, text string, tokens long")


def format_conversations(conversations: DataFrame, budget: int = 512, history: int = 128, tokenizer: str | None = None) -> DataFrame:
    """One row per window: conv_id, window, first_turn, last_turn, formatted, loss_spans, new_spans.

    Each window has the system turn, a limited history of turns that earlier
    windows held, and new turns, within `budget` tokens. Only assistant texts of
    new turns are under the loss mask (code-point spans), so each is a target
    once. Control strings inside texts and roles are escaped reversibly.

    A turn's tokens are those that the tokenizer (a file of the tokenizers
    library) makes of the formatted turn, marks and escapes included; they are
    counted where the rows are read. Without a tokenizer they are estimated from
    the bytes. A turn that doesn't fit beside the system turn has a window of its
    own above the budget; a very long text is never cut.

    Rows are sorted by (conv_id, turn, role, text) in the shuffle and streamed:
    a task holds one window at a time, however long a conversation is. Null
    texts and roles are empty; null turns come first; null conv_ids are a
    conversation of their own. Repeated rows are turns of their own. An empty
    table gives no rows; other columns are ignored.
    """
    spark = conversations.sparkSession
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _with_tokens(rows, tokenizer).repartition(tasks_for(spark), "conv_id").sortWithinPartitions(*order)

    def run(batches):
        out = []
        size = 0
        for conv_id, turns in _by_conversation(batches, ("role", "text", "tokens")):
            for number, (first, last, window) in enumerate(windows_of(turns, budget, history)):
                text, loss, new = render(window)
                spans = [[{"start": a, "end": b} for a, b in x] for x in (loss, new)]
                out.append((conv_id, number, first, last, text, *spans))
                size += len(text)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)

    return rows.mapInArrow(run, _OUT_DDL)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Read formatted windows back: turns from new spans, targets from the loss mask, one row per conversation."""
    rows = windows.repartition(tasks_for(windows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "window")

    def run(batches):
        out = []
        for conv_id, own in _by_conversation(batches, ("formatted", "loss_spans", "new_spans")):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = n_windows = 0
            for text, loss_spans, new_spans in own:
                n_windows += 1
                chars += len(text)
                for span in new_spans:
                    ((role, said),) = parse_turns(text[span["start"] : span["end"]])
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for span in loss_spans:
                    said = unescape(text[span["start"] : span["end"]])
                    loss.update(said.encode("utf-8", "surrogatepass"))
                    loss_chars += len(said)
            out.append((conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_windows))
            if len(out) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _DIGEST, strict=True)], schema=_DIGEST)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _DIGEST, strict=True)], schema=_DIGEST)

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
