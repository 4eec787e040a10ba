"""Conversations as token ids with a loss mask, assembled segment by segment.

Texts are encoded apart from the template, whose marks are reserved ids above the vocabulary and never come out of a text. A control
string inside a text is escaped all the same, so the plain rendering of the ids can be read back too. The loss mask is the running sum
of +1 where an assistant's text begins and -1 behind the id that ends it. A turn is written

    user       [INST] text [/INST]         assistant   text </s>
    system     <<SYS>> text <</SYS>>       others      <<ROLE>> role <<TEXT>> text <</TEXT>>

without the blanks. The output has one row for each piece of a conversation: one for nearly all of them, several for very long ones.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import write_and_read
from abyssal.llm.sequences import arrow_rows, hashed_in_order, in_ranges, tasks_for

MARKS = ["</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>", "<</TEXT>>"]
END, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, TEXT, TEXT_END = range(len(MARKS))
OPENS = {"user": (USER, USER_END), "system": (SYSTEM, SYSTEM_END)}
NAMES = {opens: role for role, (opens, _) in OPENS.items()}
#: Marks of the template, and strings that this or a common vocabulary reads as control tokens.
CONTROLS = [*MARKS, "<s>", "<|endoftext|>"]
PIECE_TOKENS = 1 << 16
ENCODE_CHARS = 1 << 18  # encoded at once
CHARS_PER_TASK = 4 << 20


def _pattern(slashes: str) -> re.Pattern:
    return re.compile("|".join(re.escape(c[0]) + slashes + re.escape(c[1:]) for c in CONTROLS))


_PLAIN, _ESCAPED = _pattern(r"\\*"), _pattern(r"\\+")


def escape(text: str) -> str:
    """A backslash behind the first character of every control string, one more where backslashes stand there already.

    Control strings begin with ``<`` or ``[``, end with ``>`` or ``]`` and do not overlap, so `unescape` finds the same places again.
    """
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


@lru_cache(maxsize=1)
def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work to cores
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(definition)
    made.encode_special_tokens = True
    made.no_truncation()
    made.no_padding()
    return made


def _encoded(rows: Iterator[tuple], tokenizer, base: int) -> Iterator[tuple]:
    """(conv_id, ids, first and last index under the loss mask) of every turn's segment; texts are encoded in bounded groups."""

    def groups() -> Iterator[list[tuple]]:
        held, chars = [], 0
        for row in rows:
            held.append(row)
            chars += len(row[1]) + len(row[2])
            if chars >= ENCODE_CHARS:
                yield held
                held, chars = [], 0
        if held:
            yield held

    for group in groups():
        strings = [escape(text) for _, _, text in group] + [escape(role) for _, role, _ in group if role not in OPENS and role != "assistant"]
        ids = [e.ids for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        names = iter(ids[len(group):])
        for (conv, role, _), content in zip(group, ids):
            if role == "assistant":
                yield conv, [*content, base + END], (0, len(content) + 1)
            elif role in OPENS:
                opens, closes = OPENS[role]
                yield conv, [base + opens, *content, base + closes], (0, 0)
            else:
                yield conv, [base + ROLE, *next(names), base + TEXT, *content, base + TEXT_END], (0, 0)


def loss_mask(length: int, spans: list[tuple[int, int]]) -> np.ndarray:
    steps = np.zeros(length + 1, dtype=np.int32)
    for start, end in spans:
        steps[start] += 1
        steps[end] -= 1
    return np.cumsum(steps[:-1]) > 0


def format_conversations(df: DataFrame, tokenizer: str) -> DataFrame:
    """The formatted conversations: conv_id, part, piece, whole, ids, loss; a conversation is its rows in order of (part, piece).

    ``tokenizer`` is the path of a lossless byte-level vocabulary file. Rows come in order of turn, null first; ties go by role, then by
    the text's SHA-256, and repeated rows are all kept. A null role or text is empty; rows whose conv_id is null are one conversation.
    An empty table gives no rows; columns other than conv_id, turn, role and text are not read. Rows are dealt by ranges of
    (conv_id, turn, ...), so a conversation of any length spreads over tasks; ``whole`` marks pieces that are all of theirs.
    """
    definition = df.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    size = df.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    tasks = max(tasks_for(size.n), 1 + (size.chars or 0) // CHARS_PER_TASK)
    turns = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = in_ranges(turns, [F.col("conv_id"), F.col("turn"), F.col("role"), F.sha2("text", 256)], tasks).select("conv_id", "role", "text")
    schema = f"conv_id {df.schema['conv_id'].dataType.simpleString()}, part int, piece bigint, whole boolean, ids array<int>, loss array<boolean>"

    def work(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        tok = _tokenizer(definition.value)
        ahead: tuple | None = None
        at_start = True
        for conv, run in itertools.groupby(_encoded(rows, tok, tok.get_vocab_size()), key=lambda r: r[0]):
            if ahead is not None:
                yield ahead
            ids, spans, piece = [], [], 0
            for _, segment, (start, end) in run:
                if ids and len(ids) + len(segment) > PIECE_TOKENS:
                    yield conv, task, piece, False, np.array(ids, dtype=np.int32), loss_mask(len(ids), spans)
                    ids, spans, piece = [], [], piece + 1
                if end:
                    spans.append((len(ids) + start, len(ids) + end))
                ids.extend(segment)
            ahead = (conv, task, piece, piece == 0 and not at_start, np.array(ids, dtype=np.int32), loss_mask(len(ids), spans))
            at_start = False
        if ahead is not None:  # the last conversation may go on in the next task
            yield (*ahead[:3], False, *ahead[4:])

    return arrow_rows(ordered, schema, work, lambda r: len(r[4]))


def _turns(ids: np.ndarray, loss: np.ndarray, tokenizer, base: int) -> Iterator[tuple[str, str, str | None, int]]:
    """(role, text, text under the loss mask or None, characters written) of every turn of a piece, from the ids and the mask."""
    marks = np.flatnonzero(ids >= base).tolist()
    spans: list[tuple[int, int]] = []
    turns: list[tuple[int, int | None]] = []  # opening mark, number of marks' characters
    at, i = 0, 0
    while at < len(ids):
        mark = int(ids[at]) - base
        if mark == ROLE:
            spans += [(at + 1, marks[i + 1]), (marks[i + 1] + 1, marks[i + 2])]
            turns.append((mark, len(MARKS[ROLE] + MARKS[TEXT] + MARKS[TEXT_END])))
            i += 3
        elif mark in NAMES:
            spans.append((at + 1, marks[i + 1]))
            turns.append((mark, len(MARKS[mark]) + len(MARKS[OPENS[NAMES[mark]][1]])))
            i += 2
        else:  # an assistant's text stands bare before its end
            spans.append((at, marks[i]))
            turns.append((END, len(MARKS[END])))
            i += 1
        at = marks[i - 1] + 1
    # the mask, not the role, says what is under the loss
    masked = [(a + int(np.argmax(m)), a + int(np.argmax(m)) + int(m.sum())) if (m := loss[a:b]).any() else None for a, b in spans]
    texts = tokenizer.decode_batch([ids[a:b].tolist() for a, b in spans], skip_special_tokens=False)
    found = iter(zip(spans, texts, masked))
    for mark, chars in turns:
        name = NAMES.get(mark, "assistant")
        if mark == ROLE:
            _, written, _ = next(found)
            name, chars = unescape(written), chars + len(written)
        span, written, under = next(found)
        said = None
        if under is not None:
            said = unescape(written if under == span else tokenizer.decode(ids[slice(*under)].tolist(), skip_special_tokens=False))
        yield name, unescape(written), said, chars + len(written)


def _read(formatted: DataFrame, definition, digest: bool) -> DataFrame:
    """Per piece: conv_id, part, piece, n_turns, formatted_chars and what is read of it: digests, or (``digest`` false) the texts."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    rest = "turns_sha256 string, loss_chars bigint, loss_sha256 string" if digest else "turns string, loss string"
    schema = f"conv_id {kind}, part int, piece bigint, n_turns bigint, formatted_chars bigint, {rest}"

    def work(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        tok = _tokenizer(definition.value)
        base = tok.get_vocab_size()
        for conv, part, piece, ids, loss in rows:
            read = list(_turns(np.array(ids, dtype=np.int64), np.array(loss, dtype=bool), tok, base))
            turns = "".join(f"{role}\n{text}\n" for role, text, _, _ in read)
            said = "".join(s for _, _, s, _ in read if s is not None)
            head = (conv, part, piece, len(read), sum(c for *_, c in read))
            if digest:
                yield *head, sha256(turns.encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest()
            else:
                yield *head, turns, said

    pieces = formatted.select("conv_id", "part", "piece", "ids", "loss")
    return arrow_rows(pieces, schema, work, lambda r: 0 if digest else len(r[5]) + len(r[6]))


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation, from the formatted ids and masks alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Conversations of one piece are digested where they are read. The texts of the others (at most two a task, and the very long ones)
    are hashed as streams.
    """
    definition = formatted.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    alone = _read(formatted.filter("whole"), definition, digest=True).select(columns)
    pieces = write_and_read(_read(formatted.filter(~F.col("whole")), definition, digest=False))
    sums = pieces.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"))
    tasks = tasks_for(sums.count())
    hashed = hashed_in_order(pieces, "conv_id", {"turns": "", "loss": ""}, tasks).withColumnRenamed("conv_id", "__id")
    split = sums.join(hashed, F.col("conv_id").eqNullSafe(F.col("__id"))).select(columns)
    return alone.unionByName(split)
