import itertools
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from abyssal.llm import chat, sequences
from abyssal.llm.chat import CONTROLS, MARKS, escape, format_conversations, loss_mask, read_back, unescape

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(t is not None, t or 0, role or "", digest(text or ""), text or "") for c, t, role, text in rows if c == conv]
        turns = [(role, text) for _, _, role, _, text in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        plain = {"user": "[INST]%s[/INST]", "assistant": "%s</s>", "system": "<<SYS>>%s<</SYS>>"}
        written = [plain[r] % escape(t) if r in plain else f"<<ROLE>>{escape(r)}<<TEXT>>{escape(t)}<</TEXT>>" for r, t in turns]
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), digest(said), sum(map(len, written)))
    return out


def check(spark, rows):
    formatted = format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3), VOCABULARY).persist()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in read_back(formatted, VOCABULARY).collect()}
    assert got == brute(rows)
    return formatted


def test_escapes_are_reversible():
    parts = ["<", "[", "/", "\\", "s>", "/s>", "<SYS>>", "INST]", "<|endoftext|>", " "]
    for n in range(1, 5):
        seen = {}
        for combination in itertools.product(parts, repeat=n):
            text = "".join(combination)
            safe = escape(text)
            assert unescape(safe) == text and not any(c in safe for c in CONTROLS)
            assert seen.setdefault(safe, text) == text


def test_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said), (1, 2, "assistant", "  two\r\n\tspaces ▁ é 日本 <|endoftext|>"), (1, 1, "user", "q"), (1, None, "system", "rules"),
            (1, 3, "assistant", ""), (1, 4, "assistant", "again"), (2, 0, "tool<</TEXT>>", "<\\/s>"), (2, 0, None, None), (2, 5, "", "x"), (3, 0, "assistant", None), (None, 1, "user", "no id"),
            (4, 1, "user", "same"), (4, 1, "user", "same"), (4, 1, "user", "other")]
    formatted = check(spark, rows)
    base = Tokenizer.from_file(VOCABULARY).get_vocab_size()
    for r in formatted.collect():
        assert len(r.ids) == len(r.loss) and max(r.ids) < base + len(MARKS)
    one = [r for r in formatted.collect() if r.conv_id == -1]
    ids, loss = sum((r.ids for r in one), []), sum((r.loss for r in one), [])
    assert [i - base for i in ids if i >= base] == [chat.USER, chat.USER_END, chat.END] and loss[-1] and not loss[0]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert read_back(format_conversations(empty, VOCABULARY), VOCABULARY).collect() == []


def test_one_conversation_over_many_tasks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_TOKENS", 200)
    rng = np.random.default_rng(1)
    words = ["the", "und", "<s>", "[/INST]", "été", "\n", "x" * 30]
    rows = [(7 if i % 3 else i, i // 2, ["user", "assistant", "critic"][i % 3], " ".join(rng.choice(words, 20))) for i in range(900)]
    formatted = check(spark, rows)
    hot = [r for r in formatted.collect() if r.conv_id == 7]
    assert len({r.part for r in hot}) > 2 and len(hot) > 20 and not any(r.whole for r in hot)


def test_a_very_long_text(spark):
    check(spark, [(1, 0, "user", "long words " * 120_000 + "</s>"), (1, 1, "assistant", "z" * 300_000)])


def test_extra_columns_and_types(spark):
    rows = [("a", 1, "user", "t", 5, "x"), ("a", 2, "assistant", "u", 6, "y")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, part int, ids string")
    got = read_back(format_conversations(df, VOCABULARY), VOCABULARY).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [("a", 2, 1)]


def test_mask_from_running_sums():
    assert loss_mask(6, [(1, 3), (3, 4)]).tolist() == [False, True, True, True, False, False]
    assert loss_mask(0, []).tolist() == []


@pytest.mark.parametrize("per_task", [3, 1000])
def test_pieces_are_hashed_in_order(spark, monkeypatch, per_task):
    monkeypatch.setattr(sequences, "PIECE_CHARS", 20)
    rows = [(k, v) for k in ("a", "b", None) for v in range(0, 300, 1 if k == "a" else 50)]
    df = spark.createDataFrame(rows, "k string, v bigint").repartition(4)
    pieces = sequences.pieces_of(df, "k", "v", tasks=12 if per_task == 3 else 1)
    got = {r.k: (r.text_sha256, r.text_chars) for r in sequences.hashed_in_order(pieces, "k", {"text": ","}, 4).collect()}
    want = {k: ",".join(str(v) for kk, v in sorted(rows, key=lambda r: r[1]) if kk == k) for k in ("a", "b", None)}
    assert {k: v[0] for k, v in got.items()} == {k: digest(t) for k, t in want.items()}
