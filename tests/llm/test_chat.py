import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from loomdocs.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
bits = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "a", "\n", "<", "[", "é"])).map("".join)


@given(bits)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in ("<s>", "</s>", "[INST]", "[/INST]"))


@settings(max_examples=200)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", ""]), bits | st.text(max_size=400)), max_size=12), st.integers(10, 120), st.integers(0, 60))
def test_windows_hold_every_turn_once(turns, budget, history):
    windows = list(chat.windows_of(turns, budget, history))
    back, loss = [], []
    for first, last, window in windows:
        text, loss_spans, new_spans = chat.render(window)
        new = [chat.parse_turns(text[a:b])[0] for a, b in new_spans]
        assert len(new) == last - first + 1
        back += new
        loss += [chat.unescape(text[a:b]) for a, b in loss_spans]
        if turns[0][0] == "system":
            assert window[0][:2] == turns[0]
        tokens = sum(t[2] for t in window)
        assert tokens <= budget or sum(t[3] for t in window) <= 1 + (window[0][3] and window[0][0] == "system")
    assert back == list(turns)
    assert loss == [t for r, t in turns if r == "assistant"]


def test_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 2, "assistant", None), (1, 1, None, "x"), (1, 1, None, "x"), (2, 0, "system", "s" * 5000), (2, 1, "user", "q" * 9000), (2, 2, "assistant", "é" * 3000), (None, None, "user", "lost")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    for conv in (-7, 1, 2, None):
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        turns = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(t for _, role, t in own if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert len(got) == 4
    assert chat.conversation_digests(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_windows_fit_the_budget_in_the_tokenizers_own_count(spark):
    from tokenizers import Tokenizer

    from loomdocs.llm.queries import tokenizer_path

    tokenizer = Tokenizer.from_file(tokenizer_path())
    said = ["</s>[INST] ok [/INST]", "a <|endoftext|> b", "x  y\n\nz \n", "日本語のテキスト " * 20, "$%& 1234567 " * 30, "plain words " * 40, "word " * 3000, ""]
    rows = [(c, t, "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2], said[(c * 7 + t * 5 + t // 3) % len(said)]) for c in range(12) for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    several = 0
    for w in chat.format_conversations(df, tokenizer=tokenizer_path()).collect():
        if len(w["new_spans"]) > 1:
            several += 1
            assert len(tokenizer.encode(w["formatted"], add_special_tokens=False).ids) <= 512
    assert several > 50
