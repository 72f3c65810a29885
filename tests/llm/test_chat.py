import hashlib
import random

from tallyspark.llm import bpe, chat

SCHEMA = "conv_id long, turn long, role string, text string, window string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(turns):
    said = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in said if r == "assistant")
    return (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss))


def conversations(seed=1):
    rng = random.Random(seed)
    words = ["<s>", "</s>[INST] ok [/INST]", "&lt;", "&amp;", "hello", "\n", "é🙂", "<|im_end|>\n", "a longer word"]
    out = {}
    for c in range(25):
        turns = [("system", "be kind " * rng.randrange(30))] if c % 3 == 0 else []
        for k in range(rng.randrange(1, 14)):
            turns.append((("user", "assistant")[k % 2], " ".join(rng.choice(words) for _ in range(rng.randrange(60)))))
        out[c] = turns
    out[25] = [("system", "alone")]
    out[26] = [("user", "x " * 4000), ("assistant", "y " * 3000), ("system", "late"), ("tool\n<", "[1]")]
    out[27] = [(("user", "assistant")[k % 2], f"turn {k}") for k in range(300)]
    return out


def rows_of(conversations):
    return [(c, k, r, t, "w") for c, turns in conversations.items() for k, (r, t) in enumerate(turns)]


def test_formatted_windows_read_back(spark):
    given = conversations()
    turns = spark.createDataFrame(rows_of(given), SCHEMA)
    windows = chat.windows(turns, budget=300, history=60).cache()
    got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    assert set(got) == set(given)
    for c, said in given.items():
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(said), c
    coder = bpe.coder(bpe.default_vocabulary())
    repeated = 0
    for w in windows.collect():
        turns = chat.read_turns(w["text"])
        sizes = [len(coder.encode(x)) for x in (chat.START + t + chat.END for t in w["text"].replace(chat.START, chat.END).split(chat.END) if t)]
        assert abs(sum(sizes) - w["n_tokens"]) <= 2 * len(sizes)
        assert w["over_budget"] == (w["n_tokens"] > 300)
        new = turns[w["n_repeated"] :]
        assert new, "a window shows something new"
        if w["over_budget"]:
            assert len([r for r, _ in new if r != "system"]) == 1
        said = given[w["conv_id"]]
        if said[0][0] == "system" and said[0][1]:
            assert turns[0] == said[0]
        spans = [chat.unescape(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
        assert spans == [t for r, t in new if r == "assistant"]
        repeated += w["n_repeated"]
    assert repeated > 50


def test_control_strings_cannot_survive(spark):
    turns = spark.createDataFrame(rows_of(conversations()), SCHEMA)
    for w in chat.windows(turns).collect():
        body = w["text"].replace(chat.START, "").replace(chat.END, "")
        assert "<" not in body and "[" not in body


def test_unusual_rows(spark):
    rows = [(None, 1, None, None, ""), (None, None, "assistant", "first", ""), (1, 2, "user", "b", ""), (1, 2, "user", "a", ""), (1, 2, "user", "a", "")]
    turns = spark.createDataFrame(rows, SCHEMA)
    got = {r["conv_id"]: r for r in chat.digests(chat.windows(turns)).collect()}
    assert got[None]["turns_sha256"] == sha("assistant\nfirst\n\n\n")
    assert got[1]["turns_sha256"] == sha("user\na\nuser\na\nuser\nb\n")
    assert chat.digests(chat.windows(turns.limit(0))).count() == 0
