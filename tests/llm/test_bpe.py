import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tallyspark.llm import bpe

ODD = [
    "", " ", "  \n\n  x ", "<|endoftext|>a <|endoftext|> b", "'s 'LL don't I'd", "a" * 3000, "é" * 500, "漢字かな交じり文" * 30,
    "\x00\x01🙂🙂 \x85\xa0 x", "1234567890" * 50, "!!!???..." * 40, "a \nb", "a\n b", "\t \n w", "½ Ⅷ ٣",
]


@pytest.fixture(scope="module")
def coder():
    return bpe.coder(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_and_text_equal_the_library(coder, library):
    rng = random.Random(4)
    alphabet = [" ", " ", "\n", "\t", "\x1c", "\xa0", "a", "bc", "Z", "1", "½", "'s", "é", ".", "_", "漢", "<|endoftext|>", "<|"]
    mixed = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for text in ODD + mixed:
        ids = expected(library, text)
        assert coder.encode(text) == ids
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_token_is_compatible_with_itself_alone(coder):
    for token in range(0, len(coder.ids), 97):
        data = coder.bytes[coder.ids[token]]
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue
        if coder.alone(token) and len(coder.pieces.findall(text)) == 1:
            assert coder.encode(text) == [coder.ids[token]]


def test_documents(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "n"), (3, ODD[3], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_documents(docs).collect()
    assert len(got) == len(rows)
    by_digest = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got)
    want = []
    for doc_id, text, _ in rows:
        ids = expected(library, text)
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id is not None, doc_id or 0, len(ids), joined, hashlib.sha256((text or "").encode()).hexdigest()))
    assert by_digest == sorted(want)
    assert bpe.encode_documents(docs.limit(0)).count() == 0


def test_columns(spark):
    df = spark.createDataFrame([("one two",), (None,), ("",)], "t string")
    ids = df.select("t", bpe.encode(df["t"]).alias("ids"), bpe.n_tokens(df["t"]).alias("n"))
    back = ids.select("t", "ids", "n", bpe.decode(ids["ids"]).alias("b")).collect()
    assert [(r["b"], r["n"], len(r["ids"])) for r in back] == [("one two", 2, 2), ("", 0, 0), ("", 0, 0)]
    none = spark.createDataFrame([([None, 10**6],), (None,)], "ids array<int>")
    assert [r[0] for r in none.select(bpe.decode(none["ids"])).collect()] == ["", ""]
