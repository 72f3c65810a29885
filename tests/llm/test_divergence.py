import collections
import random
import re

import duckdb
import pytest

from tallyspark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=3, top=200):
    """All pairs and terms by the definition, term by term."""
    rows = [(text or "", lang or "", source or "") for text, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        sources = sorted({s for _, l, s in rows if l == lang})
        docs, counts = collections.Counter(), {s: collections.Counter() for s in sources}
        for text, l, source in rows:
            if l == lang:
                terms = TERM.findall(text.translate(UPPER))
                docs.update(set(terms))
                counts[source].update(terms)
        kept = [t for t, n in docs.items() if n >= least]

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        share = {s: shares(counts[s]) for s in sources}
        whole = shares(sum(counts.values(), collections.Counter()))
        for s in sources:
            pairs = [(o, sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (share[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if counts[s][t] and share[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def some(n=300, seed=3):
    rng = random.Random(seed)
    words = [rng.choice(["ab", "Öl", "x", "é", "日本", "No"]) + str(rng.randrange(3)) + rng.choice(["q", "ß", "K"]) for _ in range(40)]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(12)))
        rows.append((text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "B", "ä", None])))
    rows += [(rows[0][0], "en", s) for s in "aab" * 20]  # copies over sources
    rows += [(None, "en", "silent"), ("", "xx", "one"), ("only here", "xx", "two"), ("a\x00b\nc|d", "en", "a")]
    return rows


def audit(spark, rows, **more):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "text string, lang string, source string, term string, n int")
    return sorted(tuple(r) for r in divergence.audit(df, **more).collect())


def test_equals_brute_force(spark):
    rows = some()
    assert audit(spark, rows) == brute(rows)
    assert audit(spark, rows[::-1], top=2) == brute(rows, top=2)


def test_small_tiles_and_chunks_change_nothing(spark):
    rows = some(120) + [(f"w{k % 7} shared Shared", "en", f"s{k % 30}") for k in range(90)]
    assert audit(spark, rows, tile=4, chunk_bytes=50, chunk_rows=7) == brute(rows)


def test_hot_source_and_long_text(spark):
    rows = [("common words of all", "en", "hot")] * 400 + [("long text " * 40_000, "en", s) for s in ("hot", "p", "q")] + [("words", "en", "p")]
    assert audit(spark, rows) == brute(rows)


def test_empty_and_without_terms(spark):
    assert audit(spark, []) == []
    assert audit(spark, [("1 2 3", None, "a"), (None, "", "b")]) == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


def test_tokens_of_a_text_only_once():
    text, terms = divergence._terms(["A b\nb", "", "é", "x" * 5 + "-Y"])
    assert list(zip(text.tolist(), terms.to_pylist())) == [(0, "a"), (0, "b"), (0, "b"), (2, "é"), (3, "xxxxx"), (3, "y")]


@pytest.mark.parametrize("rows", [None, some(80, 9)])
def test_query_equals_sql(spark, sf_dir, rows):
    con = duckdb.connect()
    if rows is None:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    else:
        rows = [r for r in rows if "\x00" not in (r[0] or "")]
        docs = spark.createDataFrame(rows, "text string, lang string, source string")
        con.execute("CREATE TABLE documents(text VARCHAR, lang VARCHAR, source VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    ours = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert ours == sorted(con.execute(divergence.ORACLE).fetchall())
