import math
import os
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import evidence, similarity
from tallyspark.session import materialized


def combined(spark, **kw):
    base = dict(hist_category=None, hist_purity=0.0, hist_support=0, sem_category=None, sem_confidence=None,
                cluster_boost=0.0, contextual_category=None)
    base.update(kw)
    df = spark.createDataFrame(
        [tuple(base.values())],
        "hist_category long, hist_purity double, hist_support long, sem_category long, sem_confidence double,"
        " cluster_boost double, contextual_category long",
    )
    r = evidence.combine(df).first()
    return r.predicted_category, r.confidence, r.evidence_source, r.decision


@pytest.mark.parametrize(
    "given,expected",
    [
        (dict(hist_category=1, hist_purity=1.0, hist_support=3, sem_category=2, sem_confidence=0.6), (1, 0.6, "historical", "UNKNOWN")),
        (dict(hist_category=1, hist_purity=1.0, hist_support=3, sem_category=1, sem_confidence=0.6), (1, 0.75, "historical+semantic_agree", "REVIEW")),
        (dict(hist_category=1, hist_purity=1.0, hist_support=3, sem_category=1, sem_confidence=0.6, cluster_boost=0.07), (1, 0.82, "historical+semantic_agree+cluster", "REVIEW")),
        (dict(hist_category=1, hist_purity=0.5, hist_support=9, sem_category=2, sem_confidence=0.95), (2, 0.95, "semantic", "AUTO_CATEGORIZE")),
        (dict(contextual_category=7, cluster_boost=0.07), (7, 0.99, "contextual_rule+cluster", "AUTO_CATEGORIZE")),
        (dict(cluster_boost=0.07), (None, 0.0, "none", "UNKNOWN")),
    ],
)
def test_combine(spark, given, expected):
    assert combined(spark, **given) == expected


def test_route_boundaries(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9001, 1), (0.7, 1), (0.7001, 1), (0.95, None)], "c double, k long")
    closed = [r.d for r in df.select(evidence.decide(F.col("c"), F.col("k")).alias("d")).collect()]
    assert closed == ["REVIEW", "AUTO_CATEGORIZE", "UNKNOWN", "REVIEW", "UNKNOWN"]
    opened = [r.d for r in df.select(evidence.decide(F.col("c"), F.col("k"), False).alias("d")).collect()]
    assert opened == ["AUTO_CATEGORIZE", "AUTO_CATEGORIZE", "REVIEW", "REVIEW", "UNKNOWN"]


def test_cluster_parsing_and_strength(spark):
    df = spark.createDataFrame(
        [(0, 4, 30, "petrol (40) | bad | b (x) | diesel (5)"), (1, -1, 99, "cash (9)"), (2, 5, 19, "milk (9)"),
         (3, 6, 20, "a b (6) | c (4)"), (4, 7, 50, "petrol (3) | x (2)"), (5, 8, 40, None), (6, 9, 40, "q (1) | r (1)")],
        "ord int, discovered_cluster int, cluster_size long, top_descriptions string",
    )
    pairs = df.select("ord", evidence.parse_top_descriptions(F.col("top_descriptions")).alias("p")).orderBy("ord").collect()
    assert [tuple(x) for x in pairs[0].p] == [("petrol", 40), ("diesel", 5)] and pairs[5].p == []
    strong = {r.term: r for r in evidence.strong_clusters(df).collect()}
    assert set(strong) == {"petrol", "a b"}
    assert (strong["petrol"].cluster_id, strong["petrol"].position, strong["petrol"].purity_proxy) == (7, 0, 0.6)
    texts = spark.createDataFrame([("x a b petrol",), ("a bc",), ("b a b",)], "clean_description string")
    got = {r.clean_description: (r.cluster_boost, r.cluster_match_id) for r in evidence.cluster_boost(texts, evidence.strong_clusters(df)).collect()}
    assert got == {"x a b petrol": (0.07, 7), "a bc": (0.0, None), "b a b": (0.07, 6)}


def test_history_ties_and_lookup(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("", 9)], "clean_description string, category long")
    table = evidence.fit_history(df)
    rows = {r.clean_description: (r.category, r.purity, r.support) for r in table.collect()}
    assert rows == {"a": (1, 0.5, 2), "b": (3, 1.0, 1)}
    new = evidence.with_history(spark.createDataFrame([("zz",)], "clean_description string"), table).first()
    assert (new.hist_category, new.hist_purity, new.hist_support) == (None, 0.0, 0)


def vectors(texts, vocabulary=None):
    counts = [Counter(p[i : i + n] for w in t.split() for p in [f" {w} "] for n in (3, 4, 5) for i in range(len(p) - n + 1)) for t in texts]
    if vocabulary is None:
        df = Counter(g for c in counts for g in c)
        vocabulary = {g: math.log((1 + len(texts)) / (1 + n)) + 1 for g, n in df.items()}
    out = []
    for c in counts:
        v = {g: n * vocabulary[g] for g, n in c.items() if g in vocabulary}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        out.append({g: x / norm for g, x in v.items()})
    return out, vocabulary


def brute_neighbours(queries, references, k):
    ref, vocabulary = vectors(references)
    ask, _ = vectors(queries, vocabulary)
    out = {}
    for q, v in zip(queries, ask):
        sims = [(round(sum(w * r.get(g, 0.0) for g, w in v.items()), 10), name) for name, r in zip(references, ref)]
        out[q] = [(n, s) for s, n in sorted(sims, key=lambda x: (-x[0], x[1]))[:k] if s > 0]
    return out


@pytest.mark.parametrize("block", [60, 50_000])
def test_nearest_texts_equal_brute_force(spark, monkeypatch, block):
    """Small blocks, so that bounds, second rounds and query chunks are all used."""
    monkeypatch.setattr(similarity, "BLOCK_GRAMS", block)
    monkeypatch.setattr(similarity, "CHUNK_GRAMS", block)
    words = ["petrol", "milk", "cash", "careem", "ride", "salary", "toll", "tax", "red", "blue", "gear"]
    # a third of all references share one word
    references = sorted({f"{words[i % 11]} {words[(i * 7 + i // 11) % 11]}" for i in range(90)} | {f"cash {w}{i}" for i, w in enumerate(words * 4)})
    queries = ["cash", "cash petrol", "milk red", "red milk", "qqq", "toll tax blue", "careem rides", "gear from abc"]
    got = defaultdict(list)
    rows = similarity.nearest_texts(
        spark.createDataFrame([(q,) for q in queries], "text string"),
        spark.createDataFrame([(r,) for r in references], "text string"),
        5,
    ).collect()
    for r in sorted(rows, key=lambda r: (r.query, r.rank)):
        got[r.query].append((r.reference, r.similarity))
    expected = {q: n for q, n in brute_neighbours(queries, references, 5).items() if n}
    assert {q: [n for n, _ in v] for q, v in got.items()} == {q: [n for n, _ in v] for q, v in expected.items()}
    for q, v in expected.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in v], abs=1e-9)
    assert "qqq" not in got


def test_vote(spark):
    near = spark.createDataFrame(
        [("q", "a", 0.9, 1), ("q", "b", 0.5, 2), ("q", "c", 0.5, 3), ("t", "a", 0.5, 1), ("t", "b", 0.5, 2), ("z", "d", 0.4, 1)],
        "query string, reference string, similarity double, rank int",
    )
    table = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.5), ("c", 2, 0.5), ("d", 3, 0.0)], "reference string, category long, purity double")
    rows = {r.query: r for r in similarity.vote(near, table).collect()}
    assert rows["q"].sem_category == 2 and rows["q"].sem_top_similarity == 0.5
    assert rows["q"].sem_confidence == pytest.approx(0.5 * 0.5 / 0.95)
    assert rows["t"].sem_category == 1  # equal votes: the nearer one
    assert "z" not in rows  # no weight, no category


@pytest.mark.parametrize("leaves", [1, 8, 100])
def test_nearest_vectors_equal_brute_force(spark, monkeypatch, leaves):
    monkeypatch.setattr(similarity, "BUCKET_ROWS", 16)
    rng = np.random.default_rng(3)
    refs = rng.normal(size=(120, 6))
    refs[:40] = refs[0]  # a third are copies of one vector
    asks = rng.normal(size=(12, 6))
    refs /= np.linalg.norm(refs, axis=1, keepdims=True)
    asks /= np.linalg.norm(asks, axis=1, keepdims=True)
    rows = similarity.nearest_vectors(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asks)], "query long, vector array<double>"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(refs)], "reference long, vector array<double>"),
        5,
        leaves,
    ).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query, r.rank)):
        got[r.query].append(r.reference)
    sims = np.round(asks @ refs.T, 10)
    for i in range(len(asks)):
        assert got[i] == sorted(range(120), key=lambda j: (-sims[i, j], j))[:5]


def test_clustered_vectors_are_compared_with_few(spark):
    """Each query of 40 clusters is compared with less than a tenth of all references, and the result is exact."""
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(40, 16))
    refs = middles[np.arange(4000) % 40] + rng.normal(scale=0.05, size=(4000, 16))
    asks = middles[np.arange(100) % 40] + rng.normal(scale=0.05, size=(100, 16))
    refs /= np.linalg.norm(refs, axis=1, keepdims=True)
    asks /= np.linalg.norm(asks, axis=1, keepdims=True)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asks)], "query long, vector array<double>")
    references = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(refs)], "reference long, vector array<double>")
    placed, _, more = similarity.wanted_cells(queries, references, 5, 256)
    sizes = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    compared = sum(r.rows for r in more.collect()) + 100 * similarity.FIRST_CELLS * max(sizes.values())
    assert sum(sizes.values()) == 4000 and compared < 0.1 * 100 * 4000
    got = defaultdict(list)
    for r in sorted(similarity.nearest_vectors(queries, references, 5, 256).collect(), key=lambda r: (r.query, r.rank)):
        got[r.query].append(r.reference)
    sims = np.round(asks @ refs.T, 10)
    assert all(got[i] == sorted(range(4000), key=lambda j: (-sims[i, j], j))[:5] for i in range(100))


def test_candidate_blocks_grow_slower_than_queries_times_blocks(spark, monkeypatch):
    """Twice the texts: the looked-up (query, block) rows grow with the queries, not with the product."""
    monkeypatch.setattr(similarity, "BLOCK_GRAMS", 600)
    words = [f"{a}{b}{c}" for a in ("pet", "mil", "car", "sal", "tol") for b in ("rol", "kan", "eem", "ary") for c in ("xu", "yo", "zi")]

    def looked_up(n):
        # Each word is common to about as many texts whatever n is: vocabularies grow with their corpus.
        texts = [f"{words[i % 60]}{i // 60} {words[(7 * i) % 60]}{i // 60} {words[(11 * i) % 60]}" for i in range(n)]
        frame = lambda rows: spark.createDataFrame([(t,) for t in sorted(set(rows))], "text string")
        queries, references = similarity.numbered(frame([t + "s" for t in texts[::3]]), "query"), similarity.numbered(frame(texts), "reference")
        refs, asked = similarity._weighted_grams(queries, references)
        peaks = materialized(refs.groupBy("gid", "block").agg(F.max("rw").alias("peak"), F.max("rest").alias("ref_rest")), "peaks")
        first = materialized(similarity.first_blocks(asked, peaks), "first")
        bound = similarity.kth_best(similarity._score_texts(first, asked, refs, 5), "query", "similarity", 5)
        rows = similarity.open_blocks(asked, peaks, bound).unionByName(first).distinct().count()
        return rows, queries.count() * references.select("block").distinct().count()

    (small, all_small), (large, all_large) = looked_up(600), looked_up(1200)
    assert all_large > 3.5 * all_small and large < 2.7 * small and large < 0.5 * all_large


def test_texts_travel_once_for_each_block_not_gram_by_gram(spark):
    """With the fixed sizes a few thousand grams are one block, and a query is one row for each block it asks."""
    texts = [f"pet{i % 7}rol milk{i % 11} from x{i * 37 % 1000}y" for i in range(400)]
    frame = lambda rows: spark.createDataFrame([(t,) for t in sorted(set(rows))], "text string")
    references = similarity.numbered(frame(texts).coalesce(1), "reference")
    assert references.groupBy(F.spark_partition_id()).agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] == 1
    queries = similarity.numbered(frame(texts[::5]), "query")
    _, asked = similarity._weighted_grams(queries, references)
    packed = similarity._packed(asked, ["query"], "w")
    assert packed.count() == queries.count() and asked.count() > 20 * packed.count()
    assert all(r.gids == sorted(r.gids) and len(r.gids) == len(r.weights) for r in packed.collect())


@pytest.mark.parametrize("summed", [0, 1, 1000])
def test_rare_grams_lose_no_reference(spark, monkeypatch, summed):
    """However many rare grams are added up first, the neighbours are those of brute force, also for queries without k of them."""
    monkeypatch.setattr(similarity, "SUMMED", summed)
    references = [f"cash ride {a}{b}" for a in "abcdefgh" for b in "uvwxyz"] + ["milk bread", "milk toll"]
    queries = ["cash ride au", "ride", "milk bread toll", "xx yy", "cash ride zz", "bread"]
    rows = similarity.nearest_texts(spark.createDataFrame([(q,) for q in queries], "text string"), spark.createDataFrame([(r,) for r in references], "text string"), 5).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query, r.rank)):
        got[r.query].append(r.reference)
    assert dict(got) == {q: [n for n, _ in v] for q, v in brute_neighbours(queries, references, 5).items() if v}


def test_text_search_packs_once_and_keeps_no_grams(spark, monkeypatch):
    """Both turns read the same packed texts, and tables of single grams are deleted before the scores are made."""
    made, packs = {}, []
    plain, pack = similarity.written, similarity._packed
    monkeypatch.setattr(similarity, "written", lambda df, label: made.setdefault(label, plain(df, label)) if label not in made else plain(df, label))
    monkeypatch.setattr(similarity, "_packed", lambda grams, keys, weight: packs.append(weight) or pack(grams, keys, weight))
    texts = spark.createDataFrame([(f"cash ride {a}{b}",) for a in "abcdefgh" for b in "uvwxyz"], "text string")
    assert similarity.nearest_texts(texts, texts, 3).count() == 3 * 48
    assert sorted(packs) == ["rw", "w"]
    gone = {label for label, df in made.items() if not any(os.path.exists(f.removeprefix("file:")) for f in df.inputFiles())}
    assert {"ref-grams", "vocabulary", "ref-weights", "query-weights", "peaks", "ref-texts", "query-texts"} <= gone


@pytest.mark.parametrize("travel", [0.05, 1e9])
def test_text_search_keeps_lists_and_travels_in_turns(spark, monkeypatch, travel):
    """Weights are one row per text from the start, and many chunks go in turns, with the same neighbours."""
    made, plain = defaultdict(list), similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, label: made[label].append((df.columns, df.count())) or plain(df, label))
    monkeypatch.setattr(similarity, "TRAVEL", travel)
    monkeypatch.setattr(similarity, "CHUNK_GRAMS", 200)
    references = [f"cash ride {a}{b}" for a in "abcdefgh" for b in "uvwxyz"] + ["milk bread", "milk  toll milk"]
    queries = ["cash ride au", "ride", "milk bread toll", "xx yy", "cash ride zz", "bread", "milk milk"]
    rows = similarity.nearest_texts(spark.createDataFrame([(q,) for q in queries], "text string"), spark.createDataFrame([(r,) for r in references], "text string"), 5).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query, r.rank)):
        got[r.query].append(r.reference)
    assert dict(got) == {q: [n for n, _ in v] for q, v in brute_neighbours(queries, references, 5).items() if v}
    assert made["ref-weights"] == [(["block", "reference", "gids", "weights", "rests"], len(references))]
    assert (len(made["turn-scores"]) > 4) == (travel < 1)


def brute_counts(rows):
    out = defaultdict(Counter)
    for key, held in rows:
        for w in (held or "").split(" "):
            p = f" {w} "
            out[key].update(p[i : i + n] for n in (3, 4, 5) for i in range(len(p) - n + 1) if w)
    return {(key, g): n for key, c in out.items() for g, n in c.items()}


def test_gram_counts_merge_repeated_and_null_keys(spark):
    """counted key by key in one pass, without a row for each word of a text."""
    rows = [(1, "milk  milk a"), (None, "é😀x cash"), (2, ""), (1, "milk"), (None, "cash"), (3, None)] + [(i, f"w{i} x") for i in range(10, 300)]
    counts = similarity.gram_counts(spark.createDataFrame(rows, "doc long, held string"), "doc", "held")
    assert {(r.doc, r.gram): r.tf for r in counts.collect()} == brute_counts(rows)
    assert counts.schema.simpleString() == "struct<doc:bigint,gram:string,tf:bigint>"
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan


def test_centre_sample_reaches_the_driver_once(spark, monkeypatch):
    """what the driver collects does not grow with the number of partitions, and is thinned before it is sorted."""
    collected = []
    plain = similarity.materialized
    monkeypatch.setattr(similarity, "materialized", lambda df, label: collected.append((label, df)) or plain(df, label))
    refs = spark.range(20_000).repartition(40).select(F.col("id").alias("reference"), F.array((F.col("id") % 7).cast("double"), F.lit(1.0)).alias("vector"))
    centres = similarity.train_centres(refs, 9, sample=200)
    ((label, sample),) = collected
    assert label == "centre-sample" and sample.count() == 200 and centres.top.shape == (3, 2)
    thin = refs.filter(F.pmod(F.xxhash64("reference"), F.lit(similarity.THINNING)) < int(0.02 * similarity.THINNING) + 1).count()
    assert 200 <= thin < 800
    assert similarity.train_centres(refs.limit(0), 9) is None


def test_boost_evaluates_its_inputs_once(spark):
    """neither texts nor terms are evaluated again for the longest term or for texts without a hit."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(t):
        seen.add(1)
        return t

    texts = spark.createDataFrame([("a b",), ("c",), ("petrol x",)], "t string").select(look.asNondeterministic()("t").alias("clean_description"))
    terms = spark.createDataFrame([("petrol", 1, 0)], "term string, cluster_id int, position int").select(look.asNondeterministic()("term").alias("term"), "cluster_id", "position")
    got = {r.clean_description: r.cluster_match_id for r in evidence.cluster_boost(texts, terms).collect()}
    assert got == {"a b": None, "c": None, "petrol x": 1} and seen.value == 4


def test_block_scorer_looks_at_references_that_can_reach_the_bound(monkeypatch):
    """What is added up and scored for a query follows its rare grams, not the size of the block, and loses no reference."""
    rng = np.random.default_rng(5)
    # Grams 0 to 3,999 are rare, 4,000 to 4,019 stand in a third of all references.
    def text(of):
        rare, often = rng.choice(4_000, 6, replace=False), 4_000 + rng.choice(20, 7, replace=False)
        w = np.append(np.full(6, 8.0), np.full(7, 2.0)) * rng.uniform(0.9, 1.1, 13)
        gids = np.sort(np.append(rare, often))
        return gids.tolist(), (w / np.sqrt((w * w).sum())).tolist()

    def table(key, n):
        rows = [text(i) for i in range(n)]
        return pa.table({key: pa.array(range(n), pa.int64()), "gids": pa.array([g for g, _ in rows]), "weights": pa.array([w for _, w in rows])})

    def dense(rows):
        out = np.zeros((rows.num_rows, 4_020))
        for i, (g, w) in enumerate(zip(rows["gids"].to_pylist(), rows["weights"].to_pylist())):
            out[i, g] = w
        return out

    held, asks = table("reference", 6_000), table("query", 40)
    sims = np.round(dense(asks) @ dense(held).T, 10)
    bound = -np.sort(-sims, axis=1)[:, 4]
    looked, plain = [], np.repeat
    for bounds in (bound, np.full(40, np.nan)):
        looked.clear()
        monkeypatch.setattr(similarity.np, "repeat", lambda a, n, *x: looked.append(r := plain(a, n, *x)) or r)
        got = similarity._block_scorer(5, similarity.SUMMED)(asks.append_column("bound", pa.array(bounds, from_pandas=True)), held)
        monkeypatch.undo()
        found = defaultdict(list)
        for q, r, s in zip(*(got[c].to_pylist() for c in ("query", "reference", "similarity"))):
            found[q].append((r, s))
        for i in range(40):
            want = sorted(range(6_000), key=lambda j: (-sims[i, j], j))[:5]
            assert [r for r, _ in found[i]] == want and [s for _, s in found[i]] == pytest.approx(sims[i, want], abs=1e-9)
        if bounds is bound:
            # Index and lists take some arrays of the size of all grams; two held grams for each reference and query were added up before.
            assert sum(map(len, looked)) < 8 * 6_000 * 13 < 2 * 2 * 6_000 * 40
