import hashlib

import pytest
from brute import leaks, line_dedup, near_classes
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from tallyspark.llm import bpe, quality_rules
from tallyspark.session import materialized

NAMES = [f"op{n}_" for n in range(1, 11)]


def test_every_operator_has_a_query():
    found = entry_points.queries()
    assert all(sum(q.startswith(n) for q in found) == 1 for n in NAMES)
    assert "pipeline" in found


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialized(stage(spark, docs[-1], sf_dir), name))
    return docs


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_equal_brute_force(spark, sf_dir, steps):
    given, good, lines, near, clean, coded = steps
    model = quality_rules.fit(given, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in quality_rules.score(given, model).filter("kept").collect()}
    assert pairs(good) == [d for d in pairs(given) if d[0] in kept]
    assert pairs(lines) == sorted(zip([i for i, _ in pairs(good)], line_dedup(pairs(good))))
    classes = set(near_classes(pairs(lines)))
    assert pairs(near) == [d for d in pairs(lines) if d[0] in classes]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert pairs(clean) == [d for d in pairs(near) if not leaks(d[1], items)]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    texts = dict(pairs(clean))
    for r in coded.collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert coded.count() == len(texts)
    assert all(df.columns == given.columns for df in steps[1:5])


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r["ids_sha256"] for r in got.collect()) == sorted(r["ids_sha256"] for r in steps[-1].collect())
