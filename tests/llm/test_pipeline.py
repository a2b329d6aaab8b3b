"""Every stage of the pipeline on its own input, against plain versions."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_models import plain_classes, plain_fingerprint, plain_secrets, plain_targets
from test_texts import plain_hits

import corpus_pipeline
from pageloom.llm import (
    decontamination,
    licenses,
    mixing,
    pii,
    quality,
    resampling,
    secrets,
    simhash,
    toxicity,
    winnowing,
)
from pageloom.llm.queries import ORACLE_SQL, QUERIES
from pageloom.plans.staging import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage, as ``run`` hands them on."""
    found, patch = {}, pytest.MonkeyPatch()

    def watched(name, step):
        def wrapped(spark, docs, sf_dir):
            out = stage(step(spark, docs, sf_dir), name)
            found[name] = (docs, out)
            return out

        return wrapped

    patch.setattr(
        corpus_pipeline, "STAGES", [(n, watched(n, f)) for n, f in corpus_pipeline.STAGES]
    )
    found["run"] = corpus_pipeline.run(spark, SF)
    patch.undo()
    return found


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name in names[:-1]:
        before, after = stages[name]
        assert after.schema == before.schema and after.count() > 0


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.score(before, toxicity.fit(before, labels), "t").collect()
    assert set(by_id(after)) == {r["doc_id"] for r in scores if r["t"]["score"] < toxicity.THRESHOLD}
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert len(clean - set(by_id(after))) <= 0.02 * len(clean)


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    rows = sorted(by_id(before).values(), key=lambda r: r["doc_id"])
    lowest = plain_classes([plain_fingerprint(r["text"]) for r in rows])
    assert set(by_id(after)) == {rows[i]["doc_id"] for i in lowest}


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, r in by_id(before).items() if plain_hits(r["text"], items)[3]}
    assert set(by_id(after)) == set(by_id(before)) - bad


def test_secrets_are_gone(stages):
    before, after = map(by_id, stages["secrets"])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not plain_secrets(r["text"]) and r["n_chars"] == len(r["text"])
        assert plain_secrets(before[i]["text"]) or r["text"] == before[i]["text"]


def test_words_of_the_mix(stages):
    before, after = map(by_id, stages["mixing"])
    assert set(before) == set(after)
    sizes, taken = defaultdict(int), Counter()
    for r in before.values():
        sizes[r["source"]] += len(r["text"].split())
    for r in after.values():
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"] and (len(r["shards"]) > 0) == (r["taken"] > 0)
    target = plain_targets(sizes)
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes)


def test_run_gives_the_last_stage(stages):
    got, want = stages["run"], stages["mixing"][1]
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0


def test_registered():
    assert sorted({int(q[2:].split("_")[0]) for q in QUERIES}) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


#: Names of results and names used inside, as columns of the caller's.
CLASHING = [
    "size", "source_size", "target", "taken", "shards", "hits_raw", "__hits", "__tox", "__mix", "__mix__a",
    "__s", "__spans", "__redacted", "__redact_s", "__simhash_fp", "__SIMHASH_ID", "n_words", "score", "r__m",
    "r__late", "r__", "hits__raw", "c", "fp", "id", "late", "key", "place", "before", "row", "rank",
]


@pytest.fixture(scope="module")
def crowded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    wide = [F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in CLASHING]
    return stage(docs.select("*", *wide), "crowded")


def kept(rows, names):
    """Every clashing column still has its own value."""
    rows = rows.collect()
    assert rows
    for r in rows:
        for c in names:
            assert r[c] == f"{c}-{r['doc_id']}", c


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages_keep_clashing_columns(spark, crowded, name, step):
    out = step(spark, crowded, SF)
    kept(out, CLASHING)
    if name == "mixing":
        assert {"size_", "source_size_", "target_", "taken_", "shards_"} <= set(out.columns)
        assert out.where("taken_ > 0").count() > 0


@pytest.mark.parametrize("n", [2, 4, 6, 7, 8, 10])
def test_operators_keep_clashing_columns(spark, crowded, n):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    made = {
        2: lambda: decontamination.decontaminate(crowded, benchmark),
        4: lambda: pii.replace(crowded, "r", key="k"),
        6: lambda: licenses.scan_licenses(crowded, "r"),
        7: lambda: toxicity.score(crowded, toxicity.fit(crowded, labels), "r"),
        8: lambda: secrets.find_secrets(crowded, "r"),
        10: lambda: mixing.mix(crowded, "r"),
    }
    kept(made[n](), CLASHING)


@pytest.mark.parametrize("n", [1, 3, 5, 11])
def test_operators_by_id_with_clashing_columns(spark, crowded, n):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = crowded.select("doc_id", "text", "source", "lang")
    made = {
        1: lambda d: quality.quality(d, labels),
        3: lambda d: simhash.near_duplicates(d),
        5: lambda d: winnowing.compare_with_next(d),
        11: lambda d: resampling.resample(d, d),
    }
    rows = [sorted(map(repr, made[n](d).collect())) for d in (crowded, plain)]
    if n == 1:  # sums of doubles
        assert len(rows[0]) == len(rows[1])
    else:
        assert rows[0] == rows[1]


def test_the_mix_shuffles_no_text_of_few_sources(spark, monkeypatch):
    from pageloom.llm import mixing

    docs = spark.range(300).selectExpr("id doc_id", "'s' || id % 4 source", "repeat('a b ', 1 + int(id % 9)) text")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = mixing.mix(docs, "m")
        assert "SortMergeJoin" not in plan(few) and "Exchange hashpartitioning" not in plan(few)
        monkeypatch.setattr(mixing, "FEW_BLOCKS", 1)
        many = mixing.mix(docs, "m")
        assert "SortMergeJoin" in plan(many)
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
