"""The pipeline stage by stage against plain versions; queries against their SQL."""

import hashlib
import os
import random

import base64
import brute
import duckdb
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from pressloom.llm import mixing, quality_rules, suffix_dedup
from pressloom.llm.catalog import ORACLES, QUERIES
from pressloom.llm.common import stage

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    sql = [dict(zip(names, r)) for r in found.fetchall()]
    own = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    order = lambda rows: sorted(repr(sorted(r.items())) for r in rows)
    assert own and order(own) == order(sql)


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_strings", "mix", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, apply in corpus_pipeline.STAGES:
        before = docs
        docs = stage(apply(spark, docs, SF), "test")
        steps[name] = (before.collect(), docs.collect())
        if name != "tokens":
            assert docs.columns == columns and [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]

    was, now = steps["quality"]
    judged = quality_rules.apply_rules(spark.createDataFrame(was), spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in now} == {r.doc_id for r in judged.where("kept").collect()}
    assert {r.doc_id for r in now} <= {r.doc_id for r in was if brute.measures(r.text)[0] >= 50}

    was, now = steps["near_copies"]
    groups = brute.near_groups([(r.doc_id, r.text) for r in was])
    assert sorted(now) == sorted(r for i, r in enumerate(was) if groups[i] == r.doc_id)

    was, now = steps["repeated_strings"]
    after = {r.doc_id: r for r in now}
    for r, flags in zip(was, brute.cut_repeats([r.text for r in was])):
        left = bytes(b for b, f in zip(r.text.encode(), flags) if not f).decode(errors="ignore")
        assert (after[r.doc_id].text, after[r.doc_id].lang) == (left, r.lang)
        assert after[r.doc_id].n_chars == (len(left) if any(flags) else r.n_chars)

    was, now = steps["mix"]
    assert {r.doc_id for r in now} <= {r.doc_id for r in was} and set(now) <= set(was)

    was, now = steps["tokens"]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((r.doc_id, library.encode_ordinary(r.text), hashlib.sha256(r.text.encode()).hexdigest()) for r in was)
    assert sorted((r.doc_id, list(r.token_ids), r.decoded_sha256) for r in now) == expected
    assert all(r.n_tokens == len(r.token_ids) for r in now)


def test_run_and_edge_cases(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (5000, " ".join(f"w{i}" for i in range(60)), "en", "s", 1), (5000, " ".join(f"w{i}" for i in range(60)), "en", "s", 1)]
    extra = spark.createDataFrame(rows, docs.schema)
    for name, df in (("edge", docs.limit(40).union(extra)), ("empty", docs.limit(0))):
        folder = str(tmp_path / name)
        df.write.parquet(f"{folder}/documents.parquet")
        os.symlink(f"{SF}/labels.parquet", f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert len(out) > 0 if name == "edge" else not out
        assert {r.doc_id for r in out} <= {None, 5000, *(r.doc_id for r in docs.select("doc_id").collect())}
        once = corpus_pipeline.near_copies(spark, df, folder)
        assert once.where("doc_id = 5000").count() == (name == "edge")
        assert once.where("doc_id is null").count() == (2 if name == "edge" else 0)


def test_near_copies_judges_rows_not_ids(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(5, text("a")), (5, text("b")), (1, text("c")), (7, text("c")), (7, text("b") + " more"), (9, text("d")), (9, text("d")), (None, text("a")), (3, ""), (3, "")]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    seen = set()
    for n in (1, 5):
        df = spark.createDataFrame([(k, t, "en", f"s{i}", len(t)) for i, (k, t) in enumerate(rows)], schema).repartition(n)
        kept = corpus_pipeline.near_copies(spark, df, SF)
        assert kept.columns == df.columns
        seen.add(tuple(sorted((r.doc_id or -1, r.text, r.source) for r in kept.collect())))
    assert len(seen) == 1  # the same under any partitioning
    assert sorted((k, t) for k, t, _ in seen.pop()) == sorted(
        [(5, text("a")), (5, text("b")), (1, text("c")), (9, text("d")), (-1, text("a")), (3, ""), (3, "")])


@pytest.mark.parametrize("n_toxic", [3, 20, 200])
def test_mix_thins_out_toxic_texts_rare_or_not(spark, tmp_path, n_toxic):
    rng = random.Random(n_toxic)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=80)) for _ in range(2000)]
    texts = [t + " vile hateful rotten slur" if i < n_toxic else t for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], spark.read.parquet(f"{SF}/documents.parquet").schema)
    labels = spark.createDataFrame([(i, 1, int(i < n_toxic)) for i in range(2000)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    ids = [r.doc_id for r in corpus_pipeline.mix(spark, docs, str(tmp_path)).collect()]
    assert len(ids) == len(set(ids))
    assert sum(i >= n_toxic for i in ids) >= 0.995 * (2000 - n_toxic)
    assert sum(i < n_toxic for i in ids) <= max(1, 0.2 * n_toxic)


def test_tokens_hold_one_python_worker_a_task(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = corpus_pipeline.tokens(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # two in one task would run at once, each in a worker of its own


def test_nothing_else_imports_the_subpackage():
    top = os.path.dirname(corpus_pipeline.__file__)
    for folder, _, files in os.walk(os.path.join(top, "pressloom")):
        if not folder.endswith("llm"):
            for f in files:
                if f.endswith(".py"):
                    assert "pressloom.llm" not in open(os.path.join(folder, f)).read(), f


def test_parameters_are_as_documented():
    assert (suffix_dedup.LENGTH, mixing.FIT_DOCS, quality_rules.MIN_WORDS) == (200, 20_000, 50)
