"""Registered queries: oracle parity where there is SQL, columns of every contract, the pipeline."""

from __future__ import annotations

from collections import Counter

import pytest

from tools.oracle_check import duck_connection, duck_rows, spark_rows, type_match
from tripspark.llm import registry

COLUMNS = {
    "op1_": "doc_id n_bytes n_removed n_spans kept_sha256", "op2_": "doc_id held_out score predicted",
    "op3_": "doc_id keep_id group_size kept text_sha256", "op4_": "doc_id n_shingles component_id",
    "op5_": "vec_id n_links component_id kept", "op6_": "doc_id size source_size target taken",
    "op7_": "doc_id n_assign n_access n_hex base_sha256 spans", "op8_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op10_": "doc_id held_out lang_pred score", "op11_": "doc_id held_out score predicted",
    "op12_": "item_id rank doc_id score",
    "op13_": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, name):
    scols, stypes, srows = spark_rows(registry.queries()[name](spark, sf_small))
    dcols, dtypes, drows = duck_rows(duck_connection(sf_small), registry.oracle_sql()[name])
    assert scols == dcols and all(type_match(stypes[c], dtypes[c]) for c in scols), (stypes, dtypes)
    assert Counter(srows) == Counter(drows)


@pytest.mark.parametrize("prefix", sorted(COLUMNS))
def test_one_query_of_each_operator_with_its_columns(spark, sf_small, prefix):
    [name] = [n for n in registry.queries() if n.startswith(prefix)]
    df = registry.queries()[name](spark, sf_small)
    assert df.columns[:len(COLUMNS[prefix].split())] == COLUMNS[prefix].split()
    source = {"op5_": "embeddings", "op9_": "conversations", "op12_": "benchmark"}.get(prefix, "documents")
    rows = spark.read.parquet(f"{sf_small}/{source}.parquet")
    expected = {"op9_": lambda: rows.select("conv_id").distinct().count() + 1, "op12_": lambda: 20 * rows.count(),
                "op13_": lambda: 600 * rows.select("lang").distinct().count()}.get(prefix, rows.count)()
    assert df.count() == expected


def test_stages_against_brute_force(spark, docs, tmp_path):
    """Each stage on its own input over the small fixture: what it keeps, draws or encodes."""
    import re

    import corpus_pipeline as p
    import numpy as np
    from tokenizers import Tokenizer

    from tests.llm.test_compression_quality import labelled
    from tests.llm.test_parity_join import brute
    from tripspark.llm.compression_quality import fit

    good = spark.createDataFrame([(10_000 + i, t, "en", "q", None, None, None, 1) for i, t, _ in labelled()], docs.schema)
    marks = spark.createDataFrame([(10_000 + i, q, 0) for i, _, q in labelled()], "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    given = docs.unionByName(good)
    model = fit(given, marks)
    compressors = model.compressors()

    def rows(df):
        return Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())

    kept = p.quality(spark, given, str(tmp_path))
    assert kept.columns == given.columns
    assert rows(kept) == Counter(r for r in rows(given).elements()
                                 if model.score(model.difference((r[1] or "").encode(), compressors)) >= 0.7)

    def least(rs):
        return min(rs, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))

    groups = {}
    for r in docs.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), []).append(r)
    exact = p.exact_dedup(spark, docs, "")
    assert sorted(str(r["doc_id"]) for r in exact.collect()) == sorted(str(least(g)["doc_id"]) for g in groups.values())

    plain = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    near = {r["doc_id"] for r in p.near_dedup(spark, plain, "").collect()}
    told = brute([(r["doc_id"], r["text"]) for r in plain.collect()])
    assert near == {i for i, _, c in told if i == c}

    mixed = rows(p.mixing(spark, docs, ""))
    size, taken, every = Counter(), Counter(), rows(docs)
    for (_, text, source), n in every.items():
        size[source] += n * len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for (_, text, source), n in mixed.items():
        taken[source] += n * len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert set(mixed) <= set(every) and all(n <= 2 * every[r] for r, n in mixed.items())
    assert all(taken[s] <= 2 * size[s] for s in size)

    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out = Counter((r["doc_id"], r["source"], tuple(np.frombuffer(r["ids"], np.uint32).tolist())) for r in p.encoding(spark, docs, "").collect())
    assert out == Counter((i, s, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, s in every.elements())


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    from tripspark.session import new_scratch_dir

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before, names = docs, docs.columns
    for name, stage in p.STAGES:
        out = stage(spark, before, sf)
        path = new_scratch_dir(spark, name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "encoding":
            assert after.columns == names
        if name == "quality":
            kept = {r["doc_id"] for r in after.collect()}
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in kept for d in good) >= 0.97 * len(good)
            assert sum(d in kept for d, q in labels.items() if q == 0) <= 0.25 * (len(labels) - len(good))
        if name in ("exact_dedup", "near_dedup"):
            assert 0 < after.count() < before.count()
            assert after.select("text").distinct().count() == after.count()
        if name == "mixing":
            assert after.count() > before.count()
            assert after.groupBy("doc_id").count().filter("count > 2").count() == 0
        if name == "encoding":
            assert after.count() == before.count()
        before = after
