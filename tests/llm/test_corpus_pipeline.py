from __future__ import annotations

import hashlib

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tripmart.llm.decontaminate import Decontaminate, leaks
from tripmart.llm.oracle import ORACLE
from tripmart.llm.queries import QUERIES
from tripmart.llm.quality_rules import QualityRules, quality_verdicts

from test_decontaminate import brute_force as brute_leaks
from test_near_dedup import brute_force as brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = {r.doc_id: r for r in source.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "bpe"]

    kept = stages["quality_rules"](spark, source, SF)
    verdicts = {r.doc_id for r in quality_verdicts(source, labels, QualityRules()).collect() if r.kept}
    rows = kept.collect()
    assert kept.columns == source.columns and {r.doc_id for r in rows} == verdicts and all(r == docs[r.doc_id] for r in rows)

    kept = spark.createDataFrame(rows, source.schema)
    cleaned = stages["line_dedup"](spark, kept, SF)
    connection = duckdb.connect()
    connection.register("documents", kept.toArrow())
    by_sql = {row[0]: row[2] for row in connection.execute(ORACLE["op9_line_dedup"]).fetchall()}
    rows = cleaned.collect()
    assert cleaned.columns == source.columns and {r.doc_id: r.text for r in rows} == by_sql
    assert all(r.n_chars == len(r.text) for r in rows if r.text != docs[r.doc_id].text)

    kept = spark.createDataFrame(rows, source.schema)
    single = stages["minhash_near_dedup"](spark, kept, SF)
    groups = brute_groups([(r.doc_id, r.text) for r in rows], 5)
    found = single.collect()
    assert single.columns == source.columns and {r.doc_id for r in found} == {doc for doc, (_, root) in groups.items() if doc == root}

    kept = spark.createDataFrame(found, source.schema)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stages["benchmark_decontamination"](spark, kept, SF)
    leaked = {doc for doc, _ in brute_leaks([(r.doc_id, r.text) for r in found], items)}
    rows = clean.collect()
    assert clean.columns == source.columns and {r.doc_id for r in rows} == {r.doc_id for r in found} - leaked
    assert {r.doc_id for r in leaks(source, spark.read.parquet(f"{SF}/benchmark.parquet"), Decontaminate()).collect()}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = stages["bpe"](spark, spark.createDataFrame(rows, source.schema), SF).collect()
    encoded = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids for r in rows}
    assert {r.doc_id: r.n_tokens for r in tokens} == {doc: len(ids) for doc, ids in encoded.items()}
    assert all(r.ids_sha256 == hashlib.sha256(",".join(map(str, encoded[r.doc_id])).encode()).hexdigest() for r in tokens)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, tokens))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = QUERIES[name](spark, SF)
    cursor = connection.execute(ORACLE[name])
    columns = [item[0] for item in cursor.description]
    theirs = sorted((dict(zip(columns, row)) for row in cursor.fetchall()), key=str)
    assert sorted(({c: r[c] for c in columns} for r in frame.collect()), key=str) == theirs and set(columns) == set(frame.columns)


def test_entry_registers_everything():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql()) <= set(names)
