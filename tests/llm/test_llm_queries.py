"""Registered queries at the smallest scale: against SQL, and the pipeline against plain Python."""

import os
from collections import Counter

import brute
import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

import __spark_entry__ as entry_module
from registry.check import compare
from skyjoin.llm import bpe, mixing
from skyjoin.llm.oracle import ORACLE
from skyjoin.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and len(QUERIES) == 14
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    ok, note = compare(spark, con, name, SF, QUERIES, ORACLE)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"pipeline"}))
def test_one_row_a_document(spark, name):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF).select("doc_id").collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in documents.select("doc_id").collect())


def stages(spark, docs):
    """Each stage's rows from the rows of the one before."""
    out, shared = [], docs.columns
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        rows = docs.collect()
        done = function(spark, docs, SF)
        got = done.collect()
        out.append((rows, got))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert done.columns == shared
            docs = spark.createDataFrame(got, docs.schema)
    return out


def check_stages(results):
    (docs, good), (_, once), (_, cut), (_, mixed), (_, ids) = results
    assert Counter(good) == Counter(r for r in docs if brute.quality(r.text)["kept"])
    # rows by number, in the order of their doc_ids
    named = sorted((r for r in good if r.doc_id is not None), key=lambda r: r.doc_id)
    classes = brute.linked_classes([(k, r.text) for k, r in enumerate(named)], 5, 80)
    groups = {}
    for k, r in enumerate(named):
        groups.setdefault(classes[k], []).append(r)
    assert Counter(r for r in once if r.doc_id is None) == Counter(r for r in good if r.doc_id is None)
    assert Counter(r.doc_id for r in once if r.doc_id is not None) == Counter(g[0].doc_id for g in groups.values())
    assert set(once) <= set(good)
    assert Counter((r.doc_id, tuple(brute.words(r.text))) for r in cut) == Counter((i, tuple(left)) for i, _, left in brute.without_repeats(once))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut)
    times = Counter(mixed)
    assert set(times) <= set(cut) and max(times.values(), default=0) <= 3
    sizes, taken = Counter({r.source: 0 for r in cut}), Counter()
    for r in cut:
        sizes[r.source] += len(brute.words(r.text))
    for r in mixed:
        taken[r.source] += len(brute.words(r.text))
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 0.1 * target + 2 * max(len(brute.words(r.text)) for r in cut if r.source == source)
    encoding = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(bpe.VOCABULARY), special_tokens={})
    assert Counter((r.doc_id, tuple(r.ids)) for r in ids) == Counter((r.doc_id, tuple(encoding.encode_ordinary(r.text or ""))) for r in mixed)


def test_pipeline(spark):
    check_stages(stages(spark, spark.read.parquet(f"{SF}/documents.parquet")))


def test_mix_meets_the_targets_with_documents_longer_than_blocks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, longest, taken = Counter(), Counter(), Counter()
    for r in docs.collect():
        n = len(brute.words(r.text))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in corpus_pipeline.mix_sources(spark, docs, SF).collect():
        taken[r.source] += len(brute.words(r.text))
    block = -(-sum(sizes.values()) // mixing.BLOCKS)
    assert all(abs(taken[s] - target) <= longest[s] / 2 + 2 * block for s, target in brute.targets(sizes).items())


def test_mix_counts_rows_without_or_with_one_doc_id_each_by_itself(spark):
    rows = [(None if k % 3 else 7 + k % 2, brute.prose(k, 20 + k % 11), "en", f"s{k % 2}", k) for k in range(120)] + [(None, None, "en", "s0", 0), (None, " ", "en", "s1", 1), (7, "", "en", "s1", 1)]
    mixed = Counter(corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, brute.DOCUMENT).repartition(3), SF).collect())
    assert {tuple(r) for r in mixed} <= {r for r in rows if brute.words(r[1])} and max(mixed.values()) <= 3
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    for r, n in mixed.items():
        taken[r.source] += n * len(brute.words(r.text))
    assert all(abs(taken[s] - target) <= 17 for s, target in brute.targets(sizes).items())


def test_pipeline_of_hard_cases(spark):
    rows = [r for r in brute.hard_rows() if r[0] != 11]
    rows += [(40, brute.prose(9, 50), "en", "d", 9), (40, brute.prose(9, 50), "en", "d", 9), (40, brute.prose(10, 50), "en", "d", 9)]
    results = stages(spark, spark.createDataFrame(rows, brute.DOCUMENT))
    check_stages(results)
    # both texts of the doc_id stay, the repeated row once
    assert Counter(r.text for r in results[1][1] if r.doc_id == 40) == {brute.prose(9, 50): 1, brute.prose(10, 50): 1}


def test_pipeline_of_an_empty_table(spark):
    assert all(got == [] for _, got in stages(spark, spark.createDataFrame([], brute.DOCUMENT)))
