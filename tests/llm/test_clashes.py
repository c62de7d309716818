"""Extra columns of the documents, named as the operators name their own: they come back as they were."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from chargewise.llm import ann, colloc, decontam, fingerprint, langid, linededup, repair, rlbwt, simhash, trie
from chargewise.llm.common import read_table, scratch
from tests.llm.conftest import SF

NAMES = ["root", "_fp", "_many", "_own", "_id", "none", "row", "row_key", "_gone", "gone", "pos", "line", "k1", "_language", "language", "lang_pred", "score",
         "rejected", "n_lines", "n_removed", "fp", "fingerprint", "component_id", "least", "node", "key", "range", "guest", "next", "sketch", "text_key",
         "raw", "digest", "ids", "part", "phrase", "a", "data", "marks", "shard", "n"]
BASE = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    table = read_table(spark, SF, "documents").select(*BASE).limit(80)
    more = {n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in NAMES}
    return table.withColumns(more).cache()


def kept(df):
    """Each row's own columns, by doc_id."""
    return {r["doc_id"]: tuple(r[n] for n in NAMES) for r in df.select("doc_id", *NAMES).collect()}


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_the_documents_columns(spark, docs, stage):
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF)
    plain = dict(corpus_pipeline.STAGES)[stage](spark, docs.select(*BASE), SF)
    assert out.columns == docs.columns
    rows = kept(out)
    assert rows and all(values == tuple(f"{n} of {d}" for n in NAMES) for d, values in rows.items())
    assert sorted(out.select(*BASE).collect()) == sorted(plain.collect())


def test_one_row_of_a_group_stays(spark):
    rows = [(i, "the same few words in every row of this table", f"r{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    assert [tuple(r) for r in simhash.one_of_each(df).collect()] == [(*rows[0][:2], "r0")]


def test_operators_take_no_notice_of_other_columns(spark, docs):
    plain = docs.select(*BASE)
    items = read_table(spark, SF, "benchmark")
    for run in (simhash.near_duplicates, fingerprint.edited, rlbwt.remove_repeats, lambda d: colloc.collocations(d, min_count=5),
                lambda d: decontam.contaminated_pairs(d, items), lambda d: linededup.remove_boilerplate(d).select("doc_id", "text", "n_lines", "n_removed"),
                lambda d: langid.classify(d, langid.fit(plain)).select("doc_id", "lang_pred", "score", "rejected")):
        assert sorted(map(str, run(docs).collect())) == sorted(map(str, run(plain).collect()))


def test_other_tables_too(spark):
    vectors = read_table(spark, SF, "embeddings")
    more = vectors.withColumns({n: F.lit("x") for n in ("cid", "qcid", "vector", "rank", "score", "ids", "n", "near", "first")})
    assert sorted(ann.nearest(more).collect()) == sorted(ann.nearest(vectors).collect())
    turns = read_table(spark, SF, "conversations")
    more = turns.withColumns({n: F.lit("x") for n in ("shard", "depth", "key", "parent", "n_convs", "d1", "chars", "kind")})
    assert sorted(map(str, trie.prefix_trie(more).collect())) == sorted(map(str, trie.prefix_trie(turns).collect()))
    path = scratch(spark, "clash")
    import public_tokenizers
    docs = read_table(spark, SF, "documents").limit(20).withColumn("grammar", F.lit("x")).withColumn("base", F.lit(1))
    repair.write(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    assert repair.checksums(spark, path).count() == 20
