"""The pipeline's stages against brute force, and the registered queries."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from shelfscout.llm import chunk_dedup, mixing, quality, queries, simhash
from shelfscout.session import materialise
from testbed.compare import difference, oracle_connection

SF = "/root/testdata/sf0.001"


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def stages(spark):
    """The input and every stage's written output."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs.append(materialise(stage(spark, docs[-1], SF), name.split()[0]))
    return docs


def test_stages_keep_the_columns_of_documents(stages):
    assert all(df.dtypes == stages[0].dtypes for df in stages[1:-1])


def test_rejected_documents_go(spark, stages):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"), usable=~held_out)
    want = Counter(tuple(row) for row in stages[0].collect() if model.score(row.text) >= 0.3)
    assert bag(stages[1]) == want
    assert sum(want.values()) < stages[0].count()


def test_columns_of_any_name_pass_all_stages(spark, stages):
    """Names that the stages use themselves come through, rows unchanged."""
    names = ["__id", "__key", "__score", "__copy", "id", "key", "row", "score", "copies", "kept", "to_id", "text_key"]
    more = stages[0].limit(120).withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in names})
    more = materialise(more, "named")
    docs = more
    for _, stage in pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF), "named")
        assert docs.dtypes == more.dtypes
    assert 0 < docs.count() and docs.join(more, more.columns, "left_anti").where("source is not null").count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_no_label_keeps_every_document(spark, stages, tmp_path):
    """Nothing learned, every score the same: the corpus goes on."""
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = stages[0].limit(30)
    assert pipeline.good_quality(spark, docs, str(tmp_path)).count() in (0, 30)


def test_one_document_of_each_group_stays(stages):
    groups = {}
    for row in stages[1].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", row.text or ""), []).append(row)
    best = [min(rows, key=lambda r: (-len(r.text or ""), r.doc_id)) for rows in groups.values()]
    assert bag(stages[2]) == Counter(map(tuple, best))
    rows = stages[2].collect()
    codes = [simhash.fingerprint(row.text, 3) for row in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    kept = {}
    for row, r in zip(rows, root, strict=True):
        kept[r] = min(kept.get(r, row), row, key=lambda one: one.doc_id)
    assert bag(stages[3]) == Counter(map(tuple, kept.values()))


def test_sources_meet_their_targets(stages):
    size, sources = {}, {}
    for row in stages[3].collect():
        size[row.doc_id], sources[row.doc_id] = len((row.text or "").split()), row.source
    totals = Counter()
    for doc, words in size.items():
        totals[sources[doc]] += words
    targets = mixing.source_targets(dict(totals))
    taken, copies = Counter(), Counter(row.doc_id for row in stages[4].collect())
    assert max(copies.values()) <= 2
    for doc, n in copies.items():
        taken[sources[doc]] += n * size[doc]
    # Few documents a source: the largest bounds what whole copies can miss.
    largest = Counter()
    for doc, words in size.items():
        largest[sources[doc]] = max(largest[sources[doc]], words)
    assert all(abs(taken[name] - target) <= largest[name] for name, target in targets.items())


def test_packed_ids_are_the_documents(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = stages[4].collect()
    encoded = tokenizer.encode_batch([row.text or "" for row in docs], add_special_tokens=False)
    want = Counter((row.doc_id, tuple([*one.ids, 0])) for row, one in zip(docs, encoded, strict=True))
    pieces = {}
    for row in stages[5].collect():
        pieces.setdefault(row.doc_id, []).append(row)
    for (doc, ids), copies in want.items():
        found = sorted(pieces[doc], key=lambda row: (row.start, row.sequence_id))
        for at in range(copies):
            whole = b"".join(bytes(row.ids) for row in found[at::copies])
            assert np.frombuffer(whole, "<u4").tolist() == list(ids)


def test_run_equals_the_stages(spark, stages):
    got = pipeline.run(spark, SF).select("doc_id", "start", "length", "ids", "doc_tokens", "offset")
    want = stages[-1].select("doc_id", "start", "length", "ids", "doc_tokens", "offset")
    assert Counter(map(str, got.collect())) == Counter(map(str, want.collect()))


def test_stages_take_nulls_repeats_and_nothing(spark):
    given = [(None, "a b c d", None, None, 7), (1, None, "en", "s", None), (1, "", "en", "s", 0), (2, "a b c d", "x", "t", 7), (2, "a b c d", "x", "t", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in (given, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in pipeline.STAGES[1:-1]:
            docs = stage(spark, docs, SF)
            assert docs.schema.names == schema.replace(" long", "").replace(" string", "").split(", ")
            assert docs.count() <= 2 * len(rows)
        assert pipeline.packed(spark, docs, SF).count() >= docs.count()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_oracle(spark, oracle, name):
    problem, _ = difference(queries.REGISTRY[name](spark, SF), oracle, queries.SQL[name])
    assert not problem


CONTRACTS = {
    "op1_context_mixing": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op2_markov_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op3_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op4_pivot_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op5_viterbi_counts": "doc_id bigint, n_tokens bigint",
    "op6_chunk_recipe_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op7_entropy_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_byte_prefix_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9_power_of_two_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op10_nbsvm_quality": "doc_id bigint, held_out boolean, score double, predicted int",
}


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_query_returns_its_columns_for_the_whole_table(spark, name):
    found = entry.queries()[name](spark, SF)
    kinds = dict(found.dtypes)
    for column in CONTRACTS[name].split(", "):
        assert kinds[column.split()[0]] == column.split()[1]
    ids = found.select(found.columns[0]).distinct().count()
    if name == "op4_pivot_top_k":
        assert ids == spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 100 = 0").count()
    else:
        assert ids == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_chunking_is_native(spark):
    found = chunk_dedup.chunk_dedup(spark.read.parquet(f"{SF}/documents.parquet"))
    text = found._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)
