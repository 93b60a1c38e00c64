"""The registered queries: oracle SQL, contract columns, and the pipeline against its stages done by hand."""

import struct
import zlib

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from medallion_ops.llm.queries import ORACLE, QUERIES, tokenizer_path
from medallion_ops.session import materialize

from .odd import TEXTS, documents, empty
from .test_texts import _components, _hits

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": ["doc_id", "size", "source_size", "target", "taken"], "op3": ["query_id", "rank", "vec_id", "score"],
    "op4": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op5": ["doc_id", "held_out", "score", "predicted"], "op7": ["doc_id", "held_out", "score", "predicted"],
    "op8": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op10": ["doc_id", "fingerprint", "component_id"],
    "op11": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op12": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    """Contract columns, a row per document (or page record), and the oracle's rows where there is one."""
    df = materialize(QUERIES[name](spark, SF), "query")
    n = name.split("_")[0]
    assert df.columns[:len(COLUMNS.get(n, []))] == COLUMNS.get(n, [])
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    if n not in ("op2", "op3", "op12", "op13"):
        assert df.count() == docs
    if name in ORACLE:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark", "labels", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        res = con.execute(ORACLE[name])
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_pipeline_is_its_stages(spark):
    """The rows of run() are those of the stages applied by hand to each one's stored input."""
    docs = corpus_pipeline.table(spark, SF, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        assert name == "token_files" or docs.columns == columns
        seen.append(docs)
    start, safe, single, clean, mixed, tokens = [d.collect() for d in seen]
    ids = lambda rows: [r.doc_id for r in rows]
    assert set(ids(safe)) <= set(ids(start)) and len(safe) > 0.7 * len(start)

    from medallion_ops.llm.simhash import fingerprint
    root, first = _components([fingerprint(r.text) for r in safe]), {}
    for r in safe:
        k = root[fingerprint(r.text)]
        first[k] = min(first.get(k, r.doc_id), r.doc_id)
    assert sorted(ids(single)) == sorted(first.values())

    items = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, SF, "benchmark").collect()]
    words = {w for _, t in items for w in t.lower().split()}
    dirty = {r.doc_id for r in single if len(words & set(r.text.lower().split())) >= 8 and _hits(r.text, items)[1]}
    assert sorted(ids(clean)) == sorted(set(ids(single)) - dirty)

    from medallion_ops.llm.mixing import mix_to_weights
    copies = {r.doc_id: r.copies for r in mix_to_weights(seen[3]).collect()}
    assert sorted(ids(mixed)) == sorted(i for i, n in copies.items() for _ in range(n))

    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    at, want = 0, []
    for r in sorted(mixed, key=lambda r: r.doc_id):
        got = t.encode(r.text, add_special_tokens=False).ids + [0]
        want.append((r.doc_id, at, len(got), zlib.crc32(struct.pack(f"<{len(got)}I", *got))))
        at += len(got)
    assert sorted(map(tuple, tokens)) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows_and_on_nothing(spark, name, stage):
    docs = documents(spark)
    out = stage(spark, docs, SF)
    assert name == "token_files" or out.columns == docs.columns
    assert 0 < out.count() <= 2 * len(TEXTS)
    assert stage(spark, empty(spark), SF).count() == 0
