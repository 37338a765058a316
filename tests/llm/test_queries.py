"""The registered queries against their SQL or a plain version, and the pipeline."""

import hashlib

import duckdb
import numpy as np
import pytest
import xxhash
from helpers import ODD, ODD_IDS, SENTENCE, benchmark_hits, components_of, crc, documents, lower, simhash

import __spark_entry__ as E
import corpus_pipeline
from glyphlex.llm import decontaminate, queries
from glyphlex.llm.tokens import WordEncoder, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_registered():
    names = E.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.REGISTRY.items() if sql])
def test_sql(spark, tables, name):
    got = E.queries()[name](spark, SF)
    want = tables.execute(E.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(
        map(repr, want.fetchall()))


def test_simhash_query(spark, tables):
    docs = tables.execute("SELECT doc_id, text FROM documents").fetchall()
    prints = [simhash(t, xxhash.xxh64_intdigest) for _, t in docs]
    want = components_of(prints, [i for i, _ in docs], 4)
    rows = E.queries()["op7_simhash"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (i, f"{p:016x}", want[i]) for (i, _), p in zip(docs, prints)}


def test_shard_query(spark, tables):
    docs = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    rows = E.queries()["op8_shard"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, crc(raw), "bytes", None)


def test_warc_query(spark, tables):
    pages = dict(tables.execute("SELECT page_id, html FROM pages").fetchall())
    best = {}
    for i, h in pages.items():
        best[h] = max(best.get(h, -1), i)
    rows = E.queries()["op9_warc"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        first = best[pages[r.page_id]]
        assert (r.record_type, r.refers_to) == (
            ("response", None) if first == r.page_id else ("revisit", first))
        assert r.payload_bytes == len(pages[r.page_id].encode())


def test_token_count_query(spark, tables):
    import public_tokenizers
    from glyphlex.llm import token_trees
    encode = token_trees.Encoder(tokenizer_path(queries.COUNT_RANKS), public_tokenizers.PATTERN)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edits = {r.doc_id: (r.text, r.e) for r in docs.select(
        "doc_id", "text", queries.document_edits(docs.doc_id, docs.text).alias("e")).collect()}
    rows = E.queries()["op5_token_counts"](spark, SF).collect()
    assert len(rows) == len(edits)
    for r in rows:
        t, todo = edits[r.doc_id]
        assert r.n_tokens == encode.count(t)
        for e in todo:
            at = min(e["at"], len(t))
            t = t[:at] + e["added"] + t[at + e["removed"]:]
        assert (r.n_tokens_edited, r.n_chars_edited, r.text_crc32) == (encode.count(t), len(t), crc(t.encode()))


def plain_pipeline(docs, toxic, items):
    """Documents that are packed: {doc_id: text}."""
    docs = {i: t for i, t in docs.items() if i not in toxic}
    last = {}
    for i, t in sorted(docs.items()):
        last[lower(t)] = i
    docs = {i: docs[i] for i in last.values()}
    ids = sorted(docs)
    of = components_of([simhash(docs[i], xxhash.xxh64_intdigest) for i in ids], ids, 4)
    docs = {i: docs[i] for i in ids if of[i] == i}
    out = {}
    for i, t in docs.items():
        n, hit, _ = benchmark_hits(t, items)
        if not (hit and 20 * hit >= n):
            out[i] = t
    return out


def test_pipeline(spark, tables):
    docs = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    items = tables.execute("SELECT item_id, text FROM benchmark").fetchall()
    toxic = {r.doc_id for r in E.queries()["op10_toxicity"](spark, SF).where("predicted = 1").collect()}
    want = plain_pipeline(docs, toxic, items)
    encoder = WordEncoder(tokenizer_path(queries.PACK_TOKENIZER))
    got = {}
    for r in corpus_pipeline.run(spark, SF).orderBy("doc_id", "start").collect():
        got.setdefault(r.doc_id, []).extend(r["ids"])
    assert got == {i: np.frombuffer(encoder.whole(t), "<u4").tolist() + [2] for i, t in want.items()}


def test_stages_on_odd_rows(spark):
    for texts, ids in ((ODD, ODD_IDS), ([], [])):
        docs = documents(spark, texts, ids) if texts else documents(spark, ODD).limit(0)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= len(texts)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == len(set(ids))


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def odd_benchmark(spark, folder, items, texts):
    """op1 by Spark and by its SQL, over a benchmark of its own."""
    documents(spark, texts).select("doc_id", "text").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    got = E.queries()["op1_decontaminate"](spark, folder).toPandas()
    want = con.execute(E.oracle_sql()["op1_decontaminate"]).fetchdf()
    cols = sorted(want.columns)
    assert sorted(map(tuple, got[cols].astype(str).values)) == sorted(map(tuple, want[cols].astype(str).values))
    return {r.doc_id: r for r in got.itertuples()}


@pytest.mark.parametrize("index_bytes", [1 << 20, 100])
def test_items_without_identifier_hit_words(spark, tmp_path, index_bytes):
    items = [(1, "lazy dog"), (None, "zwölf Boxkämpfer"), (None, "wizards quietly")]
    texts = [SENTENCE, "a zwölf boxkämpfer b", "zwölf boxkämpfer, wizards quietly; the lazy dog", "none", None]
    rows = odd_benchmark(spark, str(tmp_path), items, texts)
    assert [(rows[k].n_hit, rows[k].n_items, rows[k].contaminated) for k in range(4)] == [
        (4, 2, True), (2, 1, True), (6, 2, True), (0, 0, False)]
    found = decontaminate.find_benchmark(documents(spark, texts), spark.createDataFrame(
        items, "item_id long, text string"), index_bytes=index_bytes).collect()
    assert {r._row.doc_id: (r.n_hit, r.n_items, r["items"]) for r in found} == {
        0: (4, 2, ["1"]), 1: (2, 1, []), 2: (6, 2, ["1"]), 3: (0, 0, []), 4: (0, 0, [])}


@pytest.mark.parametrize("index_bytes", [1 << 20, 100])
def test_one_identifier_on_two_texts_is_one_item(spark, tmp_path, index_bytes):
    items = [(1, "lazy dog"), (1, "wizards quietly"), (2, "seven"), (2, "their boxes")]
    rows = odd_benchmark(spark, str(tmp_path), items, [SENTENCE, "a lazy dog"])
    assert [rows[k].n_items for k in range(2)] == [2, 1]
    found = decontaminate.find_benchmark(documents(spark, [SENTENCE, "a lazy dog"]), spark.createDataFrame(
        items, "item_id long, text string"), index_bytes=index_bytes).collect()
    assert {r._row.doc_id: (r.n_items, r["items"]) for r in found} == {0: (2, ["1", "2"]), 1: (1, ["1"])}
