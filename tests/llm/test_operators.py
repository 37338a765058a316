"""Operators of the training-data subpackage against plain versions, on odd rows."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import (
    ODD,
    ODD_IDS,
    SENTENCE,
    alnum_words,
    benchmark_hits,
    components_of,
    crc,
    documents,
    lower,
    simhash,
)

from glyphlex.llm import (
    decontaminate,
    exact_dedup,
    lm_score,
    packing,
    quality,
    queries,
    sharding,
    token_trees,
    toxicity,
    warc,
)
from glyphlex.llm import simhash as sim
from glyphlex.llm.labelled import held_out
from glyphlex.llm.tokens import WordEncoder, tokenizer_path

SF = "/root/testdata/sf0.001"
ITEMS = [(1, " ".join(SENTENCE.split()[:14])), (2, "lazy dog"), (2, "lazy dog"), (3, None), (4, "..."),
         (None, SENTENCE), (5, "zwölf Boxkämpfer"), (12, SENTENCE + " and more words that follow here")]


def test_dedup(spark):
    for ids, keep in ((ODD_IDS, "largest"), (list(range(len(ODD))), "smallest")):
        rows = exact_dedup.dedup(documents(spark, ODD, ids), keep=keep).collect()
        groups = defaultdict(list)
        for i, t in zip(ids, ODD):
            groups[lower(t)].append(i)
        assert len(rows) == len(ODD)
        for r in rows:
            own = groups[lower(r._row.text)]
            known = [i for i in own if i is not None]
            best = (max if keep == "largest" else min)(known) if known else None
            assert (r.keep_id, r.group_size) == (best, len(own))
            assert r.text_sha256 == hashlib.sha256(lower(r._row.text).encode()).hexdigest()
        kept = [lower(r._row.text) for r in rows if r.kept]
        assert sorted(kept) == sorted(groups)
        assert all(r._row.doc_id == r.keep_id for r in rows if r.kept)


def test_dedup_one_group_over_many_ranges(spark):
    texts = ["Same text"] * 700 + [f"text {k}" for k in range(300)]
    rows = exact_dedup.dedup(documents(spark, texts), keep="largest", carry=["doc_id"], parts=40).collect()
    assert {(r.keep_id, r.group_size) for r in rows if r._row.doc_id < 700} == {(699, 700)}
    assert sum(r.kept for r in rows) == 301


def test_empty_tables(spark):
    none = documents(spark, []).limit(0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ranks, pattern = tokenizer_path(queries.COUNT_RANKS), __import__("public_tokenizers").PATTERN
    assert exact_dedup.dedup(none).count() == 0
    assert sharding.shard(none).count() == 0
    assert sim.near_duplicates(none).count() == 0
    assert decontaminate.find_benchmark(none, items).count() == 0
    assert packing.pack(none, tokenizer_path(queries.PACK_TOKENIZER), 2).count() == 0
    assert lm_score.score(none, lm_score.train(none)).count() == 0
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0
    assert quality.score(none, quality.train(none, labels)).count() == 0
    assert token_trees.build_trees(none, ranks, pattern).count() == 0
    some = documents(spark, ODD)
    assert {r.score < 0.5 for r in toxicity.score(some, toxicity.train(some, labels)).collect()} == {True}
    assert quality.score(some, quality.train(some, labels)).where("score between 0 and 1").count() == len(ODD)
    clean = decontaminate.find_benchmark(some, items.limit(0)).collect()
    assert {(r.n_hit, len(r["items"])) for r in clean} == {(0, 0)}


@pytest.mark.parametrize("index_bytes", [1 << 20, 200])
def test_benchmark(spark, index_bytes):
    words = SENTENCE.split()
    texts = [*ODD, " ".join(words[:12]), "x " + " ".join(words[1:14]) + " y LAZY, dog", "zwölf! boxkämpfer",
             "Zwölf Boxkämpfer zwölf boxkämpfer", " ".join(words[:13] + ["no"] + words[3:])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate.find_benchmark(documents(spark, texts), items, index_bytes=index_bytes).collect()
    known = {(i, t) for i, t in ITEMS if i is not None}
    want = Counter()
    for t in texts:
        n, hit, met = benchmark_hits(t if t is None or len(t) < 9000 else t[:3000], known)
        if t is None or len(t) < 9000:
            want[t, n, hit, tuple(met)] += 1
    got = Counter((r._row.text, r.n_words, r.n_hit, tuple(r["items"])) for r in rows
                  if r._row.text is None or len(r._row.text) < 9000)
    assert got == want and len(rows) == len(texts)


def test_benchmark_random():
    rng = random.Random(5)
    for _ in range(60):
        vocabulary = [f"v{k}" for k in range(rng.choice([2, 5, 40]))]
        items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 8, 13, 20, 30])))) for k in range(5)]
        docs = []
        for _ in range(8):
            d = rng.choices(vocabulary, k=rng.choice([0, 4, 20, 60]))
            i = rng.choice(items)[1].split()
            docs.append(" ".join(d[:10] + i[rng.randint(0, 3):rng.randint(3, 30)] + d[10:]))
        index = decontaminate.build_index([(str(i), t.encode()) for i, t in items])
        for t, r in zip(docs, decontaminate.scan(pa.array(docs), index).to_pylist()):
            n, hit, met = benchmark_hits(t, items)
            assert (r["n_words"], sum(s["words"] for s in r["spans"]), sorted(r["items"])) == (n, hit, met)


def test_shards(spark):
    texts = ODD + ["hot " * 50] * 400 + [f"text number {k} " * (k % 9) for k in range(500)]
    ids = ODD_IDS + list(range(100, 1000))
    rows = sharding.shard(documents(spark, texts, ids), 16).collect()
    assert len(rows) == len(texts)
    size, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        assert r.size == len((r._row.text or "").encode()) + 1
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[r._row.text or ""].add(r.shard)
    assert set(size) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # a border may be off by half of the row at it; the long texts are rows of 300 kB
    largest = max(len((t or "").encode()) for t in texts)
    mean = sum(size.values()) / 16
    assert all(abs(sum(size[j] for j in range(k)) - k * mean) <= largest for k in range(16))


def test_shards_near_equal(spark):
    texts = ["hot text " * 9] * 4000 + [f"{k} " + "words " * (k % 13) for k in range(8000)]
    size, where = Counter(), defaultdict(set)
    for r in sharding.shard(documents(spark, texts), 16).collect():
        size[r.shard] += r.size
        where[r._row.text].add(r.shard)
    mean = sum(size.values()) / 16
    assert max(abs(s - mean) for s in size.values()) <= 0.01 * mean
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith("hot"))


def test_simhash(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choices(["red", "blue", "sun", "moon", "tree", "é"], k=60)) for _ in range(12)]
    texts = [*ODD, *base, *(b + rng.choice([" sun", " moon", "", " x"]) for b in base for _ in range(4))]
    ids = list(range(len(texts)))
    prints = [simhash(t, xxhash.xxh64_intdigest) for t in texts]
    want = components_of(prints, ids, 4)
    rows = sim.near_duplicates(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fingerprint & (2 ** 64 - 1) == prints[r._row.doc_id]
        assert r.component_id == want[r._row.doc_id]
        assert r.kept == (r._row.doc_id == r.component_id)
    odd = sim.near_duplicates(documents(spark, ODD, ODD_IDS)).collect()
    assert len(odd) == len(ODD)
    assert sum(r.kept for r in odd) == len(set(components_of(
        [simhash(t, xxhash.xxh64_intdigest) for t in ODD], list(range(len(ODD))), 4).values()))


def test_simhash_large_root_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(4)
    near = np.uint64(0x0F0F0F0F12345678) ^ (np.uint64(1) << rng.integers(0, 40, 900).astype(np.uint64)) ^ (
        np.uint64(1) << rng.integers(0, 40, 900).astype(np.uint64))
    codes = np.unique(np.concatenate([near, rng.integers(0, 2 ** 63, 300, dtype=np.uint64)]))
    monkeypatch.setattr(sim, "PIECE", 200)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    links = sim.link_fingerprints(df, len(codes), 4).collect()
    parent = np.arange(len(codes))
    at = {int(c): k for k, c in enumerate(codes.view(np.int64))}
    sim._join(parent, np.array([at[r.u] for r in links]), np.array([at[r.v] for r in links]))
    own = np.arange(len(codes))
    a, b = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4)
    sim._join(own, a, b)
    assert (own == parent).all()


def _pieces(rows, texts, encoder, end, size):
    ids = {i: np.append(np.frombuffer(encoder.whole(t or ""), "<u4"), end).astype("<u4") for i, t in texts.items()}
    seen, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        seen[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(seen) == set(ids)
    for i, own in seen.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids[i]))
            assert r.ids_crc32 == crc(ids[i][at:at + r.length].tobytes())
            if "ids" in r:
                assert r["ids"] == ids[i][at:at + r.length].tolist()
            at += r.length
        assert at == len(ids[i])
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    total = sum(map(len, ids.values()))
    assert len(windows) <= -(-total // size) + 1


def test_pack(spark):
    path = tokenizer_path(queries.PACK_TOKENIZER)
    encoder = WordEncoder(path)
    texts = ODD + [f"{SENTENCE} {k}" * (k % 7) for k in range(60)] + ["<|endoftext|> don't I'LL É.", "á ×b 1２"]
    for size in (64, 4096):
        rows = packing.pack(documents(spark, texts), path, 2, size=size).collect()
        _pieces(rows, dict(enumerate(texts)), encoder, 2, size)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([("a", "b")], "doc_id string, text string"), path, 2)


def test_sum_of_squares_rule():
    p, rng = packing.Packer(16), random.Random(1)
    for _ in range(500):
        n = rng.randint(1, 16)
        before = p.count.copy()
        costs = {}
        for h in range(0, 17 - n):
            if h and not before[h]:
                continue
            c = before.copy()
            if h:
                c[h] -= 1
            if h + n < 16:
                c[h + n] += 1
            costs[h] = int((c ** 2).sum())
        assert costs[p.level_for(n)] == min(costs.values())
        p.add([((None, n), 0, n, b"")], n)


def test_token_trees(spark):
    import public_tokenizers
    ranks, pattern = tokenizer_path(queries.COUNT_RANKS), public_tokenizers.PATTERN
    encode = token_trees.Encoder(ranks, pattern)
    rng = random.Random(3)
    alphabet = ["a", "b", " ", "  ", "\n", "'", "'s", "é", "1", ".", " the", " of", "\t", "中", "x" * 30]
    for trial in range(300):
        token_trees.LEAF_CHARS = rng.choice([1, 5, 400])
        t = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 40, 600])))
        tree = token_trees.Tree.build(t, encode)
        for _ in range(4):
            at, removed = rng.randint(0, len(t) + 2), rng.choice([0, 1, 5, 90])
            added = "".join(rng.choices(alphabet, k=rng.choice([0, 2, 30, 300])))
            want = t[:at] + added + t[at + removed:]
            t, _ = tree.edit(t, at, removed, added, encode)
            assert t == want and tree.total == encode.count(t) and tree.chars[1] == len(t)
    token_trees.LEAF_CHARS = 400
    docs = documents(spark, ODD, range(len(ODD)))
    state = token_trees.build_trees(docs.select("doc_id", "text"), ranks, pattern)
    assert {(r._row.doc_id, r.n_tokens) for r in state.collect()} == {
        (i, encode.count(t or "")) for i, t in enumerate(ODD)}
    edits = [(i, s, (i * 7 + s) % 50, s % 9, [" new words", "", None, "É "][s % 4])
             for i in (0, 5, 10, 99) for s in range(12)]
    token_trees.PASS_EDITS = 5
    done = token_trees.apply_edit_table(
        state.select("_row.doc_id", "_row.text", "tree"),
        spark.createDataFrame(edits, "doc_id long, seq int, at int, removed int, added string"), ranks, pattern)
    want = {i: t or "" for i, t in enumerate(ODD)}
    for i, _, at, removed, added in edits:
        if i in want:
            t = want[i]
            at = min(at, len(t))
            want[i] = t[:at] + (added or "") + t[at + removed:]
    got = {r.doc_id: (r.text or "", r.n) for r in done.select(
        "doc_id", "text", token_trees.n_tokens(done.tree).alias("n")).collect()}
    assert got == {i: (t, encode.count(t)) for i, t in want.items()}


def lm_start(digit=lm_score.LEAST_DIGITS, seed=0):
    """Weights that depend on the context, and counts of a vocabulary."""
    rng = np.random.default_rng(seed)
    v = lm_score.initial(rng.integers(0, 50, digit ** 3))
    return rng, v + (rng.standard_normal(len(v)) * 0.1).astype(np.float32)


@pytest.mark.parametrize("digit", [8, 11])
def test_lm_probabilities(digit):
    _, v = lm_start(digit)
    w = lm_score.parts(v)
    assert lm_score.digit_of(v) == digit
    line = np.array([0, 0, 5, 1, 4, 7, 300, 2, 0])
    every = np.arange(digit ** 3)
    place = np.full(len(every), lm_score.REACH)
    p, _ = lm_score.forward(w, line, place, every)
    assert abs(np.exp(p).sum() - 1) < 1e-4
    line[lm_score.REACH] = 9  # the word itself is not read
    assert np.array_equal(p, lm_score.forward(w, line, place, every)[0])


def test_lm_starts_from_shares():
    counts = np.arange(512.0)
    w = lm_score.parts(lm_score.initial(counts))
    w["c"][:] = w["e"][:] = 0
    every = np.arange(512)
    p, _ = lm_score.forward(w, np.zeros(9, int), np.full(512, 4), every)
    assert np.allclose(np.exp(p), (counts + 0.1) / (counts + 0.1).sum(), rtol=1e-3)


def test_lm_slopes():
    rng, v = lm_start()
    v = v.astype(np.float64)
    line = np.concatenate([np.zeros(4, int), rng.integers(0, 512, 20), np.zeros(4, int), rng.integers(0, 512, 9),
                           np.zeros(4, int)])
    place = np.flatnonzero(line)
    _, state = lm_score.forward(lm_score.parts(v), line, place)
    d, rows, de = lm_score.slopes(lm_score.parts(v), line, place, state)
    e = np.zeros_like(lm_score.parts(v)["e"])
    e[rows] = de
    g = np.concatenate([x.reshape(-1) for x in (e, *d.values())])
    for name, x in lm_score.parts(np.arange(len(v))[:], 8).items():
        for k in rng.choice(x.reshape(-1)[g[x.reshape(-1)] != 0], 8):
            step = np.zeros_like(v)
            step[k] = 1e-5
            up, down = (-lm_score.forward(lm_score.parts(v + s), line, place)[0].mean() for s in (step, -step))
            assert abs((up - down) / 2e-5 - g[k]) < 1e-6 + 1e-3 * abs(g[k]), name


def test_lm_steps_take_every_token():
    """A task's steps over texts in many blocks meet every token once."""
    texts = pa.array([SENTENCE] * 3000 + [None, "", max(filter(None, ODD), key=len)], pa.string())
    words = np.unique(lm_score.Words(np.array([0, len(SENTENCE)]), np.frombuffer(SENTENCE.encode(), np.uint8),
                                     lm_score.NOT_ALNUM).hash)
    counts = np.zeros(512)
    counts[1:1 + len(words)] = 3000
    start = lm_score.initial(counts)
    batches = [pa.RecordBatch.from_arrays([texts[k:k + 100]], ["t"]) for k in range(0, len(texts), 100)]
    [got] = lm_score._train_task(iter(batches), start, words, np.arange(len(words)))
    by_row = dict(zip(got["place"].to_pylist(), got["n"].to_pylist()))
    n = 3000 * len(SENTENCE.split()) + len(alnum_words(max(filter(None, ODD), key=len)))
    assert by_row[512] == n  # rows behind the words' count all tokens
    assert sum(by_row.get(k, 0) for k in range(1, 512)) == n
    w = lm_score.parts(start)
    sentence = lm_score.Model(start, words, np.arange(len(words)), counts)
    before = sentence.score(texts[:1])[1][0]
    table = np.resize(start, (-(-len(start) // lm_score.WIDTH), lm_score.WIDTH))
    table[got["place"].to_numpy()] = np.stack([got[c].to_numpy() for c in lm_score._COLUMNS], axis=1)
    sentence.vector = table.reshape(-1)[:len(start)]
    assert sentence.score(texts[:1])[1][0] > before and w["e"].shape == (512, lm_score.WIDTH)


def test_lm_vocabulary(spark):
    """Grows with the words that occur often; buckets hold the counts of the rest."""
    rows = [(k * 2654435761 - (1 << 40), 1 + k % 7) for k in range(3000)]
    words = spark.createDataFrame(rows, "word long, n long")
    keys, rank, counts = lm_score.vocabulary(words)
    often = [w for w, n in sorted(rows, key=lambda r: (-r[1], r[0])) if n >= lm_score.OFTEN]
    digit = round(len(counts) ** (1 / 3))
    assert lm_score.frequent(digit - 1) < len(often) <= lm_score.frequent(digit)
    assert list(keys[np.argsort(rank)].view(np.int64)) == often and list(keys) == sorted(keys)
    want = np.zeros(lm_score.BUCKETS)
    for w, n in rows:
        want[w % lm_score.BUCKETS] += n * (n < lm_score.OFTEN)
    assert list(counts[-lm_score.BUCKETS:]) == list(want) and counts.sum() == sum(n for _, n in rows)


def test_lm_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = lm_score.train(docs)
    rows = lm_score.score(documents(spark, ODD), model).collect()
    assert len(rows) == len(ODD)
    w = lm_score.parts(model.vector)
    for r in rows:
        n, total = model.score(pa.array([r._row.text], pa.string()))
        assert r.n_tokens == n[0] == len(alnum_words(r._row.text))
        assert abs(r.log_prob - total[0]) <= 1e-3 * max(1, n[0])
        assert r.n_tokens or r.log_prob == 0
    # one text by hand, place by place
    words = lm_score.Words(np.array([0, len(SENTENCE)]), np.frombuffer(SENTENCE.encode(), np.uint8),
                           lm_score.NOT_ALNUM)
    line, place = lm_score.tokens_of(words, model.keys, model.rank, model.digit)
    own = sum(float(lm_score.forward(w, line, np.array([p]))[0][0]) for p in place)
    assert abs(own - model.score(pa.array([SENTENCE]))[1][0]) < 1e-2
    trained = lm_score.score(docs, model).agg({"log_prob": "sum"}).first()[0]
    start = lm_score.Model(lm_score.initial(model.counts), model.keys, model.rank, model.counts)
    assert trained > lm_score.score(docs, start).agg({"log_prob": "sum"}).first()[0]


@pytest.mark.parametrize("name,label,least", [("op6_quality", "quality", 0.9), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = queries.REGISTRY[name][0](spark, sf)
    assert rows.count() == docs.count() and rows.where("score not between 0 and 1").count() == 0
    own = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (crc(str(r.doc_id).encode()) % 5 == 0) for r in own)
    assert sum(r.predicted == r[label] for r in own) >= least * len(own)


def test_classifiers_on_odd_rows(spark):
    docs = documents(spark, ODD, ODD_IDS)
    labels = spark.createDataFrame([(5, 1, 1), (5, 1, 1), (7, 0, 0), (None, 1, 1), (3, None, None), (11, 0, 1),
                                    (77, 0, 1)], "doc_id long, quality int, toxic int")
    for op in (quality, toxicity):
        rows = op.score(docs, op.train(docs, labels)).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert docs.where(held_out(docs.doc_id)).count() == sum(
        i is not None and crc(str(i).encode()) % 5 == 0 for i in ODD_IDS)


def test_warc(spark):
    big = "é<b>" * 200_000
    pages = [(1, "http://a", big), (2, "http://b\r\n", "p"), (3, None, "p"), (3, None, "p"), (4, "u", None),
             (None, "u", "q"), (5, "u", ""), (6, "u", big), (7, "u", "WARC/1.1\r\n\r\nWARC-Type: x")]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages],
                               "page_id long, url string, html string, digest string, uid int")
    folder, manifest = warc.write_archives(df)
    rows = warc.read_archives(spark, folder, manifest).collect()
    best = {}
    for i, _, h in pages:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    records = defaultdict(list)
    for r in rows:
        records[r.record_id].append(r)
    assert len(records) == len(pages)
    seen = Counter()
    for own in records.values():
        own.sort(key=lambda r: r.chunk_no)
        r = own[-1]
        assert r.last and not any(x.last for x in own[:-1])
        page = None if r.page_id is None else int(r.page_id)
        want = next((h or "").encode() for i, _, h in pages if i == page)
        assert r.payload_bytes == len(want)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(want).digest()).decode()
        if r.record_type == "response":
            assert b"".join(x.data for x in own) == want and r.running == r.payload_digest
            assert len(own) == max(1, -(-len(want) // warc.CHUNK))
            seen[want] += 1
        else:
            assert int(r.refers_to) == best[want.decode()]
    assert set(seen.values()) == {1} and len(seen) == len(best)
    folder, manifest = warc.write_archives(df, min_bytes=1)
    types = Counter((r.record_type, r.payload_bytes) for r in
                    warc.read_archives(spark, folder, manifest, with_data=False).where("last").collect())
    assert types["response", 0] == 2 and types["revisit", 0] == 0
    folder, manifest = warc.write_archives(df.limit(0))
    assert warc.read_archives(spark, folder, manifest).count() == 0


def test_lm_rare_words_keep_their_identity(spark):
    """More words than the network has tokens: a rare word counts with its own share
    of its bucket, and so a swap for another word of the bucket shows."""
    def digest(w):
        return int(lm_score.Words(np.array([0, len(w)]), np.frombuffer(w.encode(), np.uint8),
                                  lm_score.NOT_ALNUM).hash[0])
    texts = [" ".join(f"word{j}" for j in range(k % 7, 1500, 1 + k % 5)) for k in range(40)] + ODD
    docs = documents(spark, texts)
    counts = Counter(w for t in texts for w in alnum_words(t))
    words = lm_score.word_counts(docs)
    assert words.count() == len(counts)
    model = lm_score.train(docs, words=words)
    frequent = set(model.keys.tolist())
    assert len(frequent) == lm_score.FREQUENT < len(counts)
    rare = {w: digest(w) for w in counts if digest(w) not in frequent}
    total = Counter()
    for w, h in rare.items():
        total[h % lm_score.BUCKETS] += counts[w]
    seen = max(rare, key=lambda w: (counts[w], w))
    unseen = next(f"garbage{k}" for k in range(10 ** 6)
                  if (digest(f"garbage{k}") - rare[seen]) % lm_score.BUCKETS == 0)
    asked = texts + [f"a {seen} b", f"a {unseen} b"]
    rows = lm_score.score(documents(spark, asked), model, words=words).collect()
    assert sorted(r._row.doc_id for r in rows) == list(range(len(asked)))
    for r in rows:
        n, own = model.score(pa.array([r._row.text], pa.string()))
        for w in alnum_words(r._row.text):
            if digest(w) not in frequent:
                own = own + np.log(max(1, counts[w]) / (total[digest(w) % lm_score.BUCKETS] + 1))
        assert r.n_tokens == n[0]
        assert abs(r.log_prob - own[0]) <= 1e-3 * max(1, n[0])
    swapped = {r._row.doc_id: r.log_prob for r in rows}
    assert swapped[len(texts)] - swapped[len(texts) + 1] == pytest.approx(np.log(counts[seen]), abs=1e-3)
