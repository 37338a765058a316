"""Registered queries of this subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations,
    decontaminate,
    exact_dedup,
    importance,
    lm_score,
    main_text,
    packing,
    quality,
    sharding,
    simhash,
    token_trees,
    toxicity,
    warc,
)
from .common import hex64, table
from .labelled import held_out
from .tokens import tokenizer_path

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def put(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return put


WORDS_SQL = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP1_CTE = f"""
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({WORDS_SQL.format(t='text')}, []) AS w FROM {{docs}}),
b AS (SELECT DISTINCT item_id, w FROM (SELECT item_id, {WORDS_SQL.format(t='text')} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM b)),
dw AS (SELECT rid, p, k.n, array_to_string(w[p:p + k.n - 1], ' ') AS g
       FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM d), (SELECT DISTINCT n FROM iw) k
       WHERE p + k.n - 1 <= len(w)),
m AS (SELECT rid, p, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
h AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT rid, p, n FROM m)) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY rid)"""


@register("op1_decontaminate", f"""WITH {OP1_CTE.format(docs='documents')}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN it USING (rid)""")
def op1(spark, sf_dir):
    """Benchmark decontamination by winnowing: all documents against all items."""
    found = decontaminate.find_benchmark(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register("op4_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY {LOWER_SQL} ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256({LOWER_SQL}) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY {LOWER_SQL})""")
def op4(spark, sf_dir):
    """Exact dedup by content sort; the largest doc_id of a group stays."""
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"), keep="largest", carry=["doc_id"])
    return found.select("_row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op8_shard")
def op8(spark, sf_dir):
    """Histogram sort into 16 shards of nearly equal bytes."""
    dealt = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)
    return dealt.select(
        "_row.doc_id", "size",
        F.crc32(F.encode(F.coalesce("_row.text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op7_simhash")
def op7(spark, sf_dir):
    """SimHash near-duplicates: 4-word shingles, at most 4 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4,
                                    carry=["doc_id"])
    return found.select("_row.doc_id", F.lower(hex64(F.col("fingerprint"))).alias("fingerprint"),
                        "component_id")


#: The vocabulary file of the packing query and its end mark.
PACK_TOKENIZER, PACK_END = "word_bpe_49k.json", 2


@register("op3_pack")
def op3(spark, sf_dir):
    """Sum-of-squares packing of all documents into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(PACK_TOKENIZER), PACK_END,
                        with_ids=False)


def _scored(found, threshold):
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), held_out(F.col("_row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


@register("op6_quality")
def op6(spark, sf_dir):
    """Quality of every document by compression with good and bad dictionaries."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _scored(quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"))), 0.3)


@register("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity of every document by positive-unlabelled learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _scored(toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))), 0.5)


@register("op9_warc")
def op9(spark, sf_dir):
    """All pages written as WARC records and read back."""
    pages = table(spark, sf_dir, "pages")
    folder, manifest = warc.write_archives(pages, min_bytes=0)
    back = warc.read_archives(spark, folder, manifest, with_data=False).where("last")
    kind = pages.schema["page_id"].dataType
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


@register("op2_lm_score")
def op2(spark, sf_dir):
    """Masked pseudo-likelihood of every document, by a network trained on all of them
    and the counts of all their words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = lm_score.word_counts(docs)
    found = lm_score.score(docs, lm_score.train(docs, words=words), words=words)
    return found.select("_row.doc_id", "n_tokens", "log_prob",
                        F.try_divide("log_prob", "n_tokens").alias("mean_log_prob"))


COUNT_RANKS = "byte_bpe_50k.tiktoken"


def document_edits(doc_id, text):
    """Three edits of a text, from its identifier: a place, characters to remove, and
    what comes in."""
    def one(k):
        h = F.xxhash64(F.lit(k), doc_id)
        added = F.element_at(F.array(*map(F.lit, ["", " and so on", "\n\n## 42. ", " déjà-vu,"])),
                             (F.pmod(h, F.lit(4)) + 1).cast("int"))
        return F.struct(F.pmod(F.shiftrightunsigned(h, 8), F.coalesce(F.length(text), F.lit(0)) + 1)
                        .cast("int").alias("at"),
                        F.pmod(F.shiftrightunsigned(h, 40), F.lit(40)).cast("int").alias("removed"),
                        added.alias("added"))
    return F.array(*[one(k) for k in range(3)])


@register("op5_token_counts")
def op5(spark, sf_dir):
    """Token counts of all documents before and after three edits of each."""
    import public_tokenizers
    ranks, pattern = tokenizer_path(COUNT_RANKS), public_tokenizers.PATTERN
    state = token_trees.build_trees(
        table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    text, ident = F.col("_row.text"), F.col("_row.doc_id")
    done = state.withColumn("done", token_trees.apply_edits(
        text, F.col("tree"), document_edits(ident, text), ranks, pattern))
    return done.select(
        ident.alias("doc_id"), "n_tokens", token_trees.n_tokens(F.col("done.tree")).alias("n_tokens_edited"),
        F.length("done.text").cast("long").alias("n_chars_edited"),
        F.crc32(F.encode("done.text", "UTF-8")).alias("text_crc32"),
        F.col("done.encoded").alias("chars_encoded_again"))


#: For pages of the given form: one article, blocks in ``h1`` and ``p``.
OP11_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''),
                  '(?s)<article>(.*?)(</article>|\z)', 1), '</?(?:p|h1)>') AS parts FROM pages),
b AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(x, '<[^>]*>', ' ', 'g')) AS parts FROM a),
c AS (SELECT page_id, url, list_transform(parts, lambda x: replace(replace(regexp_replace(regexp_replace(
             regexp_replace(x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#39;', ''''), '&#x27;', '''')) AS parts FROM b),
d AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(
             regexp_replace(x, '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM c),
e AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM d)
SELECT page_id, url, text, length(text) AS n_chars FROM e"""


@register("op11_main_text", OP11_SQL)
def op11(spark, sf_dir):
    """Main text of every page by tree scoring."""
    found = main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("_row.page_id", "_row.url", "text", "n_chars")


#: CRC-32 of a word from the 256 remainders of the reversed polynomial.
OP12_SQL = rf"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
                  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({WORDS_SQL.format(t='text')}, []) AS w FROM documents),
dw AS (SELECT rid, unnest(w) AS word FROM d),
bw AS (SELECT unnest({WORDS_SQL.format(t='text')}) AS word FROM benchmark),
x AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
y AS (SELECT word, list_transform(range(len(h) // 2), lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16
             + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS bytes FROM x),
k AS (SELECT word, xor(list_reduce(list_concat([4294967295], bytes),
             lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM y, t),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN k USING (word) GROUP BY bucket),
u AS (SELECT bucket, count(*) AS n FROM bw JOIN k USING (word) GROUP BY bucket),
g AS (SELECT b.bucket, CAST(floor(1000 * ln((coalesce(u.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)
             / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)))) AS BIGINT) AS gain
      FROM (SELECT DISTINCT bucket FROM k) b LEFT JOIN s USING (bucket) LEFT JOIN u USING (bucket)),
m AS (SELECT rid, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
      FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY rid),
h AS (SELECT rid, ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d),
f AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000.0 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN m USING (rid) JOIN h USING (rid)),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM f WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END AS rank
FROM f LEFT JOIN r USING (rid)"""


@register("op12_importance", OP12_SQL)
def op12(spark, sf_dir):
    """A tenth of the documents, in favour of those that look like the benchmark."""
    found = importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                table(spark, sf_dir, "benchmark"), percent=10, least_words=20, n=1,
                                buckets=10000, seed=2024)
    return found.select(F.col("_row.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP13_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
      FROM i, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
x AS (SELECT c.*, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
      FROM c, (SELECT unnest([1, 2]) AS cut) WHERE cut < k),
y AS (SELECT x.lang, x.k, x.phrase, a, x.w, cut, g.n AS l, h.n AS r,
             CAST(1000000::HUGEINT * a * a // (g.n::HUGEINT * h.n) AS BIGINT) AS score
      FROM x JOIN f g ON g.lang = x.lang AND g.k = cut AND g.phrase = head
             JOIN f h ON h.lang = x.lang AND h.k = x.k - cut AND h.phrase = tail),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, cut) = 1),
o AS (SELECT lang, part, max(a) AS most FROM (
          SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3)
      GROUP BY ALL),
q AS (SELECT z.* FROM z LEFT JOIN o ON z.k = 2 AND o.lang = z.lang AND o.part = z.phrase
      WHERE most IS NULL OR 100 * most < 50 * a),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM q JOIN n USING (lang) QUALIFY rank <= 2000"""


@register("op13_collocations", OP13_SQL)
def op13(spark, sf_dir):
    """The 2000 strongest phrases of 2 and 3 words of each language."""
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.collocations(docs, most_words=3, least=10, within=50, top=2000)
