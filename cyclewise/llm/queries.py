"""Registered queries of the training-data operators: ``opN_<name>`` -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, html, langid, lm, minhash, mixing, phrases, pieces, quality, rans, rules, suffix, variants
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs.filter(fold("doc_id", 3) != 1))
    held = docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out"))
    out = langid.identify(held.select(F.struct("doc_id", "held_out").alias("k"), "text"), net, "k")
    return out.select("k.doc_id", "k.held_out", "lang_pred", "score")


# Targets by water filling in the order of cap / weight; taken words by a running sum over the hash.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT), 0) AS h
  FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n FROM d GROUP BY source),
w AS (SELECT source, n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS wt,
             row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 2 * n / wt, pos) AS k FROM w),
r AS (SELECT *, 1.5::DOUBLE * sum(n) OVER () - coalesce(sum(2 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS amount,
             sum(wt) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight FROM o),
f AS (SELECT *, amount * wt / weight <= 2 * n AS fits FROM r),
g AS (SELECT arg_min(amount, k) AS amount, arg_min(weight, k) AS weight, min(k) AS k FROM f WHERE fits),
t AS (SELECT f.source, f.n::BIGINT AS source_size, CASE WHEN f.k < g.k THEN 2 * f.n ELSE least(2 * f.n, g.amount * f.wt / g.weight) END AS target FROM f, g),
p AS (SELECT t.*, CASE WHEN source_size = 0 THEN 0 WHEN target >= 2 * source_size THEN 2 WHEN target >= source_size THEN 1 ELSE 0 END AS copies FROM t),
c AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.copies,
             CASE WHEN p.copies = 2 THEN 0 ELSE p.target - p.copies * p.source_size END AS need,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, d.h) AS own
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto - own < need AND (upto <= need OR upto - need < need - (upto - own)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""


@query(MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


@query()
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = fold("doc_id", 7) == 2
    got = lm.score(table(spark, sf_dir, "documents"), ~held, byte_tokenizer())
    return got.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op4_exact_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs.filter(fold("doc_id", 3) != 1), labels.filter(fold("doc_id", 3) != 1))
    return quality.score(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.read_files(spark, rans.write_files(table(spark, sf_dir, "documents"), byte_tokenizer()))


@query()
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query()
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query()
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


# Distinct words of documents with the deletion rule, near words by deletion of one code point,
# forms followed step by step; CRC-32 by its table, made from the polynomial.
VARIANT_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
runs AS (
  SELECT id, run, count(*) AS k FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL),
hexed AS (SELECT *, hex(id || ':' || run) AS x FROM runs),
crc AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda j: ('0x' || substr(x, (2 * j + 1)::BIGINT, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM hexed, tab),
res AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM crc),
w AS (SELECT word, sum(k)::BIGINT AS n FROM res WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
d AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS v FROM w, unnest(range(length(word))) u(p)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.v = b.v AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.v = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS m FROM near GROUP BY word),
pick AS (SELECT best.word, n_near, m, min(other) AS other FROM best JOIN near ON near.word = best.word AND near.n = m GROUP BY ALL),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
      FROM w LEFT JOIN pick ON pick.word = w.word),
chain AS (SELECT word, word AS last, 0 AS step FROM f UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON f.word = chain.last WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root FROM f JOIN (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word) r ON r.word = f.word
"""


@query(VARIANT_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


# Phrases spelled out and counted as strings; scores in 128-bit integers.
PHRASE_SQL = r"""
WITH words AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, 1 AS size, unnest(ws) AS p FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i : i + 1], ' '))) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' '))) FROM words
  UNION ALL SELECT lang, 4, unnest(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' '))) FROM words),
f AS MATERIALIZED (SELECT lang, size, p, string_split(p, ' ') AS ws, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
longer AS (SELECT lang, q, max(a) AS longest FROM (
  SELECT lang, array_to_string(ws[1 : size - 1], ' ') AS q, a FROM f WHERE size > 2 UNION ALL SELECT lang, array_to_string(ws[2 : size], ' '), a FROM f WHERE size > 2) GROUP BY ALL),
kept AS (SELECT f.* FROM f LEFT JOIN longer ON longer.lang = f.lang AND longer.q = f.p WHERE size > 1 AND (longest IS NULL OR 100 * longest::HUGEINT < 80 * f.a::HUGEINT)),
parts AS (SELECT lang, p, a, k, array_to_string(ws[1 : k], ' ') AS head, array_to_string(ws[k + 1 : size], ' ') AS tail FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)),
cuts AS (
  SELECT parts.lang, parts.p, parts.a, k, l.a AS l, r.a AS r, (2000000 * parts.a::HUGEINT) // (l.a::HUGEINT + r.a::HUGEINT) AS score
  FROM parts JOIN f l ON l.lang = parts.lang AND l.p = head JOIN f r ON r.lang = parts.lang AND r.p = tail),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM best)
SELECT lang, rank, p AS phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query(PHRASE_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query()
def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))
