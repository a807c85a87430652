"""The operators bound to the test tables: ``opN_<name>`` queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, fim, langid, lexical, licenses, lm, mixing, quality, secret_scan, sentencepiece, simhash, toxicity
from .common import fold_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query
def op2_lm(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op3_sentencepiece(spark, sf_dir):
    whole = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    docs = table(spark, sf_dir, "documents").withColumn("text_hash", whole)
    found = sentencepiece.decode(sentencepiece.encode(docs, keep=("text_hash",)))
    return found.select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), F.hex(F.xxhash64("ids")).alias("ids_hash"),
        F.round("log_prob", 6).alias("log_prob"), F.round("log_inclusion", 6).alias("log_inclusion"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"))


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold_of("doc_id", 4) != 2))
    return langid.predict(docs, model).select(
        "doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "runner_up")


@query
def op5_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.where(fold_of("doc_id", 3) != 1), labels.where(fold_of("doc_id", 3) != 1))
    return toxicity.score(docs, model).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op7_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", both), (-7, 1, "assistant", both)],
                                  "conv_id long, turn long, role string, text string")
    segments = chat.segments(turns.unionByName(extra))
    return chat.read_back(segments).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")


#: the template's rendering of one turn, its control strings escaped, in DuckDB SQL
_ESCAPED = r"""replace(replace(replace(replace(coalesce({}, ''), '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ': ', '\: ')"""

sql("op7_chat", rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
         AS loss_sha256,
       sum(length('### ' || {_ESCAPED.format('role')} || ': ' || {_ESCAPED.format('text')} || '</turn>' || chr(10)))::BIGINT
         AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                     WHEN before IN ('system', 'assistant') THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant'
                     ELSE false END AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM o GROUP BY conv_id
""")


@query
def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


MIX = {"target_entropy": 0.95, "max_repeat": 4.0, "seed": 7}


@query
def op8_mixing(spark, sf_dir):
    chosen = mixing.plan(table(spark, sf_dir, "documents"), **MIX)
    return chosen.select("doc_id", "source", "epoch", "n_tokens", "stream_at", F.round("place", 6).alias("place"),
                         F.round("weight", 6).alias("weight"), "alpha")


def _entropy(a: str) -> str:
    return (f"(SELECT ln(sum(exp(({a}) * l))) - ({a}) * sum(l * exp(({a}) * l)) / sum(exp(({a}) * l)) FROM t)")


def _repeat(a: str) -> str:
    return f"(SELECT exp((({a}) - 1) * min(l)) / sum(exp(({a}) * l)) FROM t)"


sql("op8_mixing", rf"""
WITH RECURSIVE u AS MATERIALIZED (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') || '|' || ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS mark,
         sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS n_tokens
  FROM documents GROUP BY ALL),
s AS MATERIALIZED (SELECT source, count(*) AS docs, sum(n_tokens)::BIGINT AS total FROM u GROUP BY 1
                   HAVING sum(n_tokens) > 0),
t AS MATERIALIZED (SELECT *, ln(total / (SELECT sum(total) FROM s)) AS l FROM s),
b(i, lo, hi, lo2, hi2) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END,
         CASE WHEN up2 THEN mid2 ELSE lo2 END, CASE WHEN up2 THEN hi2 ELSE mid2 END
  FROM (SELECT *, (lo + hi) / 2 AS mid, (lo2 + hi2) / 2 AS mid2,
               {_entropy("(lo + hi) / 2")} >= {MIX["target_entropy"]} * ln((SELECT count(*) FROM t)) AS up,
               {_repeat("(lo2 + hi2) / 2")} > {MIX["max_repeat"]} AS up2
        FROM b WHERE i < 40)),
a AS MATERIALIZED (SELECT round(greatest(
    CASE WHEN {_entropy("1.0::DOUBLE")} >= {MIX["target_entropy"]} * ln((SELECT count(*) FROM t)) THEN 1.0 ELSE lo END,
    CASE WHEN {_repeat("0.0::DOUBLE")} <= {MIX["max_repeat"]} THEN 0.0 ELSE hi2 END), 6) AS alpha FROM b WHERE i = 40),
w AS (SELECT t.*, alpha, exp(alpha * l) / (SELECT sum(exp(alpha * l)) FROM t, a) AS weight,
             (SELECT sum(total) FROM t) AS budget FROM t, a),
q AS (SELECT *, floor(round(weight * budget, 3))::BIGINT AS quota FROM w),
r AS (
  SELECT u.doc_id, u.source, u.mark, u.n_tokens, q.docs, q.total, q.quota, q.weight, q.alpha,
         ('0x' || substr(md5('{MIX["seed"]}|' || u.mark), 1, 8))::BIGINT
           % ceil(q.docs / {mixing.BLOCK})::BIGINT AS block,
         unnest(range(ceil(q.quota / q.total)::BIGINT))::INTEGER AS epoch
  FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source WHERE q.quota > 0),
k AS (SELECT source, epoch, block, sum(n_tokens) AS size FROM r GROUP BY ALL),
o AS (SELECT source, epoch, block, coalesce(sum(size) OVER (
        PARTITION BY source, epoch
        ORDER BY md5('{MIX["seed"]}|' || epoch || '|' || coalesce('s' || source, '') || '|' || block), block
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM k),
x AS (SELECT r.*, coalesce(sum(n_tokens) OVER (
        PARTITION BY source, epoch, block
        ORDER BY md5('{MIX["seed"]}|' || epoch || '|' || mark), doc_id, mark
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM r),
y AS (SELECT x.*, (x.epoch * x.total + o.ahead + x.inside)::BIGINT AS stream_at
      FROM x JOIN o ON x.source IS NOT DISTINCT FROM o.source AND x.epoch = o.epoch AND x.block = o.block)
SELECT doc_id, source, epoch, n_tokens, stream_at, round((stream_at + 0.5) / quota, 6) AS place,
       round(weight, 6) AS weight, alpha
FROM y WHERE stream_at < quota
""")


@query
def op10_quality(spark, sf_dir):
    return quality.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("word_distance", 6).alias("word_distance"), F.round("char_distance", 6).alias("char_distance"))


@query
def op11_fim(spark, sf_dir):
    formed = fim.transform(table(spark, sf_dir, "documents"))
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("form"), F.col("output")).cast("binary"), 256).alias("restored_sha256"))


sql("op11_fim", r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS k
  FROM documents),
d AS (
  SELECT *, len(k) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(k) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(k) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
c AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(k[1:least(a, b)], ''), '') AS p,
         coalesce(array_to_string(k[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
         coalesce(array_to_string(k[greatest(a, b) + 1:], ''), '') AS s FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
""")


@query
def op12_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans",
        "n_found")


@query
def op13_lexical(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .select("item_id", "rank", "doc_id", "score")


def _terms(text: str) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (rf"regexp_extract_all(translate(coalesce({text}, ''), '{letters}', '{letters.lower()}'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


sql("op13_lexical", f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS k FROM documents),
n AS (SELECT count(*) AS docs, sum(len(k))::BIGINT AS total FROM d WHERE len(k) > 0),
m AS (SELECT r, doc_id, 100 - 25 + (25 * len(k) * docs) // total AS m FROM d, n WHERE len(k) > 0),
q AS (SELECT item_id, row_number() OVER () AS i, unnest({_terms("text")}) AS t FROM benchmark),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(k) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, n GROUP BY t, docs),
s AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 20
""")
