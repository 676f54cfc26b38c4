"""The numbered queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ball_kmeans, chat, exact_dedup, html_text, lm, mixing, near_dedup, ngram_join, packing, prefix_trie, token_files, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT sk, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY sk),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY sk) - 1) % 3] AS BIGINT) AS w, source_size * 3 AS cap,
             CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
o AS (SELECT *, cap * sum(w) OVER (ORDER BY cap / w, sk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
             <= (total - coalesce(sum(cap) OVER (ORDER BY cap / w, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS over_cap FROM w),
t AS (SELECT sk, source_size, CASE WHEN over_cap THEN CAST(cap AS DOUBLE)
             ELSE CAST((total - coalesce(sum(CASE WHEN over_cap THEN cap END) OVER (), 0)) * w AS DOUBLE)
                  / CAST(sum(CASE WHEN NOT over_cap THEN w END) OVER () AS DOUBLE) END AS target FROM o),
b AS (SELECT sk, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
             CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY sk ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM d)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, budget - whole * source_size - ahead)) AS BIGINT) AS taken
FROM p JOIN b USING (sk)
"""


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    turns = rows.withColumn("turn", F.row_number().over(place).cast("long"))
    # the log of a conversation: each turn opens with half of its text, and a delta brings the rest
    half = F.floor(F.length("text") / 2).cast("int")
    parts = F.array(
        F.struct((2 * F.col("turn")).alias("seq"), F.lit("message").alias("kind"), F.left("text", half).alias("said")),
        F.struct((2 * F.col("turn") + 1).alias("seq"), F.lit("delta").alias("kind"), F.substring("text", half + 1, F.length("text")).alias("said")),
    )
    events = turns.select("conv_id", "turn", "role", F.inline(parts)).withColumnRenamed("said", "text")
    out = chat.render(chat.fold_events(events)).withColumn("_turns", chat.parse_turns(F.col("formatted")))
    digest = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return out.withColumn("_loss", loss).select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
r AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '') AS loss,
             CAST(sum(length('<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<|nl|>') || chr(10)
                 || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
      FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
             row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) AS rn FROM t)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(text) AS text_sha256 FROM g
"""

def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_round_trip(_table(spark, sf_dir, "documents"))


def _crc(column: str, mod: int):
    return F.crc32(F.col(column).cast("string")) % mod


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels but for the rows held out: those whose crc32 of the id leaves 0 modulo 5."""
    return labels.filter(_crc("doc_id", 5) != 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, training_labels(_table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id", F.coalesce(_crc("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        toxicity.rejected(model).alias("rejected"),
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html_text.extract_pages(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_crc("doc_id", 7) == 2, F.lit(False))
    scored = lm.score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out)
    return scored.withColumn("held_out", held_out)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.branched(_table(spark, sf_dir, "conversations"), every=20, most=3))


#: crc32 bit by bit over the characters of the decimal id; a prefix is known by the digests of its turns, 64 characters each.
OP11_SQL = r"""
WITH ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
r AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
      FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT i.conv_id, r.k AS pos, role, text FROM ids i JOIN r ON r.conv_id = i.base AND r.k <= i.h
      UNION ALL SELECT i.conv_id, r.k + 3, role, text FROM ids i JOIN r ON r.conv_id = i.conv_id AND r.k > i.h),
p AS (SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
             string_agg(sha256(length(role) || ':' || role || text), '') OVER w AS prefix
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
      UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
n AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM p GROUP BY prefix, depth),
c AS (SELECT left(prefix, length(prefix) - 64) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
u AS (SELECT left(prefix, CAST(64 * unnest(range(0, CAST(depth + 1 AS BIGINT))) AS BIGINT)) AS prefix, (n_convs - 1) * words AS saved,
             CASE WHEN c.prefix IS NULL THEN 1 ELSE 0 END AS leaf FROM n LEFT JOIN c USING (prefix)),
s AS (SELECT prefix, CAST(sum(saved) AS BIGINT) AS saved_tokens, CAST(sum(leaf) AS BIGINT) AS n_leaves FROM u GROUP BY prefix),
e AS (SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS told
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) AS last FROM p) WHERE last = 1 GROUP BY prefix)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       coalesce(told, sha256('')) AS ends_sha256
FROM n LEFT JOIN n a ON n.depth > 0 AND a.prefix = left(n.prefix, length(n.prefix) - 64)
LEFT JOIN c ON c.prefix = n.prefix LEFT JOIN e ON e.prefix = n.prefix JOIN s ON s.prefix = n.prefix
"""


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT rid, doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w),
u AS MATERIALIZED (SELECT rid, len(s) AS n, unnest(s) AS h FROM s),
l AS MATERIALIZED (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.h = b.h AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT rid AS a, rid AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT r.a AS rid, min(o.doc_id) AS component_id FROM r JOIN s o ON o.rid = r.b GROUP BY r.a) c USING (rid)
"""


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.ball_kmeans(_table(spark, sf_dir, "embeddings"))


def kmeans_sql(k: int, rounds: int) -> str:
    """The plain algorithm, a pair of steps for each round."""
    steps = [
        f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, v, list_dot_product(v, v) AS vv FROM (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v FROM kept ORDER BY k LIMIT {k})"""
    ]
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (SELECT rid, min(CAST(vv - 2 * list_dot_product(kept.v, c.v) + list_dot_product(c.v, c.v) AS BIGINT) * 1000 + k) AS best
  FROM kept CROSS JOIN c{t} c GROUP BY rid)""")
        if t < rounds:
            steps.append(f"""
m{t} AS (SELECT k, list(mean ORDER BY j) AS v FROM (SELECT best % 1000 AS k, j, floor(sum(x) / count(*)) AS mean
  FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS j FROM a{t} JOIN kept USING (rid)) GROUP BY 1, 2) GROUP BY k),
c{t + 1} AS MATERIALIZED (SELECT c{t}.k, coalesce(m{t}.v, c{t}.v) AS v FROM c{t} LEFT JOIN m{t} USING (k))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, best // 1000 AS distance, CAST(sum(best // 1000) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(best // 1000) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN c{rounds} c ON k = best % 1000"""


OP13_SQL = kmeans_sql(40, 5)

QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_lm_score, op3_near_dedup, op4_token_files, op5_chat_format, op6_exact_dedup, op7_top_k,
        op8_toxicity, op9_html_text, op10_best_fit_packing, op11_prefix_trie, op12_ngram_join, op13_ball_kmeans,
    )
}
SQL = {
    "op1_mix_sources": OP1_SQL, "op5_chat_format": OP5_SQL, "op6_exact_dedup": OP6_SQL, "op7_top_k": OP7_SQL,
    "op11_prefix_trie": OP11_SQL, "op12_ngram_join": OP12_SQL, "op13_ball_kmeans": OP13_SQL,
}
