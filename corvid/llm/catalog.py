"""The operators' queries over the driver tables, and SQL for those that SQL can express.

Each query applies its operator, with production parameters, to its whole table and
derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import (chat, codebook, fingerprint, licenses, lm, mixing, quality, repair, sentencepiece, simhash, substring,
                        tokenfile, toxicity)
from corvid.llm.common import table
from corvid.session import checkpoint_dir


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = chat.format_chat(turns.unionByName(control))
    back = chat.parse_chat(F.col("formatted"))
    turns_text = F.array_join(F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return out.select("conv_id", F.size(back).cast("bigint").alias("n_turns"),
                      F.sha2(turns_text, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"),
                      F.length("formatted").cast("bigint").alias("formatted_chars"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    tokenfile.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read_documents(spark, folder)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repair.repair(repair.damage(table(spark, sf_dir, "conversations")), present_col="present")
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = codebook.cluster(table(spark, sf_dir, "embeddings"))
    hashes = codebook.centroid_table(spark, got).select("cluster", "centroid_sha256")  # k rows
    return got.rows.join(F.broadcast(hashes), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_source_mix": op2_source_mix,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_fingerprints": op4_fingerprints,
    "op5_lm_score": op5_lm_score,
    "op6_quality_rules": op6_quality_rules,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_toxicity": op9_toxicity,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_token_files": op11_token_files,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_centroid_clusters": op13_centroid_clusters,
    "pipeline": pipeline,
}



def _clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The rounds of op13 unrolled: exact integer distances, floors of exact means."""
    near = ("SELECT vec_id, v, cid, d FROM (SELECT e.rid, e.vec_id, e.v, c.cid, list_sum(list_transform(list_zip(e.v, c.v), "
            "lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d, row_number() OVER (PARTITION BY e.rid ORDER BY d, c.cid) AS rn "
            "FROM e, c{0} c) WHERE rn = 1")
    parts = [
        "x AS (SELECT vec_id, embedding::DOUBLE[] AS f FROM embeddings)",
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(f, lambda y: floor(256 * y)::BIGINT) AS v FROM x "
        f"WHERE len(f) = {dim} AND len(list_filter(f, lambda y: y IS NOT NULL AND isfinite(y))) = {dim})",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS cid, v FROM e "
        f"ORDER BY cid LIMIT {k})",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(r)})")
        parts.append(
            f"m{r} AS (SELECT cid, i, sum(y)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT cid, unnest(v) AS y, "
            f"unnest(range({dim})) AS i FROM a{r}) GROUP BY cid, i)")
        parts.append(
            f"c{r + 1} AS MATERIALIZED (SELECT c.cid, coalesce(w.v, c.v) AS v FROM c{r} c LEFT JOIN (SELECT cid, "
            f"list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM m{r} GROUP BY cid) w USING (cid))")
    parts.append(f"z AS MATERIALIZED ({near.format(rounds)})")
    return ("WITH " + ",\n".join(parts) + "\nSELECT z.vec_id, z.cid::INTEGER AS cluster, z.d AS distance, "
            "(sum(z.d) OVER (PARTITION BY z.cid))::BIGINT AS cluster_inertia, (sum(z.d) OVER ())::BIGINT AS inertia, "
            f"sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM z JOIN c{rounds} c USING (cid)")


ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>|\|)', '\\l\1', 'g'),
                                  '\[(/?INST\])', '\\b\1', 'g')) AS n,
         length(replace(regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(/?s>|\|)', '\\l\1', 'g'),
                                  '\[(/?INST\])', '\\b\1', 'g'), chr(10), '\n')) AS rn
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(7 + rn + 1 + n + 8 + CASE WHEN role = 'assistant' THEN 4 ELSE 0 END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op2_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(coalesce(text, '')) AS chars,
         (('0x' || substr(md5('corvid-mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u FROM documents),
k AS (
  SELECT *, -ln(u) / ((CASE WHEN size >= 50 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)
    * (CASE WHEN chars / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)) AS key FROM d),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
s1 AS (
  SELECT *, 3 * source_size AS cap,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM s0),
s2 AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place,
    ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s1),
f AS (SELECT place, level FROM s2 WHERE level * weight < cap ORDER BY place LIMIT 1),
s4 AS (
  SELECT source, source_size, CASE WHEN f.place IS NULL OR s2.place < f.place THEN cap::DOUBLE
    ELSE f.level * weight END AS target FROM s2 LEFT JOIN f ON true),
s5 AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS epochs FROM s4),
r AS (
  SELECT k.doc_id, k.size, s5.source_size, s5.target, s5.epochs, s5.target - s5.epochs * s5.source_size AS rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
  FROM k JOIN s5 ON k.source IS NOT DISTINCT FROM s5.source)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN until - size / 2 <= rest AND rest > 0 THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r""",
    "op7_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM p),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS low FROM x) WHERE low < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g),
l AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
a AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS j FROM d),
k AS (SELECT doc_id, string_agg(v, ' ' ORDER BY j) AS kept FROM a ANTI JOIN c USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(l.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op12_conversation_repair": r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))),
      4294967295) % 20 AS kind FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
num AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid FROM pos),
t AS MATERIALIZED (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS c, solid = '' AS blank, solid <> '' AND seen > 1 AS dup,
    solid <> '' AND seen = 1 AND right(solid, 1) NOT IN ('.', '!', '?') AS cut,
    solid = '' OR seen > 1 AS gone FROM num),
per AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(dup) AS duplicate, count_if(cut) AS truncated FROM t GROUP BY conv_id),
bad AS (
  SELECT conv_id, count(*) AS illegal FROM (SELECT conv_id, c, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS p, i FROM t)
  WHERE i > 1 AND p || c NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
dp AS (
  -- From the last turn back: the least (cost, audit) where the rest must read (ua)*, a(ua)*, (ua)+ and s(ua)+.
  SELECT conv_id, n AS i, {'k': 0::BIGINT, 'a': ''} AS u, {'k': 3::BIGINT, 'a': 'I'} AS a, {'k': 6::BIGINT, 'a': 'II'} AS p,
    {'k': 1000000000000::BIGINT, 'a': ''} AS q FROM per
  UNION ALL
  SELECT conv_id, i - 1, least(nu, {'k': na.k + 3, 'a': 'I' || na.a}), least(na, {'k': nu.k + 3, 'a': 'I' || nu.a}),
    least(np, {'k': na.k + 3, 'a': 'I' || na.a}, {'k': nu.k + 6, 'a': 'II' || nu.a}), nq
  FROM (
    SELECT d.conv_id, d.i,
      least({'k': d.u.k + 4, 'a': 'D' || d.u.a}, {'k': d.a.k + x.stay + x.to_u, 'a': x.by_u || d.a.a}) AS nu,
      least({'k': d.a.k + 4, 'a': 'D' || d.a.a}, {'k': d.u.k + x.stay + x.to_a, 'a': x.by_a || d.u.a}) AS na,
      least({'k': d.p.k + 4, 'a': 'D' || d.p.a}, {'k': d.a.k + x.stay + x.to_u, 'a': x.by_u || d.a.a}) AS np,
      least({'k': d.q.k + 4, 'a': 'D' || d.q.a}, {'k': d.p.k + x.stay + x.to_s, 'a': 'K' || d.p.a}) AS nq
    FROM dp d JOIN (
      SELECT conv_id, i, (CASE WHEN gone THEN 1000000000000 WHEN cut THEN 3 ELSE 0 END)::BIGINT AS stay,
        CASE WHEN c = 'u' THEN 0 ELSE 3 END AS to_u, CASE WHEN c = 'u' THEN 'K' ELSE 'R' END AS by_u,
        CASE WHEN c = 'a' THEN 0 ELSE 3 END AS to_a, CASE WHEN c = 'a' THEN 'K' ELSE 'R' END AS by_a,
        CASE WHEN c = 's' THEN 0 ELSE 1000000000000 END AS to_s FROM t) x
      ON x.conv_id IS NOT DISTINCT FROM d.conv_id AND x.i = d.i)),
best AS MATERIALIZED (SELECT conv_id, least(u, q).k AS cost, least(u, q).a AS audit FROM dp WHERE i = 0),
step AS (
  SELECT conv_id, audit, g AS j, substr(audit, g, 1) AS e, length(replace(substr(audit, 1, g), 'I', '')) AS i,
    length(replace(substr(audit, g), 'D', '')) AS rest FROM best, unnest(range(1, length(audit) + 1)) AS z(g)),
lines AS (
  SELECT s.conv_id, s.j, CASE WHEN e = 'K' THEN t.role WHEN rest % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE t.text END AS line
  FROM step s LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i WHERE e <> 'D'),
made AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS whole FROM lines GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT v.conv_id, coalesce(per.gaps, 0)::BIGINT AS gaps, coalesce(per.blank, 0)::BIGINT AS blank,
  coalesce(per.duplicate, 0)::BIGINT AS duplicate, coalesce(per.truncated, 0)::BIGINT AS truncated,
  coalesce(bad.illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(made.whole, '')) AS repaired_sha256
FROM every v LEFT JOIN per ON per.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN bad ON bad.conv_id IS NOT DISTINCT FROM v.conv_id
  LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN made ON made.conv_id IS NOT DISTINCT FROM v.conv_id""",
    "op13_centroid_clusters": _clusters_sql(),
}
