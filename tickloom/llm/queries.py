"""One query for each operator over its whole table, and SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm import audit, cascade, chat, decontaminate, forest, idcoder, linetree, overlap, packing, pivots, private, quality, repeats
from tickloom.llm.common import new_path, table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on this machine (every machine has the package)."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: A conversation that says what the template says.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, each a reply tree of one branch, formatted, and digests read back from the formatted text."""
    own = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    nodes = rows.withColumn("node", place).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    formatted = chat.format_conversations(nodes, tree="conv_id")
    return chat.read_back(formatted).select(F.col("tree").alias("conv_id"), "d.*", "formatted_chars")


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t')) AS body,
    length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ': ', '\c')) AS label FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + label + 2 + body + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' byte-level ids written to range-coded files in order of doc_id, and what the files say."""
    path = new_path(spark, "token-ids")
    idcoder.write_ids(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return idcoder.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are kept, with what the classifier and the sites say; the host is the source, the path its language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(quality.with_labels(docs, labels))
    judged = quality.judge(docs, model, carry_text=False)
    return judged.where("verdict.keep").select("doc_id", "host", "path", "verdict.p_quality", "verdict.p_toxic", "verdict.quality", "verdict.toxic", "verdict.site_n")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    return overlap.near_groups(table(spark, sf_dir, "documents"), size=3, percent=90)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector among all."""
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and packed into sequences of 2,048 ids."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of templates that ten texts or more have, but for the first document that has one."""
    out = linetree.drop_templates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 50-word sequences that a document with a smaller id has too."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return cascade.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = """
WITH r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM a),
c AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
n AS (SELECT row_number() OVER () AS row, * FROM c),
m AS (SELECT n.*, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY row ORDER BY length(rhost || rpath) DESC) AS k
  FROM n LEFT JOIN r ON (host = rhost OR suffix(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: what the patterns find, and with it what the skip-chain model adds."""
    return private.find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(private.told("base"), 256).alias("base_sha256"), private.told("spans").alias("spans")
    )


def op12_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in eight clusters after ten rounds in integers."""
    return pivots.cluster(table(spark, sf_dir, "embeddings"))


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    distance = "list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS c, v AS m FROM v
  QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT r, vec_id, v, c, {distance} AS d FROM v, m{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS t(i) GROUP BY c, i),
n{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{i} GROUP BY c),
m{i + 1} AS MATERIALIZED (SELECT c, coalesce(n{i}.m, m{i}.m) AS m FROM m{i} LEFT JOIN n{i} USING (c))"""
            )
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN m{rounds} USING (c)"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, in all 120 orders, for each language."""
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part,
  (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
  + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
  + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
  + (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask, good, toxic
  FROM w LEFT JOIN l USING (doc_id)),
n AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, mask),
o AS (SELECT '' AS o UNION ALL SELECT o || x FROM o, unnest(['A', 'B', 'C', 'D', 'E']) AS t(x) WHERE length(o) < 5 AND instr(o, x) = 0),
s AS (SELECT o AS filter_order, k AS step, CAST(1 << (ascii(o[k]) - 65) AS BIGINT) AS bit,
  coalesce(list_sum(list_transform(string_split(o[1:k - 1], ''), lambda x: CASE WHEN x = '' THEN 0 ELSE 1 << (ascii(x) - 65) END)), 0)::BIGINT AS gone
  FROM o, range(1, 6) AS t(k) WHERE length(o) = 5),
r AS (SELECT part, filter_order, step, bit,
  sum(n) FILTER (mask & (gone | bit) = 0) AS kept, sum(n) FILTER (mask & gone = 0 AND mask & bit > 0) AS removed,
  sum(n) FILTER (mask & gone > 0 AND mask & bit > 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
  sum(good) FILTER (mask & gone = 0 AND mask & bit > 0) AS good_lost, sum(toxic) FILTER (mask & gone = 0 AND mask & bit > 0) AS toxic_lost
  FROM n, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

_ALL = (
    op1_chat_formatting, op2_token_ids, op3_quality_classifier, op4_ngram_jaccard, op5_nearest_neighbours, op6_decontamination, op7_packing, op8_line_dedup, op9_substring_dedup, op10_url_filters,
    op11_personal_data, op12_pivot_clusters, op13_filter_audit,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE = {"op1_chat_formatting": OP1_SQL, "op10_url_filters": OP10_SQL, "op12_pivot_clusters": _op12_sql(), "op13_filter_audit": OP13_SQL}
