"""Registered queries of the corpus operators, and their SQL twins where SQL can express them.

Each query applies its operator with production parameters to the whole table and derives the
result columns from the operator's output. The SQL states rules and values by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrid.llm import decontam, hardneg, langid, licenses, merkle, mixing, quality, shards, simhash, suffixes, topk, toxicity, warc
from leadgrid.session import fresh_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), with_text=False).drop("kept")


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


def op4_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), root)
    return warc.read_archive(spark, root, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.shard_documents(table(spark, folder, "documents"), [1.0] * 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", relabelled)
    return hardneg.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.merkle_manifest(table(spark, folder, "documents"), claimed=merkle.without_line_breaks()).drop("steps")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_suffix_dedup, op3_decontaminate, op4_exact_top_k, op5_quality,
                            op6_simhash, op7_warc, op8_mix_sources, op9_rendezvous_shards, op10_language,
                            op11_toxicity, op12_hard_negatives, op13_merkle_manifest)}

_FOLD = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Templates as folded words with the number of distinct words that must be common (0.8 of them).
OP1 = f"""
WITH templates(label, words, need) AS (VALUES
    ('mit', ['permission','is','hereby','granted','free','of','charge','to','any','person','obtaining','a','copy',
             'this','software'], 12),
    ('apache-2', ['licensed','under','the','apache','license','version','2','0'], 7),
    ('cc-by-nc', ['licensed','under','cc','by','nc','4','0'], 6),
    ('cc-by-nc', ['creative','commons','attribution','noncommercial','license'], 4),
    ('gpl-3', ['licensed','under','the','gnu','general','public','license','version','3'], 8),
    ('bsd', ['redistribution','and','use','in','source','binary','forms','with','or','without','modification','are',
             'permitted'], 11)),
phrases(label, words) AS (VALUES ('mit', ['under','the','mit','license']),
    ('apache-2', ['apache','license','version','2']), ('cc-by-nc', ['cc','by','nc'])),
texts AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format('text')} AS w, text FROM documents),
places AS (SELECT rid, label, p - 1 AS start FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM texts), phrases
    WHERE w[p] = words[1] AND list_slice(w, p, p + len(words) - 1) = words),
base AS (SELECT rid, count(*) AS n, min(start) AS lo, max(start) AS hi, list(DISTINCT label) AS labels
    FROM places GROUP BY rid),
runs AS (SELECT rid, true AS in_line, {_WORDS.format('line')} AS w FROM (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line
    FROM texts) UNION ALL SELECT rid, false, w FROM texts WHERE contains(text, chr(10))),
blocks AS (SELECT rid, in_line, w FROM runs WHERE len(w) BETWEEN 1 AND 32
    UNION ALL SELECT rid, in_line, list_slice(w, cut + 1, cut + 32) FROM
        (SELECT rid, in_line, w, unnest(range(0, len(w) - 16, 16)) AS cut FROM runs WHERE len(w) > 32)),
met AS (SELECT rid, in_line, row_number() OVER () AS b, w FROM blocks),
common AS (SELECT rid, in_line, b, label, len(words) AS size, need, len(list_intersect(list_distinct(w), words)) AS n
    FROM met, templates),
found AS (SELECT rid, list(DISTINCT label) AS labels, max(n * 1.0::DOUBLE / size) AS score, count(DISTINCT b) FILTER (in_line) AS n
    FROM common WHERE n >= need GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word,
    hi::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',')
        AS labels,
    CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(found.score, 0.0) END::DOUBLE AS score,
    coalesce(found.n, 0)::BIGINT AS n_blocks
FROM texts LEFT JOIN base USING (rid) LEFT JOIN found USING (rid)"""

OP3 = f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format('text')} AS w FROM documents),
items AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, list_slice(w, p, p + 9) AS win FROM
    (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
grams AS (SELECT rid, p, n, list_slice(w, p, p + n - 1) AS win FROM
    (SELECT rid, w, unnest(range(1, len(w) + 1)) AS p FROM texts), sizes WHERE p + n - 1 <= len(w)),
hits AS (SELECT rid, p, n, item_id FROM grams JOIN windows USING (win)),
words AS (SELECT rid, count(DISTINCT p + k) AS n FROM (SELECT rid, p, unnest(range(0, n)) AS k FROM hits) GROUP BY rid),
names AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM
    (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(names.n, 0)::BIGINT AS n_items,
    sha256(coalesce(names.list, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM texts LEFT JOIN words USING (rid) LEFT JOIN names USING (rid)"""

OP4 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM
    (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""

# SHA-1 as hexadecimal digits, five of which make four base-32 digits.
OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
best AS (SELECT body, max(page_id) AS top FROM p GROUP BY body),
hashed AS (SELECT page_id, top, strlen(body) AS n, sha1(body) AS hex FROM p JOIN best USING (body))
SELECT page_id, n::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '')
        AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to FROM hashed"""

_UNIT = "(('0x' || substr(md5({0}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n FROM d GROUP BY source),
weighted AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM s),
level AS (SELECT *, sum(n) OVER () AS total,
    coalesce(sum(3 * n) OVER (ORDER BY 3 * n / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(weight) OVER (ORDER BY 3 * n / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM weighted),
capped AS (SELECT *, 3 * n * rest <= (total - spent) * weight AS is_capped FROM level),
targets AS (SELECT source, n, CASE WHEN is_capped THEN 3 * n ELSE
    (total - sum(CASE WHEN is_capped THEN 3 * n ELSE 0 END) OVER ()) * weight
        / sum(CASE WHEN is_capped THEN 0 ELSE weight END) OVER () END AS target FROM capped),
r AS (SELECT d.*, n, target, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole,
    CASE WHEN n > 0 THEN target / n - floor(target / n) ELSE 0 END AS p, {_UNIT.format("coalesce(doc_id::VARCHAR, '')")} AS u
    FROM d JOIN targets ON d.source IS NOT DISTINCT FROM targets.source),
q AS (SELECT *, CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS q, target - whole * n AS wanted FROM r),
one AS (SELECT *, p > 0 AND sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) <= wanted
    AS first_taken FROM q),
rounds(r, rid, doc_id, source, size, n, target, whole, p, q, taken, gap, moved) AS (
    SELECT 0, row_number() OVER (), doc_id, source, size, n, target, whole, p, q, first_taken,
        wanted - sum(CASE WHEN first_taken THEN size ELSE 0 END) OVER (PARTITION BY source), true FROM one
    UNION ALL SELECT r + 1, rid, doc_id, source, size, n, target, whole, p, q, taken OR now,
        gap - sum(CASE WHEN now THEN size ELSE 0 END) OVER (PARTITION BY source), bool_or(now) OVER () FROM
        (SELECT *, fits AND sum(CASE WHEN fits THEN size ELSE 0 END)
            OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) <= gap AS now FROM
            (SELECT *, NOT taken AND p > 0 AND size <= gap AS fits FROM rounds WHERE moved)))
SELECT doc_id, size, n::BIGINT AS source_size, target, ((whole + CASE WHEN taken THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rounds WHERE r = (SELECT max(r) FROM rounds)"""

# CRC-32 bit by bit over the bytes of the text; the polynomial is the fixed value 0xEDB88320.
OP9 = f"""
WITH RECURSIVE poly(b, step, c) AS (SELECT b, 0, b::BIGINT FROM range(256) t(b) UNION ALL
    SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM poly WHERE step < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM poly WHERE step = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, '') AS key
    FROM documents),
sums AS (SELECT rid, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(body), '..'),
    lambda x: ('0x' || x)::BIGINT)),
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]))) AS text_crc32 FROM d, crc),
scores AS (SELECT rid, i, -1.0 / ln({_UNIT.format("key || ':' || i::VARCHAR")}) AS score FROM d, range(17) t(i)),
shard AS (SELECT rid, arg_max(i, score) FILTER (i < 16) AS shard, arg_max(i, score) AS grown FROM scores GROUP BY rid)
SELECT doc_id, strlen(body)::BIGINT + 1 AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id, text_crc32) - 1 AS slot,
    grown::INTEGER AS grown_shard
FROM d JOIN sums USING (rid) JOIN shard USING (rid)"""

OP12 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
positives AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
    QUALIFY place <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
    row_number() OVER (PARTITION BY p.rid, p.place ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.rid = p.rid AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5"""

def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


# CRC-32 of the decimal id, bit by bit as above; nodes by tree (a source, or all of them), level and place.
OP13 = f"""
WITH RECURSIVE poly(b, step, c) AS (SELECT b, 0, b::BIGINT FROM range(256) t(b) UNION ALL
    SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM poly WHERE step < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM poly WHERE step = 8),
checked AS (SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
    regexp_extract_all(hex(doc_id::VARCHAR), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]))) AS crc FROM documents, crc),
d AS (SELECT *, {_leaf("text")} AS leaf,
    CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS claimed FROM checked),
leaves AS (SELECT *, {_leaf("claimed")} AS claim,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
tree(source, level, pos, n, digest) AS (SELECT source, 0, pos, n, leaf FROM leaves UNION ALL
    SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tree WHERE n > 1
    GROUP BY source, level, pos // 3, n),
subroots AS (SELECT source, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM tree WHERE n = 1),
top(level, pos, n, digest) AS (SELECT 0, pos, n, digest FROM subroots UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1
    GROUP BY level, pos // 3, n),
sides AS (SELECT a.source, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi FROM tree a JOIN tree b
    ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
top_sides AS (SELECT a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi FROM top a JOIN top b
    ON a.level = b.level AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
numbered AS (SELECT leaves.*, row_number() OVER () AS rid, subroots.digest AS subroot, subroots.pos AS place FROM leaves
    JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source),
steps AS (SELECT rid, s.level AS level, lo, hi FROM numbered n JOIN sides s ON n.source IS NOT DISTINCT FROM s.source
    AND s.pos = n.pos // (3 ** s.level)::BIGINT
    UNION ALL SELECT rid, 1000 + s.level, lo, hi FROM numbered n JOIN top_sides s ON s.pos = n.place // (3 ** s.level)::BIGINT),
paths AS (SELECT rid, list({{'lo': lo, 'hi': hi}} ORDER BY level) AS path FROM steps GROUP BY rid),
fold(rid, step, h) AS (SELECT rid, 0, claim FROM numbered UNION ALL
    SELECT fold.rid, step + 1, sha256(path[step + 1].lo || h || path[step + 1].hi) FROM fold JOIN paths USING (rid) WHERE step < len(path)),
ends AS (SELECT rid, arg_max(h, step) AS folded_root FROM fold GROUP BY rid)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_reduce(list_concat([''], list_transform(path, lambda s: s.lo || s.hi)),
    lambda a, b: a || b), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM numbered JOIN ends USING (rid) LEFT JOIN paths USING (rid), (SELECT digest AS root FROM top WHERE n = 1)"""

ORACLES: dict[str, str] = {"op1_license_scan": OP1, "op3_decontaminate": OP3, "op4_exact_top_k": OP4, "op7_warc": OP7,
                           "op8_mix_sources": OP8, "op9_rendezvous_shards": OP9, "op12_hard_negatives": OP12, "op13_merkle_manifest": OP13}
