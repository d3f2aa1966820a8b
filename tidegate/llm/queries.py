"""The operators bound to the test tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import chat, conversation_trie, embedding_dedup, language, mixing, near_dedup, neighbours, packing, quality, spelling, substring_dedup, url_filter, warc_packages
from tidegate.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# CRC-32 in DuckDB: the table of remainders, and the checksum of a text whose characters are below U+0100.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders)"""


def crc_of(text: str) -> str:
    octets = f"""flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)]
        ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END))"""
    step = "lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), {step}), 4294967295)"


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query("op1_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
    AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT x AS node, x AS other FROM links UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other),
least AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, coalesce(l.component, v.vec_id) AS component_id,
    v.vec_id = coalesce(l.component, v.vec_id) AS kept
FROM v LEFT JOIN counts c ON c.x = v.vec_id LEFT JOIN least l ON l.node = v.vec_id
""")
def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"), cosine=0.95)


@query("op2_language")
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    third = language.fold(3)
    return language.identify(docs, third != 1).select("doc_id", (third == 1).alias("held_out"), "lang_pred", "score")


@query("op3_quality")
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fifth = language.fold(5)
    scored = quality.score(docs, table(spark, folder, "labels"), fifth != 0)
    return scored.select(
        "doc_id", (fifth == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op4_substring_dedup", r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, w, len(w) AS n FROM split),
starts AS (SELECT doc_id, w, unnest(generate_series(1, n - 49)) AS p FROM words WHERE n >= 50),
spans AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM starts),
judged AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) < doc_id AS hit FROM spans),
each AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM words),
marked AS (SELECT e.doc_id, e.p, e.word, bool_or(coalesce(j.hit, false)) OVER (PARTITION BY e.doc_id ORDER BY e.p
    ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM each e LEFT JOIN judged j USING (doc_id, p)),
kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS body FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
""")
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeated(table(spark, folder, "documents")).drop("kept", "sha")


@query("op5_url_filter", """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
tails AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail
    FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM tails)
SELECT u.page_id, u.host, u.path, w.rule, coalesce(w.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN LATERAL (
    SELECT r.host || r.path AS rule, r.verdict FROM rules r
    WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    ORDER BY length(r.host || r.path) DESC LIMIT 1) w ON true
""")
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS r(host, path, verdict)")
    return url_filter.judge(table(spark, folder, "pages"), rules)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_packing")
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path(), added=True)


@query("op7_mixing", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('0:' || doc_id), 1, 15) AS BIGINT) AS turn FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST(place % 3 + 1 AS INT)] AS DOUBLE) AS weight,
    CAST(source_size AS DOUBLE) * 2.0 AS stop FROM src),
run AS (SELECT *, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS total,
    coalesce(sum(stop) OVER f, 0.0) AS gone, sum(weight) OVER () - coalesce(sum(weight) OVER f, 0.0) AS rest
    FROM w WINDOW f AS (ORDER BY stop / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT min_by((total - gone) / rest, struct_pack(a := stop / weight, b := place)) AS level FROM run
    WHERE weight * (total - gone) / rest < stop),
t AS (SELECT source, place, source_size, least(stop, coalesce(weight * level, stop)) AS target FROM w, lev),
seats AS (SELECT place, target / (2 * j - 1) AS quotient
    FROM (SELECT place, target, unnest(generate_series(1, CAST(target / 64 AS BIGINT) + 40)) AS j FROM t WHERE target > 0)),
seated AS (SELECT place, seat // 16384 AS shard, row_number() OVER (PARTITION BY place ORDER BY seat) - 1 AS block
    FROM (SELECT place, row_number() OVER (ORDER BY quotient DESC, place) - 1 AS seat FROM seats)
    WHERE seat < (SELECT CAST(round(sum(target) / 64) AS BIGINT) FROM t)),
won AS (SELECT place, count(*) AS blocks FROM seated GROUP BY place),
plan AS (SELECT t.*, least(coalesce(blocks, 0) * 64, 2 * source_size) AS words FROM t LEFT JOIN won USING (place)),
ring AS (SELECT d.doc_id, d.size, p.place, p.source_size, p.target, p.words, coalesce(sum(d.size) OVER (PARTITION BY p.place
    ORDER BY d.turn, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
summed AS (SELECT *, CAST(CASE WHEN source_size = 0 THEN 0 ELSE words // source_size * size
    + greatest(least(start + size, words % source_size) - start, 0) END AS BIGINT) AS taken FROM ring),
ends AS (SELECT *, start // 64 AS opening, (CASE WHEN words % source_size > start THEN words - words % source_size
    + least(start + size, words % source_size) ELSE words - words % source_size - source_size + start + size END - 1) // 64 AS closing
    FROM summed)
SELECT doc_id, size, source_size, target, taken, a.shard AS first_shard, b.shard AS last_shard FROM ends e
LEFT JOIN seated a ON taken > 0 AND a.place = e.place AND a.block = opening
LEFT JOIN seated b ON taken > 0 AND b.place = e.place AND b.block = closing
""")
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.by_shard(table(spark, folder, "documents")).drop("source")


@query("op8_near_dedup", r"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
raw AS (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS p FROM split WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, md5_number(array_to_string(w[p:p + 3], ' ')) AS h FROM raw),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b
    ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 80 * (p.n + q.n - c)),
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x AS node, x AS other FROM ways UNION SELECT r.node, b.y FROM reach r JOIN ways b ON b.x = r.other),
least AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id,
    d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.node = d.doc_id
""")
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)


@query("op9_warc_packages", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS last FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN last <> page_id THEN last END AS refers_to FROM f
""")
def op9_warc_packages(spark: SparkSession, folder: str) -> DataFrame:
    return warc_packages.archived(spark, table(spark, folder, "pages"))


@query("op10_neighbours")
def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op11_spelling_variants", f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, n, {crc_of("concat(doc_id, ':', run)")} AS h FROM counted, crc),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(generate_series(1, length(word))) AS p FROM v),
cuts AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM places),
pairs AS (SELECT a.word, b.word AS other, b.n AS times FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN v b ON b.word = a.rest
    UNION SELECT a.word, b.word, b.n FROM v a JOIN cuts b ON a.word = b.rest),
best AS (SELECT word, count(*) AS n_near, max(times) AS top, arg_min(other, (-times, other)) AS other FROM pairs GROUP BY word),
forms AS (SELECT v.word, CASE WHEN top >= 2 * v.n THEN other END AS form, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top >= 2 * v.n THEN top END AS form_n FROM v LEFT JOIN best USING (word)),
follow AS (SELECT word, coalesce(form, word) AS root FROM forms
    UNION SELECT k.word, f.form FROM follow k JOIN forms f ON f.word = k.root WHERE f.form IS NOT NULL),
ends AS (SELECT k.word, k.root FROM follow k JOIN forms f ON f.word = k.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
""")
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query("op12_conversation_trie", rf"""
WITH RECURSIVE {CRC_TABLE},
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place FROM conversations),
c AS (SELECT conv_id, {crc_of("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o), crc),
parts AS (SELECT c.conv_id, 0 AS part, o.place, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.place <= c.h
    UNION ALL SELECT c.conv_id, 1, o.place, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.place > c.h),
r AS (SELECT conv_id, role, text, row_number() OVER w AS depth, md5(CAST(list([role, text]) OVER w AS VARCHAR)) AS key FROM parts
    WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
n AS (SELECT c.conv_id, coalesce(max(depth), 0) AS n FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, 0 AS depth, '' AS key, CAST(NULL AS VARCHAR) AS above, 0 AS words FROM c
    UNION ALL SELECT conv_id, depth, key, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY depth), ''),
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM r),
g AS (SELECT key, min(m.conv_id) AS conv_id, min(depth) AS depth, min(above) AS above, count(*) AS n_convs, min(words) AS words,
    sha256(coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (depth = n.n), '')) AS ends_sha256
    FROM m JOIN n USING (conv_id) GROUP BY key),
kids AS (SELECT above AS key, count(*) AS n_children FROM g WHERE above IS NOT NULL GROUP BY above),
up AS (SELECT key AS node, key AS top FROM g UNION ALL SELECT up.node, g.above FROM up JOIN g ON g.key = up.top WHERE g.above IS NOT NULL),
sums AS (SELECT top AS key, count(*) FILTER (n_children IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
    FROM up JOIN g ON g.key = up.node LEFT JOIN kids ON kids.key = up.node GROUP BY top)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, g.ends_sha256
FROM g JOIN sums USING (key) LEFT JOIN kids USING (key) LEFT JOIN g p ON p.key = g.above
""")
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie(table(spark, folder, "conversations"))


PLANTED_CHAT = r"\### Assistant: </turn> ok"


@query("op13_chat_formatting", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
        (-7, 1, 'assistant', '\### Assistant: </turn> ok')) AS p(conv_id, turn, role, text)),
e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '</turn>', '\e'), '###', '\h') AS body,
    replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\e'), '###', '\h'), chr(10), '\n') AS head FROM c),
t AS (SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS masked,
    CAST(sum(length(head) + length(body) + 15) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(masked) AS loss_chars, sha256(masked) AS loss_sha256, formatted_chars FROM t
""")
def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    talks = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_CHAT).alias("text"),
    )
    return chat.digests(chat.format_conversations(talks.unionByName(planted)))
