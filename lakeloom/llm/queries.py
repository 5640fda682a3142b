"""The ``opN_`` queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def put(fn):
        QUERIES[name or fn.__name__] = fn
        if oracle:
            ORACLES[name or fn.__name__] = oracle.strip()
        return fn
    return put


def _url_sql() -> str:
    from .url_filter import REJECT_AT, RULES, SOFT, STRICT

    def hit(term: str) -> str:
        return f"regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"

    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    weight = " + ".join([f"{REJECT_AT} * {hit(t)}::int" for t in STRICT] + [f"{hit(t)}::int" for t in SOFT])
    return f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {rules}),
cut AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, u, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT page_id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
  arg_max(r_verdict, length(r_host || r_path)) AS r_verdict
  FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules
  ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(r_verdict, CASE WHEN {weight} >= {REJECT_AT} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (page_id)"""


@query(_url_sql())
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("""
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= 5""")
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5, scale=256)


@query("""
WITH normal AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
ranked AS (SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w AS place FROM normal WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_groups
    return exact_groups(table(spark, sf_dir, "documents"))


@query("""
WITH sized AS (SELECT doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')), 0)::bigint AS size,
    md5(coalesce(doc_id::varchar, '')) AS o FROM documents),
sources AS (SELECT source, sum(size)::bigint AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::double AS weight,
    1.5::double * sum(source_size) OVER () AS wanted, 2.0::double * source_size AS most FROM sources),
-- common level: the one that spends exactly what is wanted, tried for each source as the first below its limit
levels AS (SELECT a.source, (any_value(a.wanted) - coalesce(sum(b.most) FILTER (b.most / b.weight < a.most / a.weight), 0.0)) /
    (sum(b.weight) FILTER (b.most / b.weight >= a.most / a.weight)) AS level, any_value(a.most / a.weight) AS cut
  FROM weighed a, weighed b GROUP BY a.source),
common AS (SELECT min_by(level, cut) AS level FROM levels WHERE level <= cut),
aimed AS (SELECT source, source_size, CASE WHEN (SELECT level FROM common) <= most / weight
    THEN (SELECT level FROM common) * weight ELSE most END AS target FROM weighed),
placed AS (SELECT s.doc_id, s.size, a.source_size, a.target, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.o, s.size
    ROWS UNBOUNDED PRECEDING) - s.size AS before,
    CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size) ELSE 0 END AS whole
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE size * (whole + (before + size / 2.0::double <= target - whole * source_size)::int) END::bigint AS taken
FROM placed""")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import folded, ordered
    return folded(*ordered(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


@query(name="training_order")
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order that ``op9_mixing`` stores, whose columns its SQL fixes: every taken copy with its position."""
    from .mixing import ordered
    return ordered(table(spark, sf_dir, "documents"))[1].select("doc_id", "source", "size", "copy", "position")


#: CRC-32 of the bytes in the list ``{bytes}``, by the 256 remainders of its polynomial (``crc_table.t``).
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), "
        "4294967295::BIGINT)")


@query(f"""
WITH {_CRC_TABLE},
own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, sha256(sha256(coalesce(role, '')) || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, turns, {_CRC.format(bytes="list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 9 AS h
  FROM own, crc_table),
whole AS (SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS path
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
nodes AS (SELECT path[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM whole) GROUP BY 1, 2),
born AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT a.*, coalesce(b.n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(a.path[depth].text) ELSE 0 END AS worth
  FROM nodes a LEFT JOIN born b ON a.path = b.path),
below AS (SELECT path[1:e] AS path, sum(worth) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT path, worth, n_children, unnest(range(0, depth + 1)) AS e FROM full_nodes) GROUP BY 1),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM whole GROUP BY path)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
  coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_nodes a JOIN below b ON a.path = b.path LEFT JOIN ends e ON a.path = e.path
  LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]""")
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("""
WITH heads AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS place,
  first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id) AS original FROM heads)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN original END AS refers_to FROM firsts""")
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import warc
    return warc(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _words_sql(table_name: str) -> str:
    return (f"SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            f"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM {table_name}")


_HEX = "strpos('0123456789ABCDEF', hex(word)[{at}]) - 1"


@query(f"""
WITH {_CRC_TABLE},
rows AS (SELECT row_number() OVER () AS doc_id, doc_id AS real_id, text FROM documents),
goals AS (SELECT item_id AS doc_id, text FROM benchmark),
words AS ({_words_sql("rows")}),
goal_words AS ({_words_sql("goals")}),
spelt AS (SELECT DISTINCT word FROM words UNION SELECT DISTINCT word FROM goal_words),
hashed AS (SELECT word, {_CRC.format(bytes="list_transform(range(1, 2 * strlen(word), 2), lambda i: 16 * ("
    + _HEX.format(at="i") + ") + " + _HEX.format(at="i + 1") + ")")} % 10000 AS bucket FROM spelt, crc_table),
s AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal_words JOIN hashed USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000.0::DOUBLE * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)::DOUBLE /
  ((s + 1)::DOUBLE * ((SELECT count(*) FROM goal_words) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
sums AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
weighed AS (SELECT real_id AS doc_id, coalesce(n, 0) AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
  list_reduce(list_prepend(0::BIGINT, list_transform(string_split(left(sha256('2024:' || coalesce(real_id::VARCHAR, '')), 8), ''),
    lambda x: (strpos('0123456789abcdef', x) - 1)::BIGINT)), lambda a, x: 16 * a + x) AS h
  FROM rows LEFT JOIN sums USING (doc_id)),
scored AS (SELECT *, weight + floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM weighed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100
  THEN place END AS rank FROM ranked""")
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit, predict
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 5) == 0
    net = fit(docs.where(~held).select("doc_id", "text", "lang"))
    return predict(docs.withColumn("held_out", held), net, columns=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held).select("doc_id", "text"), labels.where(~held).select("doc_id", "toxic"))
    return score(docs.withColumn("held_out", held), model, columns=("doc_id", "held_out"))


def bpe_ranks() -> dict[bytes, int]:
    import public_tokenizers

    from .bpe import load_ranks
    return load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode
    return encode(table(spark, sf_dir, "documents"), bpe_ranks(), decoded=True).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_output import token_output
    return token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op3_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_lm import fit, score
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 10) == 0
    model = fit(docs.where(~held))
    return score(docs.withColumn("held_out", held), model, columns=("doc_id", "held_out"))
