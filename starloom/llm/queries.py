"""The operators as queries over the given tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, centroids, classifier, extract, licences, minhash, mixing, passages, personal, phrases, quality, urls, vectors
from starloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rules of the URL query: fixed values.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Names of junk hosts and the domains below which they turn up; the query's list blocks every name in every domain.
JUNK_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
JUNK_DOMAINS = ["example.com", "example.net", "example.org"]
LISTED_HOSTS = [f"{name}.{domain}" for name in JUNK_NAMES for domain in JUNK_DOMAINS]


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def quality_rules(spark: SparkSession, folder: str, documents: DataFrame) -> list[quality.Rule]:
    return quality.learn_rules(quality.labelled_statistics(documents, table(spark, folder, "labels")))


@query("op2_quality_rules")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.judge_quality(documents, quality_rules(spark, folder, documents))


_URL_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
listed(host) AS (VALUES {", ".join(f"('{h}')" for h in LISTED_HOSTS)}),
parts AS (SELECT row_number() OVER () AS n, page_id,
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
fits AS (SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY n),
spam AS (SELECT DISTINCT n FROM parts p JOIN listed l ON (p.host = l.host OR ends_with(p.host, '.' || l.host)) AND starts_with(p.path, '/'))
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict WHEN s.n IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN fits USING (n) LEFT JOIN spam s USING (n)
"""


@query("op3_url_filters", _URL_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    schema = "host string, path string, verdict string"
    rules = spark.createDataFrame(URL_RULES, schema)
    listed = spark.createDataFrame([(h, "/", "block") for h in LISTED_HOSTS], schema)
    return urls.judge_urls(table(spark, folder, "pages"), rules, listed)


_MIX_SQL = """
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':17'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
ranked AS (SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)] AS weight, source_size * 3 AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source)),
levels AS (SELECT *, (sum(source_size) OVER () - (sum(cap) OVER o - cap))::DOUBLE / (sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM ranked WINDOW o AS (ORDER BY cap / weight, source IS NULL, source)),
level AS (SELECT arg_min(level, struct_pack(r := cap / weight, n := source IS NULL, s := source)) AS level FROM levels WHERE weight * level <= cap),
plan AS (SELECT source AS t, source_size, least(cap::DOUBLE, coalesce(weight * (SELECT level FROM level), cap::DOUBLE)) AS target FROM ranked),
shares AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS share FROM plan),
rest AS (SELECT *, floor(share) AS whole, target - floor(share) * source_size AS rest, share - floor(share) AS chance FROM shares),
odds AS (SELECT *, CASE WHEN chance > 0 THEN (u / (1 - u)) * ((1 - chance) / chance) END AS odds FROM sizes JOIN rest ON source IS NOT DISTINCT FROM t),
ordered AS (SELECT *, odds / (1 + odds) AS ord FROM odds),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id NULLS FIRST, size) AS upto, sum(size) OVER (PARTITION BY source, ord, doc_id, size) AS own FROM ordered)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE (whole::BIGINT + CASE WHEN chance > 0 AND 2 * upto - own <= 2 * rest THEN 1 ELSE 0 END) * size END::BIGINT AS taken FROM summed
"""


@query("op4_mixing", _MIX_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def token_digests(documents: DataFrame) -> DataFrame:
    """Digests of the ids of whole texts and of what the ids decode to."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = bpe.decode(bpe.encode(documents, ranks, public_tokenizers.PATTERN), ranks)
    return rows.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_byte_bpe")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


@query("op7_minhash")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_personal_data")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = personal.with_spans(documents.select("doc_id", "text"), "text", personal.fitted(documents), only="doc_id")
    base = F.filter("found", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in personal.KINDS]
    return found.select("_row.doc_id", *counts, F.sha2(personal.spans_text(base), 256).alias("base_sha256"), personal.spans_text(F.col("found")).alias("spans"))


@query("op1_html_extraction")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract.main_text(pages, extract.fitted(pages))


@query("op10_embedding_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return passages.without_repeats(table(spark, folder, "documents"))


@query("op5_license_scans")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


_PHRASE_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY 1),
grams AS (SELECT lang, 1 AS size, unnest(w) AS phrase FROM lists
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM lists
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM lists),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q FROM c, (VALUES (1), (2)) v(k) WHERE k < size),
scores AS (SELECT cuts.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE size = 3) GROUP BY ALL),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_phrase_collocations", _PHRASE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def _rounds_sql(rounds: int) -> str:
    """The rounds as one chain of tables: a<r> holds the assignment before round r, c<r> the centroids."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT n, any_value(vec_id) AS vec_id, any_value(q) AS q, min(struct_pack(d := d, c := c)) AS best FROM (
  SELECT n, vec_id, q, c, list_sum(list_transform(range(1, 65), lambda i: (q[i] - m[i]) * (q[i] - m[i])))::BIGINT AS d FROM kept, c{r}) GROUP BY n)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(w, m) AS m FROM c{r} LEFT JOIN (SELECT c, list(floored ORDER BY i) AS w FROM (
  SELECT c, i, ((s - ((s % size) + size) % size) // size)::BIGINT AS floored FROM (
  SELECT best.c AS c, i, sum(q[i])::BIGINT AS s, count(*) AS size FROM a{r}, range(1, 65) t(i) GROUP BY ALL)) GROUP BY c) USING (c))""")
    return ",\n".join(steps)


_CENTROID_SQL = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT (row_number() OVER o - 1)::INTEGER AS c, q AS m FROM kept WHERE vec_id IS NOT NULL WINDOW o AS (ORDER BY sha256('3:' || vec_id), q) QUALIFY row_number() OVER o <= 8),
{_rounds_sql(10)}
SELECT vec_id, best.c AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a10 JOIN c10 ON c10.c = best.c
"""


@query("op12_centroid_clustering", _CENTROID_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clusters(table(spark, folder, "embeddings"))


@query("op13_quality_classifier")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return classifier.scores(documents, classifier.fitted(documents, table(spark, folder, "labels")))
