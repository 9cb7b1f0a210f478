"""The registered queries of the training-text operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.llm import (
    alignment,
    ann,
    bpe,
    clustering,
    decontaminate,
    html_text,
    jaccard,
    langid,
    line_dedup,
    packing,
    quality,
    sharding,
    urls,
)
from traceframe.llm.common import crc_mod, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select("doc_id", *bpe.ROUND_TRIP)


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.mark(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        decontaminate.digest(F.col("item_ids")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Windows of items, found where a document has the same words in a row.
SQL["op10_decontaminate"] = rf"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(
        range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) AS key
    FROM b WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM windows), keys AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest(list_transform(
        range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS key
    FROM d, sizes WHERE len(w) >= n
), found AS (
    SELECT DISTINCT doc_id, pos, n, item_id FROM keys JOIN windows USING (n, key)
), hits AS (
    SELECT doc_id, count(*) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS place FROM found
    ) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.where(crc_mod("doc_id", 5) != 0))
    return quality.score(docs, model).select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = langid.fit(docs.where(crc_mod("doc_id", 3) != 1))
    return langid.predict(docs.select("doc_id", "text"), prototypes).select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


@query
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


#: The rules of the contract, and the listed sites: canonical URLs of their pages make the list.
RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)
SITES = r"(^|[.])(spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x)[.]"


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(urls.host_of(F.col("url")).rlike(SITES)).select("url")
    return urls.judge(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict", "listed")


# The exact answer needs no filter: a page is listed if its canonical URL is that of a listed page.
SQL["op2_url_filter"] = r"""
WITH p AS (
    SELECT page_id, trim(url) AS url,
        coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages
), c AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':(80|443)?$', ''), '^www[.]', '')
        || regexp_replace(path, '/+$', '')
        || coalesce('?' || nullif(array_to_string(list_sort(list_filter(
            string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1, 's'), '&'),
            lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&'), ''), '') AS key,
        contains(url, '://') AS whole
    FROM p
), listed AS (
    SELECT DISTINCT key FROM c
    WHERE whole AND regexp_matches(host, '(^|[.])(spam-farm|cheap-pills|casino-win|ads-track|free-bets|adult-x)[.]')
), rules(verdict, rhost, rpath) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
    SELECT c.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
        arg_max(rules.verdict, length(rhost || rpath)) AS verdict
    FROM c JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    GROUP BY c.page_id
)
SELECT c.page_id, c.host, c.path, fits.rule,
    coalesce(fits.verdict, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
    listed.key IS NOT NULL AS listed
FROM c LEFT JOIN fits USING (page_id) LEFT JOIN listed ON c.whole AND c.key = listed.key
"""


@query
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint")
    dealt = sharding.external_shuffle(docs, id_col="doc_id", size=size, shards=24)
    # Of the texts as they come out, so that whole records pass through both passes.
    return dealt.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard",
    )


@query
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


SQL["op9_jaccard"] = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS gram
    FROM d
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * same >= 80 * (x.n + y.n - same)
), reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM d
    UNION
    SELECT node, b FROM reach JOIN links ON a = seen
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) USING (doc_id)
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = F.aggregate("deleted", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select("doc_id", "text", count.alias("n_deleted"), "deleted")


@query
def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op12_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustering.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return clustering.with_inertia(found, centroids)


def _clustering_sql(k: int, rounds: int, seed: int) -> str:
    """Every round as a table of its centroids (cluster, list of components)."""
    squares = "list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    near = f"""
        SELECT vec_id, x, cluster, distance FROM (
            SELECT vec_id, x, cluster, {squares} AS distance, row FROM kept, centroids_{{n}}
        ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1"""
    tables = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, list_transform(v, lambda y: floor(1024 * y)::BIGINT) AS x, row_number() OVER () AS row
    FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
    WHERE len(v) = 64 AND list_count(v) = 64 AND len(list_filter(v, lambda y: NOT isfinite(y))) = 0
)""",
        f"""centroids_0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), x)) - 1 AS cluster, x AS c
    FROM kept ORDER BY cluster LIMIT {k}
)""",
    ]
    for n in range(rounds):
        tables.append(
            f"""near_{n} AS MATERIALIZED ({near.format(n=n)}
), sums_{n} AS (
    SELECT cluster, i, sum(x[i])::HUGEINT AS s, count(*) AS m FROM near_{n}, range(1, 65) r(i) GROUP BY ALL
), centroids_{n + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(moved, c) AS c FROM centroids_{n} LEFT JOIN (
        SELECT cluster, list(((s - (((s % m) + m) % m)) // m)::BIGINT ORDER BY i) AS moved FROM sums_{n} GROUP BY cluster
    ) USING (cluster)
)"""
        )
    tables.append(f"found AS MATERIALIZED ({near.format(n=rounds)}\n)")
    return (
        "WITH "
        + ", ".join(tables)
        + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
    sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN centroids_{rounds} USING (cluster)
"""
    )


SQL["op12_orchard"] = _clustering_sql(clustering.CENTROIDS, clustering.ROUNDS, clustering.SEED)


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.statistics(read(spark, sf_dir, "documents").select("doc_id", "text"))
