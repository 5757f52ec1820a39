"""One query per text operator, over its whole table, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from demandkit.llm import alignment, centroids, decontaminate, html_extract, line_dedup, quality, segmentation, sharding, simhash, substring_dedup, token_files, toxicity, url_filters
from demandkit.plans.catalogue import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql.strip()
        return fn

    return add


_FEED_PATTERNS = r"""
    hosts AS (SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
                     split_part(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/', 2) AS top
              FROM pages),
    patterns AS (SELECT host AS pattern FROM hosts
                 UNION SELECT regexp_replace(host, '^[^.]*[.]', '') FROM hosts
                 UNION SELECT concat(host, '/', top, '/') FROM hosts),
    listed AS (SELECT pattern, substr(md5(pattern), 1, 1) AS c FROM patterns WHERE pattern <> '')"""


def _list_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated feed made from the hosts that occur: up to four changes of mind for each pattern."""
    url = F.col("url")
    path_top = F.split_part(F.regexp_extract("url", url_filters._PATH, 1), F.lit("/"), F.lit(2))
    hosts = table(spark, sf_dir, "pages").select(url_filters.url_host(url).alias("host"), path_top.alias("top")).distinct()
    made = F.array(
        F.col("host"), F.regexp_replace("host", "^[^.]*[.]", ""), F.concat("host", F.lit("/"), "top", F.lit("/"))
    )
    patterns = hosts.select(F.explode(made).alias("pattern")).where("pattern <> ''").distinct()
    marked = patterns.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(4))))
    code = F.md5(F.concat("pattern", F.col("n").cast("string")))
    days = F.conv(F.substring(code, 1, 5), 16, 10).cast("int") % 400
    named = F.element_at(F.array(*[F.lit(x) for x in ("block", "allow", "none", "block")]), F.conv(F.substring(code, 6, 1), 16, 10).cast("int") % 4 + 1)
    return marked.where(F.substring(F.md5("pattern"), 1, 1) < "8").select(
        F.when(F.substring(code, 7, 1) < "8", "harm").otherwise("spam").alias("list"),
        "pattern",
        F.date_add(F.lit("2024-01-01").cast("date"), days).alias("dated"),
        named.alias("verdict"),
    )


@register(
    "op1_url_filters",
    f"""
    WITH {_FEED_PATTERNS},
    coded AS (SELECT pattern, md5(concat(pattern, CAST(n AS VARCHAR))) AS code
              FROM listed CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n) WHERE c < '8'),
    feed AS (
      SELECT CASE WHEN substr(code, 7, 1) < '8' THEN 'harm' ELSE 'spam' END AS list, pattern,
             DATE '2024-01-01' + CAST(CAST('0x' || substr(code, 1, 5) AS INTEGER) % 400 AS INTEGER) AS dated,
             ['block', 'allow', 'none', 'block'][CAST('0x' || substr(code, 6, 1) AS INTEGER) % 4 + 1] AS verdict
      FROM coded),
    once AS (SELECT list, pattern, dated, max(verdict) AS verdict FROM feed GROUP BY ALL),
    spans AS (SELECT *, lead(dated) OVER (PARTITION BY list, pattern ORDER BY dated) AS ended FROM once),
    captures AS (
      SELECT page_id, url, DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 5) AS INTEGER) % 400 AS INTEGER) AS fetched,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
             lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))
               || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS whole
      FROM pages),
    met AS (
      SELECT page_id, s.*, row_number() OVER (
               PARTITION BY page_id ORDER BY length(pattern) DESC, s.verdict <> 'allow', list) AS place
      FROM captures p JOIN spans s ON p.fetched >= s.dated AND (s.ended IS NULL OR p.fetched < s.ended)
       AND s.verdict <> 'none' AND (p.host = s.pattern OR ends_with(p.host, '.' || s.pattern)
            OR (ends_with(s.pattern, '/') AND starts_with(p.whole, s.pattern))))
    SELECT p.page_id, p.url, strftime(p.fetched, '%Y-%m-%d') AS fetched, coalesce(m.verdict, 'none') AS verdict,
           m.list, m.pattern, strftime(m.dated, '%Y-%m-%d') AS valid_from
    FROM captures p LEFT JOIN (SELECT * FROM met WHERE place = 1) m USING (page_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures with fetch days derived from their ids, against the derived feed."""
    days = F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 5), 16, 10).cast("int") % 400
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), days)
    captures = table(spark, sf_dir, "pages").select("page_id", "url", fetched.alias("fetched"))
    made = url_filters.filter_urls(captures, _list_feed(spark, sf_dir))
    return made.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("fetched", "valid_from")})


@register("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@register(
    "op3_line_dedup",
    r"""
    WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM parts),
    keyed AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    hot AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40
            GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
    judged AS (SELECT keyed.*, hot.k IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN hot USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = line_dedup.dedup_lines(docs)
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register(
    "op5_benchmark_decontamination",
    r"""
    WITH split AS (
      SELECT 0 AS side, doc_id AS id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
      UNION ALL
      SELECT 1, item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') FROM benchmark),
    lengths AS (SELECT DISTINCT least(len(w), 5) AS n FROM split WHERE side = 1 AND len(w) > 0),
    shingles AS (
      SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
      FROM split, lengths WHERE len(w) >= n AND (side = 0 OR n = least(len(w), 5))),
    sizes AS (SELECT id, count(*) AS n_item FROM shingles WHERE side = 1 GROUP BY 1),
    pairs AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
              FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 0 AND i.side = 1 GROUP BY 1, 2)
    SELECT doc_id, item_id, n_shared, n_item, round(n_shared / n_item, 6) AS containment
    FROM pairs JOIN sizes ON id = item_id WHERE n_shared >= 0.8 * n_item - 1e-9
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_sentencepiece_sampling")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.sample_segmentations(table(spark, sf_dir, "documents"))


@register("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


@register("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    held = toxicity.held_out(F.col("doc_id"))
    return toxicity.score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"), "n_windows")


@register("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


@register("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@register("op11_token_files")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_ids(table(spark, sf_dir, "documents"))
    return token_files.read_ids(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = alignment.align_documents(table(spark, sf_dir, "documents"), digest=True)
    return made.withColumnRenamed("groups", "groups_sha256")


def _lloyd_sql(rounds: int = 5) -> str:
    """The rounds of op13 written out: components one by one, sums as whole numbers."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
    near{n} AS MATERIALIZED (
      SELECT vec_id, c, d FROM (
        SELECT v.vec_id, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d,
               row_number() OVER (PARTITION BY v.vec_id ORDER BY sum((v.x - m.x) * (v.x - m.x)), m.c) AS place
        FROM parts v JOIN means{n} m ON v.i = m.i GROUP BY v.vec_id, m.c) WHERE place = 1)""")
        if n < rounds:
            steps.append(f"""
    means{n + 1} AS MATERIALIZED (
      SELECT m.c, m.i, coalesce(s.x, m.x) AS x FROM means{n} m LEFT JOIN (
        SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
        FROM near{n} JOIN parts USING (vec_id) GROUP BY c, i) s ON m.c = s.c AND m.i = s.i)""")
    return f"""
    WITH kept AS (
      SELECT vec_id, embedding AS e FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT vec_id, i, CAST(floor(256 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS x FROM kept, (SELECT unnest(range(1, 65)) AS i)),
    firsts AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM kept QUALIFY c < 40),
    means0 AS MATERIALIZED (SELECT c, i, x FROM firsts JOIN parts USING (vec_id)),{",".join(steps)},
    codes AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM means{rounds} GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM near{rounds} JOIN codes USING (c)"""


@register("op13_centroid_clustering", _lloyd_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, final = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    found = centroids.checkpointed(found)
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0)))
    # forty rows each
    codes = final.select(F.col("cluster").alias("c"), F.sha2(F.array_join("components", ","), 256).alias("centroid_sha256"))
    sums = by_cluster.withColumn("inertia", whole).join(F.broadcast(codes), F.col("cluster") == F.col("c")).drop("c")
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
