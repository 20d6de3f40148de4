"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm import secrets
from loomframe.llm.cells import finite
from loomframe.llm.decontamination import contamination
from loomframe.llm.fill_middle import fill_in_middle
from loomframe.llm.html_text import extract
from loomframe.llm.inner_products import top_inner_products
from loomframe.llm.lsh_forest import near_duplicates
from loomframe.llm.mixing import mix
from loomframe.llm.quality import fit, held_out, score_quality
from loomframe.llm.rp_forest import nearest
from loomframe.llm.segmentation import encode_texts
from loomframe.llm.suffix_dedup import repeated_spans
from loomframe.llm.url_filter import Rule, filter_urls
from loomframe.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a session and the folder of the tables under its own name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query()
def op1_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query()
def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(docs, labels.where("not held_out"))
    scored = score_quality(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query(
    r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE
            WHEN len(w) < 3 THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '')
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        END AS shingles
        FROM split
    ), single AS (
        SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
    ), links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION
        SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
    )
    SELECT doc_id, len(any_value(shingles)) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
    FROM sets JOIN reach USING (doc_id) GROUP BY doc_id
    """
)
def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query(
    r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n
        FROM documents
    ), starts AS (
        SELECT r, b, unnest(range(1, n - 198)) AS p FROM texts WHERE n >= 200
    ), windows AS (
        SELECT r, p, hash(b[p:p + 199]) AS h FROM starts
    ), twice AS (
        SELECT h FROM windows GROUP BY h HAVING count(*) > 1
    ), gone AS (
        SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 200, true) AS fresh
        FROM windows JOIN twice USING (h)
    ), numbered AS (
        SELECT r, p, sum(fresh::INTEGER) OVER (PARTITION BY r ORDER BY p) AS run FROM gone
    ), runs AS (
        SELECT r, min(p) AS lo, max(p) + 199 AS hi FROM numbered GROUP BY r, run
    ), pieces AS (
        SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS before FROM runs
    ), cut AS (
        SELECT r, sum(hi - lo + 1) AS removed, count(*) AS spans, max(hi) AS last,
            string_agg(CASE WHEN lo > before + 1 THEN hex(b[before + 1:lo - 1]) ELSE '' END, '' ORDER BY lo) AS head
        FROM pieces JOIN texts USING (r) GROUP BY r
    )
    SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
        sha256(CASE WHEN removed IS NULL THEN b
            ELSE unhex(head || CASE WHEN last < n THEN hex(b[last + 1:n]) ELSE '' END) END) AS kept_sha256
    FROM texts LEFT JOIN cut USING (r)
    """
)
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


@query()
def op5_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies", "content")


#: The rules of sites.
SITES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


@query(
    """
    WITH parts AS (
        SELECT page_id,
            CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
        FROM pages
    ), split AS (
        SELECT page_id,
            translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parts
    ), ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule
        FROM split
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block'
        WHEN regexp_matches(host || path, '(^|[./-])(spam-farm\\.|(casino|viagra|porn|xxx|warez)[./-])') THEN 'block'
        ELSE 'allow'
    END AS verdict
    FROM ruled
    """
)
def op6_url_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), SITES)


@query()
def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = secrets.fit(secrets.labelled_findings(spark))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, forest).select("doc_id", F.posexplode_outer("findings").alias("place", "found"))
    return found.where("place is not null").select("doc_id", "place", F.col("found.text").alias("candidate"), "found.score", "found.secret")


@query()
def op8_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


#: The model of pieces; a parameter of the operator, read on the driver.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query()
def op9_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(docs, PIECES, n=3, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "score",
        F.col("nbest.score").alias("nbest_scores"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("restored"),
    )


@query(
    """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
            list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
    FROM scored
    QUALIFY rank <= 10
    """
)
def op10_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(1024 * x.cast("double")).cast("long"))
    vectors = vectors.select("vec_id", whole.alias("vector"))
    return top_inner_products(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query(
    """
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
        FROM documents
    ), cut AS (
        SELECT *, ('0x' || d[1:8])::UBIGINT % (n + 1) AS a, ('0x' || d[9:16])::UBIGINT % (n + 1) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || d[17:24])::UBIGINT % 100 >= 90 THEN 'plain'
                WHEN ('0x' || d[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn
    ), parts AS (
        SELECT *, least(a, b)::BIGINT AS lo, greatest(a, b)::BIGINT AS hi FROM cut
    ), made AS (
        SELECT *, substr(t, 1, lo) AS p, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS s FROM parts
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM made
    """
)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle(docs, restored=True)
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query(
    r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), item_windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
            lambda i: array_to_string(w[i:i + 9], ' '))) AS words
        FROM items WHERE len(w) > 0
    ), sizes AS (
        SELECT DISTINCT size FROM item_windows
    ), doc_windows AS (
        SELECT r, size, unnest(range(1, len(w) - size + 2)) AS p, unnest(list_transform(range(1, len(w) - size + 2),
            lambda i: array_to_string(w[i:i + size - 1], ' '))) AS words
        FROM docs, sizes WHERE len(w) >= size
    ), hits AS (
        SELECT r, p, size, item_id FROM doc_windows JOIN item_windows USING (size, words)
    ), hit_words AS (
        SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + size)) AS word FROM hits) GROUP BY r
    ), hit_items AS (
        SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM hits GROUP BY r
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
    """
)
def op12_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return whitened(vectors, k=4)
