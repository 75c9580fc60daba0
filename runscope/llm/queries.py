"""One query for each operator, over whole tables with production parameters, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runscope.llm import decontaminate, embeddings, lexical, line_dedup, mixing, packing, quality, secrets, simhash, substrings, suffixes, url_filter, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def secret_label():
    """No table labels secrets. What a reviewer would go by stands in for labels: a value that is assigned to a name like `token`."""
    return ((F.col("named") == 1) & (F.col("assigned") == 1)).cast("double")


def learned():
    """The documents that models may learn from: four fifths."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest does without the features that the labels are taken from: it knows secrets by their own shape, dictionary, path and neighbours."""
    out = secrets.scan(table(spark, sf_dir, "documents"), secret_label(), learned(), secrets.CONTEXT)
    return out.select("doc_id", "word", "part", "candidate", F.round("score", 6).alias("score"), "is_secret")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), F.col("doc_id"), "long")
    return out.select(F.col("row").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda: F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out())
    out = quality.score(docs, model, F.col("doc_id"), "long").withColumnRenamed("row", "doc_id")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
#: No table has a block list: the pages of hosts that are named like spam are listed, some percent of all.
SPAM_HOST = r"(casino|spam|bets|pills|adult|ads)[.-]|[.-](casino|spam|bets|pills|adult|ads)"


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys are pages (host and path), all of the table's."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("url"))
    listed = pages.filter(host.rlike(SPAM_HOST)).select(F.concat(host, path).alias("key"))
    return url_filter.judge(pages, URL_RULES, listed, "page").select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.dedup(table(spark, sf_dir, "documents"), F.col("doc_id"), "long")
    return out.select(F.col("row").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup(table(spark, sf_dir, "documents"), F.col("doc_id"), "long")
    return out.select(F.col("row").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = line_dedup.drop_repeated(docs, line_dedup.LineStore.of(docs), F.col("doc_id"), "long")
    return out.select(F.col("row").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).documents


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_simhash": op4_simhash,
    "op5_url_filter": op5_url_filter,
    "op6_suffix_array": op6_suffix_array,
    "op7_substrings": op7_substrings,
    "op8_embeddings": op8_embeddings,
    "op9_line_dedup": op9_line_dedup,
    "op10_packing": op10_packing,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_mixing": op13_mixing,
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op5_url_filter": r"""
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(v, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
         FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host, '(casino|spam|bets|pills|adult|ads)[.-]|[.-](casino|spam|bets|pills|adult|ads)') THEN 'block' ELSE 'allow' END) AS verdict FROM best
""",
    "op9_line_dedup": """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.doc_id, line, p, r.key IS NOT NULL AND first_doc < k.doc_id AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""",
    "op11_lexical_search": rf"""
WITH dt AS (SELECT doc_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
it AS (SELECT item_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM it GROUP BY item_id, term),
d AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
p AS (SELECT doc_id, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
m AS (SELECT doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM d, s),
scores AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
""",
}
