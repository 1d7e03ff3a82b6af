"""The registered queries of the text operators and, where SQL can say the same, DuckDB statements."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (collocations, decontaminate, exact_dedup, langid, line_dedup, mixing, odd_sketch, simhash, spelling, substring_dedup,
                          suffix_array, toxicity, url_filter)
from tidemark.session import table_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents"))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", mixing.size_column("text").alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_dedup(_table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.suffix_array_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def _remainder(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    profiles = langid.learn_profiles(docs.where(_remainder(4) != 2).select("doc_id", "text", "lang"))
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs.select("doc_id", "text", held_out), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, folder, "labels").where(_remainder(3) != 1))
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs.select("doc_id", "text", held_out), model).select("doc_id", "held_out", "score", "predicted")


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op11_odd_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketch.odd_sketch_dedup(_table(spark, folder, "documents"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_source_mixing, op3_simhash, op4_url_filter, op5_suffix_array, op6_substring_dedup, op7_language_id,
                                   op8_toxicity, op9_line_dedup, op10_decontamination, op11_odd_sketch, op12_collocations, op13_spelling_variants)}

_SPACES = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = url_filter.UPPER, url_filter.LOWER

SQL = {
    "op1_exact_dedup": rf"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}+', ' ', 'g') AS plain FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(plain) AS text_sha256
FROM t WINDOW w AS (PARTITION BY plain)""",
    "op2_source_mixing": rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [3, 1, 2][rank % 3 + 1]::BIGINT AS weight FROM r),
b AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
        coalesce(sum(source_size) OVER o, 0) AS size_before, coalesce(sum(weight) OVER o, 0) AS weight_before
      FROM w WINDOW o AS (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (150 * total - 200 * size_before)::DOUBLE / (100 * (weights - weight_before))::DOUBLE AS level FROM b),
p AS (SELECT source, source_size,
        least((2 * source_size)::DOUBLE, weight * max(CASE WHEN 2 * source_size >= weight * level THEN level END) OVER ()) AS target FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM p)
SELECT doc_id, size, source_size, target, size * (floor(rate) + CASE
    WHEN ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source""",
    # the pages of the test tables hold no redirect and no canonical link, so a page's own rule decides alone
    "op4_url_filter": rf"""
WITH p AS (SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r(verdict, rule_host, rule_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
j AS (SELECT page_id, host, path, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id, host, path
        ORDER BY length(rule_host || rule_path) DESC NULLS LAST, verdict) AS rank
      FROM p LEFT JOIN r ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM j WHERE rank = 1""",
    "op6_substring_dedup": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos, len(words) AS n FROM d),
s AS (SELECT *, CASE WHEN pos <= n - 49 THEN string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) END AS fifty FROM w),
f AS (SELECT *, CASE WHEN fifty IS NOT NULL THEN min(doc_id) OVER (PARTITION BY fifty) END AS first FROM s),
g AS (SELECT *, max(CASE WHEN doc_id > first THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op9_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^{_SPACES}+|{_SPACES}+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, f.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op12_collocations": rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
s AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM w),
g AS (SELECT lang, words[pos:pos + size - 1] AS phrase, count(*) AS c FROM s, range(1, 6) AS sizes(size) WHERE pos + size - 1 <= len(words) GROUP BY ALL),
t AS (SELECT lang, sum(c)::BIGINT AS n FROM g WHERE len(phrase) = 1 GROUP BY lang),
f AS (SELECT * FROM g WHERE c >= 100),
h AS (SELECT lang, c, phrase[first:first + size - 1] AS part FROM f, range(1, 5) AS firsts(first), range(1, 5) AS sizes(size)
      WHERE size < len(phrase) AND first + size - 1 <= len(phrase)),
held AS (SELECT DISTINCT h.lang, part FROM h JOIN f ON f.lang = h.lang AND f.phrase = h.part WHERE h.c >= f.c),
k AS (SELECT lang, phrase, c AS a, unnest(range(1, len(phrase))) AS cut FROM f WHERE len(phrase) >= 2),
v AS (SELECT k.lang, k.phrase, a, cut, l.c AS l, r.c AS r, n, ((1000::HUGEINT * a * n) // (l.c::HUGEINT * r.c))::BIGINT AS score
      FROM k JOIN t USING (lang) JOIN f l ON l.lang = k.lang AND l.phrase = k.phrase[1:cut] JOIN f r ON r.lang = k.lang AND r.phrase = k.phrase[cut + 1:]
      WHERE NOT EXISTS (SELECT 1 FROM held WHERE held.lang = k.lang AND held.part = k.phrase)),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS best FROM v) WHERE best = 1),
o AS (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM m),
q AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o)
SELECT * FROM q WHERE rank <= 2000""",
}
