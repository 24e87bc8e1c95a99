"""The operators as registered queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import chunk_dedup, decontamination, fill_in_middle, html_text, language_id, license_scan, mixing, pii, quality, simhash, token_files
from courtside.llm import top_k as top_k_search
from courtside.llm import whitening
from courtside.llm.common import read

# The vocabulary the queries encode with; the operator takes any file's path.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(read(spark, folder, "documents"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op4_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_dedup.repeated_passages(read(spark, folder, "documents"))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(read(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judged(read(spark, folder, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{c}" for c in counts])


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_output(read(spark, folder, "documents"), TOKENIZER)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(read(spark, folder, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(read(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))


def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k_search.top_k(read(spark, folder, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(read(spark, folder, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_simhash, op3_decontamination, op4_chunk_dedup, op5_pii, op6_quality, op7_token_files, op8_language_id, op9_mixing, op10_html_text,
        op11_whitening, op12_top_k, op13_fill_in_middle,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLAIN_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_WORDS} AS ws FROM documents),
items AS (SELECT item_id, {_PLAIN_WORDS} AS ws, least(13, len({_PLAIN_WORDS})) AS size FROM benchmark),
starts AS (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM items WHERE size > 0),
grams AS (SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS gram FROM starts),
places AS (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM grams)),
hits AS (SELECT rid, i, p.size, item_id FROM places p JOIN grams g
  ON p.size = g.size AND array_to_string(ws[i:i + p.size - 1], ' ') = gram),
words AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS w FROM hits) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_SPACE_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3.0 * source_size AS cap,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM s),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(CAST(sum(cap) OVER before AS DOUBLE), 0))
    / CAST(sum(weight) OVER after AS DOUBLE) AS level FROM w
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
goals AS (SELECT source, source_size, CAST(CASE WHEN level * weight >= cap THEN cap ELSE
    (SELECT max(level) FROM levels WHERE level * weight < cap) * weight END AS DOUBLE) AS target FROM levels),
placed AS (SELECT d.*, coalesce(CAST(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start FROM d)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST({" + ".join(f"greatest(least(CAST(round(target) AS BIGINT) - ({e} * source_size + start), size), 0)" for e in range(3))} AS BIGINT) AS taken
FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source"""


def _quality_sql() -> str:
    """The counts, the references summed by language, and the nearest of them for each document."""
    listed = quality.vocabulary()
    spelled = lambda w: f"w IN ('{w}', '{w.capitalize()}')"
    gone = lambda pattern, text="rest": f"(length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"
    signs = r"[!\"''()+,./:;=?@\[\\\]^_`{}~-]+"
    common = ", ".join([f"CAST(len(list_filter(ws, lambda w: {spelled(w)})) AS DOUBLE)" for w in listed])
    anyone = ", ".join(f"'{w}', '{w.capitalize()}'" for w in listed)
    jsd = """SELECT rid, min(sqrt(greatest(x, 0))) AS far FROM (SELECT rid, lang,
    sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS x
    FROM (SELECT c.rid, r.lang, c.k, c.v / greatest(sum(c.v) OVER (PARTITION BY c.rid, r.lang), 1) AS p, r.share AS q
      FROM {0}_bins c JOIN {0}_refs r USING (k)) GROUP BY rid, lang) GROUP BY rid"""
    bins = lambda kind: f"{kind}_bins AS (SELECT rid, lang AS own, n_words, unnest(range(1, len({kind}) + 1)) AS k, unnest({kind}) AS v FROM m)"
    refs = lambda kind: f"""{kind}_refs AS (SELECT own AS lang, k, sum(v) / greatest(sum(sum(v)) OVER (PARTITION BY own), 1) AS share FROM {kind}_bins
  WHERE n_words >= {quality.MIN_COMMON_WORDS} AND own IN (SELECT lang FROM m WHERE n_words >= {quality.MIN_COMMON_WORDS} GROUP BY lang
    HAVING count(*) >= {quality.MIN_LANGUAGE_DOCS}) GROUP BY own, k)"""  # noqa: E731
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text, {_SPACE_WORDS} AS ws FROM documents),
r AS (SELECT *, regexp_replace(text, '[a-z\x20\x09-\x0D]+', '', 'g') AS rest, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars FROM t),
m AS (SELECT *, [length(text) - word_chars, word_chars - length(rest), {gone("[A-Z]+")}, {gone("[0-9]+")}, {gone("[#*$%&|<>]+")}, {gone(signs)},
    strlen(rest) - length(rest)] AS classes,
  list_concat([{common}], [CAST(len(list_filter(ws, lambda w: w NOT IN ({anyone}))) AS DOUBLE)]) AS common FROM r),
windows AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM t)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT rid, count(DISTINCT w) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS w FROM twice) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
{bins("classes")}, {bins("common")}, {refs("classes")}, {refs("common")},
class_far AS ({jsd.format("classes")}), common_far AS ({jsd.format("common")}),
counted AS (SELECT m.*, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_dup_lines, class_far.far AS far_1, common_far.far AS far_2
  FROM m LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN class_far USING (rid) LEFT JOIN common_far USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(classes[5] AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
    AND (length(text) < {quality.MIN_CLASS_CHARS} OR coalesce(far_1, 0) <= {quality.MAX_CLASS_DISTANCE})
    AND (n_words < {quality.MIN_COMMON_WORDS} OR coalesce(far_2, 0) <= {quality.MAX_COMMON_DISTANCE}) AS kept
FROM counted"""


OP12_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({top_k_search.SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {top_k_search.QUERY_EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= {top_k_search.K}"""

OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS ws FROM documents),
d AS (SELECT *, CAST(len(ws) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS hs FROM t),
c AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 50 THEN 'plain'
    WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(ws[1:a], '') AS pre, array_to_string(ws[a + 1:b], '') AS mid, array_to_string(ws[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p"""

ORACLES: dict[str, str] = {"op3_decontamination": OP3_SQL, "op6_quality": _quality_sql(), "op9_mixing": OP9_SQL, "op12_top_k": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
