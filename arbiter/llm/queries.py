"""Queries of the training-data operators: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm import (alignment, decontamination, embedding_dedup, language_id, license_scan, merkle, mixing,
                         packing, simhash, spelling, substring_dedup, suffix_dedup, url_filter)
from arbiter.llm.common import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def bpe_50k() -> dict[str, str]:
    """Files of the public 50k byte-level vocabulary, in both forms."""
    import public_tokenizers
    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
            "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, **bpe_50k())


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]
_RULE_ROWS = ", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for v, r in URL_RULES)


@query("op6_url_filter", sql=f"""
WITH rules(verdict, rhost, rpath, rule) AS (VALUES {_RULE_ROWS}),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM cut),
best AS (SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
         FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
         GROUP BY ALL)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b USING (page_id)""")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op8_merkle", sql=r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
after AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM d),
edited AS (SELECT *, left(text, n - n // 2) || left(next_text, n // 2) AS edited FROM after),
texts AS (SELECT doc_id, 'own' AS which, text AS t FROM edited UNION ALL SELECT doc_id, 'edited', edited FROM edited
          UNION ALL SELECT doc_id, 'next', next_text FROM edited),
trees AS (SELECT *, list_transform(string_split(t, chr(10) || chr(10)), lambda s:
                    list_transform(string_split(s, chr(10)), lambda p: sha256(p))) AS paragraphs FROM texts),
digests AS (SELECT *, list_transform(paragraphs, lambda ps: sha256(array_to_string(ps, ''))) AS sections FROM trees),
nodes AS (SELECT doc_id, which, t, sha256(array_to_string(sections, '')) AS root, list_distinct(
            ['0' || sha256(array_to_string(sections, ''))] || list_transform(sections, lambda s: '1' || s)
            || list_transform(flatten(paragraphs), lambda p: '2' || p)
            || list_transform(flatten(list_transform(string_split(regexp_replace(t, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)),
                 lambda s: regexp_extract_all(s, '(?:[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]*){1,2}'))), lambda leaf: '3' || leaf)) AS k
          FROM digests)
SELECT o.doc_id, length(o.t) AS n_chars, sha256(e.t) AS edited_sha256, o.root AS fingerprint, e.root AS edited_fingerprint,
       2.0::DOUBLE * len(list_intersect(o.k, e.k)) / (len(o.k) + len(e.k)) AS near_edited,
       2.0::DOUBLE * len(list_intersect(o.k, x.k)) / (len(o.k) + len(x.k)) AS near_next
FROM nodes o JOIN nodes e ON e.doc_id = o.doc_id AND e.which = 'edited' JOIN nodes x ON x.doc_id = o.doc_id AND x.which = 'next'
WHERE o.which = 'own'""")
def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_likeness(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query("op2_embedding_dedup", sql="""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
          ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
             AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM edges GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
       least(vec_id, coalesce(low.b, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id""")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op9_substring_dedup", sql=r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
repeats AS (SELECT doc_id, i FROM windows
            QUALIFY count(*) OVER (PARTITION BY words) > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM repeats)),
words AS (SELECT doc_id, j, w[j] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d)),
cut AS (SELECT words.doc_id, count(gone.j) AS n_removed,
               string_agg(word, ' ' ORDER BY words.j) FILTER (gone.j IS NULL) AS kept
        FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.j = words.j GROUP BY words.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)


@query("op10_suffix_dedup", sql="""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
suffixes AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
             FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
repeats AS (SELECT doc_id, i FROM suffixes QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 100)) AS j FROM repeats)),
spans AS (SELECT doc_id, count(*) AS n_removed, count(DISTINCT j - no) AS n_spans
          FROM (SELECT doc_id, j, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS no FROM gone) GROUP BY doc_id),
bytes AS (SELECT doc_id, j, substr(h, 2 * j + 1, 2) AS b
          FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS j FROM d)),
kept AS (SELECT bytes.doc_id, string_agg(b, '' ORDER BY bytes.j) AS k
         FROM bytes ANTI JOIN gone ON gone.doc_id = bytes.doc_id AND gone.j = bytes.j GROUP BY bytes.doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)


@query("op11_decontamination", sql=r"""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS down,
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, down), word) AS w FROM documents, low),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), up, down), word) AS w
      FROM benchmark, low),
windows AS (
  SELECT item, 10 AS n, array_to_string(w[i:i + 9], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)
  UNION ALL SELECT item, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
found AS (SELECT doc_id, i, places.n, item FROM places JOIN windows ON places.n = windows.n AND places.words = windows.words),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.match_benchmark(docs, table(spark, sf_dir, "benchmark"), window=10)
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                        F.size(c["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
                        (c["n_hit"] > 0).alias("contaminated"))


# CRC-32 bit by bit over the UTF-8 bytes of ASCII and Latin-1 characters.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
            lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END))),
          lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, r: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


@query("op12_spelling_variants", sql=rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (SELECT run, k, {_CRC.format("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
words AS (SELECT word, sum(k)::BIGINT AS n FROM (
            SELECT k, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
                      ELSE run END AS word FROM hashed)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (SELECT word, n, i, left(word, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT DISTINCT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
         UNION SELECT DISTINCT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (SELECT word, other, n AS other_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
forms AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN other_n >= 10 * words.n THEN other END AS form,
                 CASE WHEN other_n >= 10 * words.n THEN other_n END AS form_n
          FROM words LEFT JOIN best USING (word)),
chain(word, root) AS (SELECT word, form FROM forms WHERE form IS NOT NULL
                      UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"), shortest=7, least=2, ratio=10, noise=31)


def piece_32k() -> dict[str, str]:
    """Files of both sides of the alignment."""
    import public_tokenizers
    return bpe_50k() | {"model": public_tokenizers.path("piece_bpe_32k.model")}


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), **piece_32k()).drop("groups")
