"""The operators as registered queries over whole tables, with SQL twins where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, hmm, lexical, license_scan, mixing, negatives, quality, sharding, simhash, topk, url_filter, warc
from .common import shared_folder

#: Longest rule first; hosts with their paths.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
#: Names of ordinary and unwanted sites, each labelled under every domain, language and kind of path, so that only the name tells them apart.
ORDINARY_NAMES = """adventure anderson asterion author barton bestand bewitch bird blethers bookshop breadth brother camera
casing castle cathedral center chapter charity cheese chemistry city community cooking country culture daily earth east edition family farming father
feather fetch forest freedom garden gather general gentle harbour hand health heritage history holiday hotel house island kitchen lantern
leather letter library lighthouse market mathematics meadow mother mountain museum nature neither news nation northern notion option orchestra other painting
park pharmacy pillar playground position post press publisher radio reader ribble river school science serenade shelter sheath
stable station story street student teacher teaching tension theatre theory thesaurus thing thistle thought thread tithe together town travel
trial university valley village water weather whether window winter wither world writer tionary tionary-st hither-the thethe thther ationer""".split()
UNWANTED_NAMES = """casino casino-win bigcasino casino-royal casino-spin win-casino win-cash win-big slots-win slots free-slots jackpot jackpot-win poker poker-win
roulette bets bets-now free-bets best-bets bet-win sports-bets cheap-pills pills pills-online buy-pills diet-pills cheap-meds meds-now viagra cheap-viagra
cheap-replica replica-watch cheap-loans payday-loans fast-loans free-money free-cash adult adult-x adult-cam adult-chat adult-video xxx xxx-video xxx-cam porn
porn-tube free-porn sex sex-chat sexcam hot-cam live-cam escort nude-pics spam spam-farm spam-links link-farm linkfarm click-farm clickbait ads ads-track
ads-click adserver ad-tracker track-ads tracker popup-ads malware malware-site free-crack crack-keygen warez warez-free torrent-crack phishing phish-login
login-verify scam crypto-scam fake-prize prize-win lottery-win""".split()
SHARDS = [f"shard-{i:03d}" for i in range(64)]
SLOTS = 4099
#: Shares of tokens by domain of the label table.
TARGETS = {"clean": 0.9, "junk": 0.07, "toxic": 0.03}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_digest(table(spark, sf_dir, "pages"), shared_folder(spark, "archives"))
    return found.drop("fault")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The fixed labelled table (host, path, allow)."""
    rows = []
    for names, allow in ((ORDINARY_NAMES, 1), (UNWANTED_NAMES, 0)):
        shapes = [(sub, end, lang) for sub in ("", "www.", "m.", "blog.") for end in ("example.com", "example.org", "example.net", "com") for lang in ("de", "en", "es", "fr", "it")]
        for i, (sub, end, lang) in enumerate(shapes):
            number = 37 * i % 9973
            rows += [(f"{sub}{name}.{end}", f"/{lang}/{number + 101 * k % 9001}{('', '/', '.html')[(i + k) % 3]}", allow) for k, name in enumerate(names) if (i + k) % 4 == 0]
    return spark.createDataFrame(rows, "host string, path string, allow int")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, labelled_urls(spark))


def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), mixing.label_domains(table(spark, sf_dir, "labels")), TARGETS)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS, SLOTS)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json")).drop("text")
    texts = bpe.decode(coded, public_tokenizers.path("word_bpe_49k.json"))
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return negatives.mined(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


QUERIES = {f.__name__: f for f in (op1_warc, op2_license_scan, op3_quality, op4_url_filter, op5_hmm, op6_simhash, op7_decontaminate, op8_topk, op9_mixing, op10_sharding, op11_lexical, op12_bpe, op13_negatives)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NORMAL = r"trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
_BIGRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SHINGLES = r"""SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4])) AS s
FROM (SELECT {key}, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {table} WHERE text IS NOT NULL)"""

ORACLE = {
    "op1_warc": """
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN octet_length(payload) >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(payload) >= 100 AND first <> page_id THEN first END AS refers_to
FROM (SELECT page_id, encode(coalesce(html, '')) AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)""",
    "op2_license_scan": f"""
WITH notices(license, template_no, wording) AS (VALUES {", ".join(f"({_quoted(name)}, CAST({i} AS BIGINT), {_quoted(t)})" for name, texts in license_scan.TEMPLATES.items() for i, t in enumerate(texts))}),
patterns AS (SELECT license, template_no, {_BIGRAMS} AS pattern FROM (SELECT *, string_split({_NORMAL.format("wording")}, ' ') AS w FROM notices)),
units AS (SELECT doc_id, unnest(CASE WHEN len(ls) > 1 THEN list_transform(range(0, len(ls) + 1), lambda i: {{'n': i, 't': CASE WHEN i = 0 THEN text ELSE ls[i] END}})
                                ELSE [{{'n': CAST(1 AS BIGINT), 't': text}}] END) AS u
          FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
worded AS (SELECT doc_id, line_no, {_BIGRAMS} AS b FROM (SELECT doc_id, u.n AS line_no, string_split({_NORMAL.format("u.t")}, ' ') AS w FROM units)),
whole AS (SELECT row_number() OVER () AS r, doc_id, {_BIGRAMS.replace("list_distinct", "")} AS b FROM (SELECT doc_id, string_split({_NORMAL.format("text")}, ' ') AS w FROM documents WHERE text IS NOT NULL)),
placed AS (SELECT r, unnest(b) AS g, unnest(range(1, len(b) + 1)) AS i FROM whole),
hits AS (SELECT r, license, template_no, i, row_number() OVER (PARTITION BY r, license, template_no ORDER BY i) AS k FROM placed JOIN (SELECT license, template_no, unnest(pattern) AS g FROM patterns) USING (g)),
stretches AS (SELECT r, license, template_no, min(i) AS a, max(i) AS z, min(k) AS ka, max(k) AS kz FROM hits GROUP BY r, license, template_no, i - k),
runs AS (SELECT s.r, s.license, s.template_no, s.a, e.z FROM stretches s JOIN stretches e ON s.r = e.r AND s.license = e.license AND s.template_no = e.template_no AND s.a <= e.z
         JOIN patterns p ON p.license = s.license AND p.template_no = s.template_no
         WHERE e.z - s.a + 1 <= floor(1.5 * len(pattern) + 1e-9) AND e.kz - s.ka + 1 >= greatest(1, ceil(len(pattern) / 1.5 - 1e-9))),
valued AS (SELECT doc_id, r, license, template_no, a, z - a + 2 AS n, 2.0::DOUBLE * len(list_intersect(b[a:z], pattern)) / (len(list_distinct(b[a:z])) + len(pattern)) AS dice
           FROM runs JOIN whole USING (r) JOIN patterns USING (license, template_no))
SELECT doc_id, line_no, CAST(NULL AS INTEGER) AS first_word, CAST(NULL AS INTEGER) AS n_words, license, template_no, 2.0::DOUBLE * len(list_intersect(b, pattern)) / (len(b) + len(pattern)) AS dice
FROM worded JOIN patterns ON list_has_any(b, pattern)
WHERE 2.0::DOUBLE * len(list_intersect(b, pattern)) / (len(b) + len(pattern)) >= 0.8
UNION ALL
SELECT doc_id, NULL, CAST(a AS INTEGER), CAST(n AS INTEGER), license, template_no, dice FROM valued WHERE dice >= 0.8
QUALIFY row_number() OVER (PARTITION BY r, license, template_no ORDER BY dice DESC, a, n) = 1""",
    "op7_decontaminate": f"""
WITH d AS ({_SHINGLES.format(key="doc_id", table="documents")}), b AS ({_SHINGLES.format(key="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY 1)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_shingles HAVING count(*) / n_shingles >= 0.8 - 1e-12""",
    "op8_topk": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""",
    "op10_sharding": f"""
WITH slots AS (SELECT {sharding.lookup_table(SHARDS, SLOTS)} AS t),
placed AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(CAST(t[slot + 1] AS VARCHAR), 3, '0') AS shard FROM placed, slots""",
    "op11_lexical": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
f AS (SELECT r, doc_id, len(w) AS n, w FROM d WHERE len(w) > 0), s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM f),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM f) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
scored AS (SELECT item_id, r, doc_id, sum(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN df USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
    "op13_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
