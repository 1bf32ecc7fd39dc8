"""The dealt queries: each applies its operator to the whole table with production parameters and derives the digest
columns. ORACLE holds DuckDB SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.llm import bpe, collocations, decontam, fingerprint, jaccard_join, lang_id, license_scan, line_dedup, pii, prefix_trie, quality, simhash, token_count
from scorewright.llm.common import A_Z, WORD, read

TOKEN_LIMIT = 1024
COUNT_VOCABULARY = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
SIMHASH_SHINGLE = 4
SIMHASH_DISTANCE = 4
LINE_MIN_CHARS = 1
LINE_MIN_DOCS = 10
PHRASE_COUNT = 100
PHRASES = 2000
JACCARD_SHINGLE = 5
JACCARD_PERCENT = 80
HEAD_TURNS = 9
QUALITY_THRESHOLD = 0.3
PSEUDONYM_KEY = "scorewright demonstration key"


def bpe_digests(docs: DataFrame) -> DataFrame:
    ranks = public_tokenizers.path(BPE_RANKS)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.encode(docs, ranks, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = lang_id.learn(docs, _remainder(3) != 1)
    found = lang_id.label_languages(docs, model)
    return found.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_VOCABULARY), TOKEN_LIMIT)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """score: the largest share of a matched template's words that stand in place; 0 without a match."""
    found = license_scan.scan(read(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"].cast("long"))
    labels = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), SIMHASH_SHINGLE, SIMHASH_DISTANCE)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_frequent_lines(read(spark, sf_dir, "documents"), LINE_MIN_CHARS, LINE_MIN_DOCS)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with their score by a model of the learnable labels of the whole table."""
    model = quality.learn(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), _remainder(5) != 0)
    return quality.score(docs, model)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(spark, read(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(read(spark, sf_dir, "documents"))


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read(spark, sf_dir, "documents"), PSEUDONYM_KEY).select("doc_id", "text", *(f"n_{k}" for k in pii.KINDS))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), PHRASE_COUNT, PHRASES)


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), JACCARD_SHINGLE, JACCARD_PERCENT)


def rebuilt(sequences: DataFrame) -> DataFrame:
    """conv_id and turns: the first h turns of conversation c - c % 5, then what follows the first h of c's own, where
    h is the CRC-32 of c as text, modulo HEAD_TURNS."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS).cast("int")
    heads = sequences.select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD_TURNS - 1).alias("head"))
    joined = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
    none = F.array().cast(prefix_trie.TURNS)
    head = F.slice(F.coalesce("head", none), F.lit(1), h)
    return joined.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns") + 1)).alias("turns"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.prefix_nodes(rebuilt(prefix_trie.turn_sequences(read(spark, sf_dir, "conversations"))))
    return nodes.withColumn("depth", F.col("depth").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_pii_pseudonyms": op10_pii_pseudonyms,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_conversation_trie": op13_conversation_trie,
}

_LOWER = f"'{A_Z}', '{A_Z.lower()}'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{WORD}')"



def _license_sql() -> str:
    """Places of each template's phrases. Here every template has one mandatory phrase as long as itself or is
    searched by its first; the longer notices are compared word by word."""
    templates = (*license_scan.BASE, *license_scan.NOTICES)
    rows = []
    for i, t in enumerate(templates):
        its = t.text.split()
        spans = [next(k + 1 for k in range(len(its)) if its[k : k + len(m.split())] == m.split()) for m in t.mandatory]
        ends = [a + len(m.split()) - 1 for a, m in zip(spans, t.mandatory)]
        ok = " AND ".join(f"array_to_string(w[p + {a} : p + {b}], ' ') = '{m}'" for a, b, m in zip(spans, ends, t.mandatory))
        same = " + ".join(f"CAST(w[p + {k + 1}] = '{x}' AS INTEGER)" for k, x in enumerate(its))
        rare = its[spans[0] - 1]
        rows.append(f"""SELECT doc_id, '{t.label}' AS label, {str(i < len(license_scan.BASE)).lower()} AS base, p AS start,
  CAST({same} AS DOUBLE) / {len(its)} AS share FROM (SELECT doc_id, w, unnest(range(len(w) - {len(its) - 1})) AS p FROM d
  WHERE len(w) >= {len(its)} AND list_contains(w, '{rare}')) WHERE {ok}""")
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
m AS ({" UNION ALL ".join(rows)}),
b AS (SELECT doc_id, count(*) AS n, min(start) AS lo, max(start) AS hi FROM m WHERE base GROUP BY doc_id),
bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS ls FROM (SELECT DISTINCT doc_id, label FROM m WHERE base) GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS ls FROM (SELECT DISTINCT doc_id, label FROM m) GROUP BY doc_id),
sc AS (SELECT doc_id, max(share) AS score FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
  CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word, coalesce(bl.ls, '') AS base_labels,
  coalesce(al.ls, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN sc USING (doc_id)
"""


# CRC-32 of a number's decimal text: all bits at first set, each byte takes part and is followed by eight shifts.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
  WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END))"""

ORACLE: dict[str, str] = {
    "op3_license_scan": _license_sql(),
    "op5_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ip AS (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS place FROM i WHERE len(w) > 0),
grams AS (SELECT array_to_string(w[place + 1 : place + 13], ' ') AS gram, least(len(w), 13) AS len, item_id FROM ip),
lens AS (SELECT DISTINCT len FROM grams),
dp AS (SELECT doc_id, w, len, unnest(range(len(w) - len + 1)) AS place FROM d, lens WHERE len(w) >= len),
hits AS (SELECT doc_id, place, p.len, item_id
  FROM (SELECT doc_id, place, len, array_to_string(w[place + 1 : place + len], ' ') AS gram FROM dp) p
  JOIN grams g ON p.gram = g.gram AND p.len = g.len),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(place, place + len)) AS pos FROM (SELECT DISTINCT doc_id, place, len FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op7_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key FROM l),
frequent AS (SELECT key, true AS gone FROM k WHERE length(key) >= {LINE_MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {LINE_MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN frequent USING (key) GROUP BY doc_id
""",
    "op11_phrase_collocations": f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
s AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM p, (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS size) WHERE len(w) >= size),
f AS (SELECT lang, array_to_string(w[place : place + size - 1], ' ') AS phrase, size, count(*) AS n FROM s GROUP BY ALL),
t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= {PHRASE_COUNT}),
i AS (SELECT lang, a, w, size, unnest(range(2, size)) AS len FROM c),
j AS (SELECT lang, a, w, len, unnest(range(1, size - len + 2)) AS place FROM i),
k AS (SELECT lang, array_to_string(w[place : place + len - 1], ' ') AS phrase, max(a) AS longer FROM j GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN k USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT lang, phrase, size, a, w, unnest(range(1, size)) AS k FROM kept),
scored AS (SELECT cuts.*, l.n AS l, r.n AS r, t.n, (1000 * a::HUGEINT * t.n) // (l.n::HUGEINT * r.n) AS score
  FROM cuts JOIN t USING (lang) JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1 : k], ' ')
  JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[k + 1 : cuts.size], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= {PHRASES}
""",
    "op13_conversation_trie": f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
dict AS (SELECT role, text, row_number() OVER () AS id, strlen(text) AS size FROM (SELECT DISTINCT role, text FROM t)),
s AS (SELECT c, list({{'id': id, 'size': size}} ORDER BY turn NULLS FIRST, t.role, md5(strlen(t.role) || ':' || t.role || t.text)) AS turns
  FROM t JOIN dict USING (role, text) GROUP BY c),
h AS (SELECT c, turns, c - c % 5 AS base, {_CRC32} % {HEAD_TURNS} AS h FROM s),
r AS (SELECT h.c, list_concat(coalesce(b.turns, [])[1 : h.h], h.turns[h.h + 1 : ]) AS turns FROM h LEFT JOIN s b ON b.c = h.base),
p AS (SELECT c, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
k AS (SELECT c, n, depth, sha256(list_transform(turns[1 : depth], lambda x: x.id)::VARCHAR) AS key,
  sha256(list_transform(turns[1 : depth - 1], lambda x: x.id)::VARCHAR) AS parent, CASE WHEN depth > 0 THEN turns[depth].size ELSE 0 END AS size FROM p),
nodes AS (SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(size) AS size,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = n), '')) AS ends_sha256 FROM k GROUP BY key, depth),
kids AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key, depth)),
sums AS (SELECT k.key, k.depth, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.size) AS saved_tokens
  FROM full_nodes f JOIN k ON k.c = f.conv_id AND k.depth <= f.depth GROUP BY ALL)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums USING (key, depth) LEFT JOIN nodes up ON up.key = f.parent AND up.depth = f.depth - 1
""",
}
