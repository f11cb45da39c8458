"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, dedup, language_model, licences, manifest, matroska, mixing, near_dedup, packing, pii, spelling, token_counts, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(documents(spark, sf_dir)))


def op10_matroska_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.round_trip(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest checked against a copy in which n_chars is one more wherever 7 divides the checksum of the id."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest.manifest(documents(spark, sf_dir), {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    return found.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_lm_scoring, op3_toxicity, op4_token_counts, op5_source_mixing, op6_exact_dedup, op7_minhash_near_dedup, op8_license_scan, op9_pii_spans, op10_matroska_media, op11_spelling_variants, op12_benchmark_decontamination, op13_merkle_manifest)}

ORACLE_SQL: dict[str, str] = {
    "op5_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         CAST(3 * source_size AS DOUBLE) AS cap
  FROM s),
l AS (
  SELECT *, row_number() OVER o AS k,
         (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
  FROM w WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST)),
t AS (
  SELECT source, source_size,
         coalesce(least(cap, weight * (SELECT arg_min(lev, k) FROM l WHERE lev <= cap / weight)), cap) AS target
  FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(least(target / source_size, 3.0::DOUBLE)) ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS expected
  FROM t),
r AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.expected - e.whole AS p, e.target - e.whole * e.source_size AS rest,
         d.u, d.source
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
q AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS ranked FROM r),
c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ranked, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM q)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN p > 0 AND before + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
""",
    "op6_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256 FROM d JOIN g USING (h)
""",
}


# The table of known texts for SQL is made in Python, apart from the operator's expressions.


def _words_of(text: str) -> str:
    for spelling, one in licences.SPELLINGS:
        text = text.replace(spelling, one)
    return re.sub("[^a-z0-9\x80-\xa8\xaa-\U0010ffff]+", " ", text).strip(" ")


def _lowered(text: str) -> str:
    return text.translate(str.maketrans(licences.UPPER, licences.LOWER))


def _form_of(text: str) -> str:
    return _words_of(re.sub(licences.COPYRIGHT_LINE, r"\1", _lowered(text)))


def _words_sql(text: str) -> str:
    for spelling, one in licences.SPELLINGS:
        quoted = spelling.replace("'", "''")
        text = f"replace({text}, '{quoted}', '{one}')"
    return rf"trim(regexp_replace({text}, '[^a-z0-9\x{{80}}-\x{{A8}}\x{{AA}}-\x{{10FFFF}}]+', ' ', 'g'))"


#: A year behind the word or a sign.
_STATED = r"(?:(?:copyright[ \t]*)?(?:\(c\)|©)|copyright)[ \t]*[0-9][0-9][0-9][0-9]"


def _licence_sql() -> str:
    forms = {}
    inner = {_form_of(t) for _, t in licences.KNOWN + licences.bodies()}
    for licence, text in licences.KNOWN + licences.full_texts():
        forms[_form_of(text)] = min(licence, forms.get(_form_of(text), "~"))
    forms |= {_words_of(_lowered(t)): licence for licence, t in licences.RIGHTS}
    digest = lambda f: hashlib.sha256(f.encode()).hexdigest()
    known = ", ".join(f"('{digest(f)}', '{licence}')" for f, licence in forms.items())
    places = ", ".join(f"('{' '.join(f.split(' ')[: licences.OPENING])}', {len(f)}, '{digest(f)}')" for f in forms if f in inner and len(f.split(" ")) >= licences.INNER)
    rest = "|".join(sorted({re.escape(f).replace("\\ ", " ") if len(f.split(" ")) <= licences.SHORT else " ".join(f.split(" ")[: licences.OPENING]) + " .*" for f in forms}))
    lower = f"translate(body, '{licences.UPPER}', '{licences.LOWER}')"
    return f"""
WITH k(digest, licence) AS (VALUES {known}),
o(opening, n, digest) AS (VALUES {places}),
d AS (SELECT doc_id, {lower} AS body FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)),
w AS (SELECT doc_id, {_words_sql(f"regexp_replace(body, '{licences.COPYRIGHT_LINE}', '{chr(92)}1', 'g')")} AS whole FROM d),
s AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS n FROM d),
u AS (SELECT doc_id, n, line, {_words_sql("line")} AS plain FROM s),
v AS (SELECT *, plain = 'all rights reserved' OR ends_with(plain, ' all rights reserved') AS reserves FROM u),
x AS (SELECT *, CASE WHEN reserves THEN trim(left(plain, length(plain) - 19)) ELSE plain END AS head FROM v),
t AS (SELECT doc_id, n, unnest(forms) AS form, generate_subscripts(forms, 1) AS part FROM (SELECT *, list_concat(
  CASE WHEN regexp_matches(line, '{licences.COPYRIGHT_LINE}') THEN [regexp_extract(head, '(?:^| )({rest})$', 1)]
       WHEN regexp_matches(line, '{_STATED}') THEN [{_words_sql(f"regexp_extract(line, '^(.*?){_STATED}', 1)")}, regexp_extract(head, '(?:^| )({rest})$', 1)]
       ELSE [head] END, CASE WHEN reserves THEN ['all rights reserved'] ELSE [] END) AS forms FROM x)),
l AS (SELECT t.doc_id, t.n, t.part, k.licence FROM t JOIN k ON sha256(t.form) = k.digest WHERE t.form <> ''),
g AS (SELECT doc_id, count(*) AS n_lines, string_agg(licence, ',' ORDER BY n, part) AS licences FROM l GROUP BY doc_id),
c AS MATERIALIZED (SELECT w.doc_id, w.whole, o.* FROM w JOIN o ON contains(w.whole, o.opening)),
p AS (SELECT *, unnest(range(1, length(whole) + 1)) AS place FROM c),
f AS (SELECT p.doc_id, k.licence, min(place) AS place FROM p JOIN k USING (digest) WHERE starts_with(substr(whole, place), opening) AND sha256(substr(whole, place, n)) = p.digest
  AND (place = 1 OR substr(whole, place - 1, 1) = ' ') AND substr(whole, place + n, 1) IN ('', ' ') GROUP BY 1, 2),
i AS (SELECT doc_id, string_agg(licence, ',' ORDER BY place, licence) AS inside FROM f GROUP BY doc_id)
SELECT w.doc_id, sha256(w.whole) AS digest, k.licence, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.licences, '') AS licences, coalesce(i.inside, '') AS inside
FROM w LEFT JOIN k ON sha256(w.whole) = k.digest LEFT JOIN g ON w.doc_id = g.doc_id LEFT JOIN i ON w.doc_id = i.doc_id
"""


ORACLE_SQL["op8_license_scan"] = _licence_sql()


# crc32 of a list of bytes: its table from eight shifts of each byte, then a step for each byte.
_CRC_TABLE = "crc0 AS (SELECT range AS i, range AS v FROM range(256)),\n" + ",\n".join(f"crc{k + 1} AS (SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM crc{k})" for k in range(8)) + ",\ncrc AS (SELECT list(v ORDER BY i) AS tab FROM crc8)"


def _crc_sql(listed: str) -> str:
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {listed}, lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


_BYTES = "flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END))"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op11_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE},
occ AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
hashed AS (SELECT w, k, {_crc_sql(_BYTES.format(text="coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w"))} AS h FROM occ, crc),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM hashed)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, left(word, i - 1) || '_' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.less = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most, first(other ORDER BY other_n DESC, other) AS other FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 10 * w.n THEN b.other END AS form, CASE WHEN b.most >= 10 * w.n THEN b.most END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain(word, tip, form) AS (SELECT word, word, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.tip AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""

ORACLE_SQL["op12_benchmark_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM (SELECT *, least(10, len(w)) AS size FROM b WHERE len(w) > 0))),
s AS (SELECT DISTINCT size FROM g),
p AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, s WHERE len(w) >= size),
o AS MATERIALIZED (SELECT r, i, size, gram FROM (SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram FROM p) SEMI JOIN g USING (size, gram)),
h AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM (SELECT DISTINCT r, size, gram FROM o) JOIN g USING (size, gram) WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN t ON d.r = t.r
"""


def _leaf_sql(n_chars: str) -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"
    return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN {_crc_sql(_BYTES.format(text="CAST(doc_id AS VARCHAR)"))} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS tampered FROM documents, crc),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM d),
nodes(g, level, pos, h) AS (
  SELECT g, 0, pos, leaf FROM p
  UNION ALL
  SELECT g, any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM nodes) WHERE n > 1 GROUP BY g, pos // 2),
sub AS (SELECT g, max_by(h, level) AS h, max(level) AS levels FROM nodes GROUP BY g),
upper(level, pos, h) AS (
  SELECT 0, g, h FROM sub
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1 GROUP BY pos // 2),
steps AS (  -- each level at which a node has a parent, with the node beside it, if there is one
  SELECT x.g, x.level AS step, x.pos, y.h FROM nodes x JOIN sub s ON x.g = s.g AND x.level < s.levels LEFT JOIN nodes y ON x.g = y.g AND x.level = y.level AND y.pos = xor(x.pos, 1)),
upsteps AS (SELECT x.level AS step, x.pos, y.h FROM upper x LEFT JOIN upper y ON x.level = y.level AND y.pos = xor(x.pos, 1) WHERE x.level < (SELECT max(level) FROM upper)),
r AS (SELECT row_number() OVER () AS r, p.*, s.h AS subroot, s.levels FROM p JOIN sub s ON p.g = s.g),
path AS (
  SELECT r.r, t.step, t.h, (r.pos >> t.step) % 2 AS side FROM r JOIN steps t ON t.g = r.g AND t.pos = r.pos >> t.step
  UNION ALL SELECT r.r, r.levels + t.step, t.h, (r.g >> t.step) % 2 FROM r JOIN upsteps t ON t.pos = r.g >> t.step),
fold(r, step, h) AS (
  SELECT r, 0, coalesce(tampered, leaf) FROM r
  UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN t.h IS NULL THEN f.h WHEN t.side = 1 THEN t.h || f.h ELSE f.h || t.h END) FROM fold f JOIN path t ON t.r = f.r AND t.step = f.step),
folded AS (SELECT r, max_by(h, step) AS h FROM fold GROUP BY r),
proof AS (SELECT r, string_agg(h, '' ORDER BY step) AS h FROM path WHERE h IS NOT NULL GROUP BY r),
root AS (SELECT max_by(h, level) AS h FROM upper)
SELECT r.doc_id, r.leaf, r.subroot, root.h AS root, sha256(coalesce(proof.h, '')) AS proof_sha256, folded.h AS folded_root, folded.h = root.h AS verified
FROM r JOIN folded ON r.r = folded.r LEFT JOIN proof ON r.r = proof.r, root
"""
