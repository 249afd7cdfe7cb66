"""The registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmart.llm import (
    bpe, decontaminate, language, lexical, licenses, periodic, personal, quality, secret_scan, shards, simhash, token_files, topk,
)
from weekmart.session import staging_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARDS = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds


def definition() -> bpe.Definition:
    return bpe.read_tokenizer(public_tokenizers.path(TOKENIZER))


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.annotate(docs, table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "documents").select("doc_id", F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text")
    return licenses.license_files(files)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = staging_path(spark, "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), definition(), out, end_id=END_ID)
    return token_files.read_token_files(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    calibrates = fold(F.col("doc_id"), 8) == 1  # an eighth, never of the held-out rows: its remainder by 4 is 1
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), calibrates.alias("calibrates"))
    models = language.train(docs.where("not held_out and not calibrates"))
    stored = staging_path(spark, "languages")
    language.identify(docs, models).drop("text").write.parquet(stored)
    told = spark.read.parquet(stored)
    limits = language.rejection_limits(told.where("calibrates")).select(F.col("lang").alias("limit_lang"), "limit")
    rejected = F.coalesce(F.col("prediction.entropy") > F.col("limit"), F.lit(False))
    return told.join(F.broadcast(limits), F.col("prediction.lang") == F.col("limit_lang"), "left").select(
        "doc_id", "held_out", F.col("prediction.lang").alias("lang_pred"), F.col("prediction.score").alias("score"),
        F.col("prediction.entropy").alias("entropy"), rejected.alias("rejected"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shards.uniform_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return quality.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = definition()
    coded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer).drop("text")
    decoded = bpe.decode(coded, tokenizer)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.with_spans(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = secret_scan.joined(spans, ("assign", "access", "hex"))

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 20)


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.with_spans(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(personal.of_kinds(spans, [kind])).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, personal.BASE), F.sha2(personal.joined(spans, personal.BASE).cast("binary"), 256).alias("base_sha256"),
        personal.joined(spans).alias("spans"), F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Every text whose crc32 of doc_id ends in 0 with words from a place a on repeated after p words; a null id counts as the empty text."""
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(digest % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    g, n = F.expr("_digest div 10"), F.size("_words")
    placed = docs.withColumns({"_digest": digest, "_words": words}).withColumn("_a", F.when(n > 0, g % n).cast("int"))
    placed = placed.withColumn("_p", F.expr("int(1 + (size(_words) - _a) div (3 + (_digest div 10) % 8))"))
    repeated = F.expr("array_join(transform(sequence(0, size(_words) - 1), i -> _words[if(i < _a, i, _a + (i - _a) % _p)]), ' ')")
    return placed.withColumn("text", F.when(F.col("_a").isNotNull(), repeated).otherwise(F.col("text"))).drop("_digest", "_words", "_a", "_p")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_planted_periods(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic.with_runs(docs).select("doc_id", "periodic.runs", "periodic.collapsed")
    best = F.expr(f"aggregate(runs, cast(null as {periodic.RUN}), (a, r) -> if(a is null or r.length * a.period > a.length * r.period, r, a))")
    told = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    every = F.when(F.size("runs") > 0, F.concat(told, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(every.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bw))),
hit AS (SELECT rid, i, dw.size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.g = bw.g),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hit) GROUP BY rid),
hit_items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""

OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP4_SQL = f"""
WITH f AS (
  SELECT row_number() OVER () AS rid, doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, text FROM documents),
t AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{a}', '{b}')" for k, (a, b) in enumerate(licenses.TEMPLATES))}) v(template, license, notice)),
tt AS (
  SELECT template, license, term, count(*) AS n
  FROM (SELECT template, license, unnest(regexp_extract_all(lower(notice), '{licenses.TOKEN}')) AS term FROM t) GROUP BY ALL),
df AS (
  SELECT term, count(*) AS df FROM (SELECT DISTINCT rid, unnest(regexp_extract_all(lower(text), '{licenses.TOKEN}')) AS term FROM f)
  WHERE term IN (SELECT term FROM tt) GROUP BY term),
weighted AS (
  SELECT template, license, tt.term, n, ln((1 + files) / (1 + coalesce(df, 0))) + 1 AS idf
  FROM tt CROSS JOIN (SELECT count(*) AS files FROM f) LEFT JOIN df ON tt.term = df.term),
w AS (SELECT template, license, term, idf, (1 + ln(n)) * idf AS w FROM weighted),
known AS (SELECT DISTINCT term, idf FROM w),
other AS (SELECT avg(idf) AS other FROM known),
spans AS (
  SELECT rid, 0 AS line, regexp_extract_all(lower(text), '{licenses.TOKEN}') AS terms FROM f
  WHERE text IS NOT NULL AND NOT regexp_matches(text, '(?i){licenses.NEGATED}')
  UNION ALL
  SELECT rid, line, regexp_extract_all(lower(lines[line]), '{licenses.TOKEN}')
  FROM (SELECT rid, lines, unnest(range(1, len(lines) + 1)) AS line FROM (SELECT rid, string_split(text, chr(10)) AS lines FROM f WHERE text IS NOT NULL))
  WHERE NOT regexp_matches(lines[line], '(?i){licenses.NEGATED}')),
vec AS (
  SELECT rid, line, c.term, (1 + ln(n)) * coalesce(idf, other) AS v, idf IS NOT NULL AS listed
  FROM (SELECT rid, line, term, count(*) AS n FROM (SELECT rid, line, unnest(terms) AS term FROM spans) GROUP BY ALL) c
  LEFT JOIN known ON c.term = known.term CROSS JOIN other),
len1 AS (SELECT rid, line, sqrt(sum(v * v)) AS length FROM vec GROUP BY ALL),
len2 AS (SELECT template, sqrt(sum(w * w)) AS length FROM w GROUP BY template),
dots AS (SELECT rid, line, template, license, sum(v * w) AS dot FROM vec JOIN w ON vec.term = w.term WHERE listed GROUP BY ALL),
cos AS (
  SELECT rid, line, license, round(dot / (len1.length * len2.length), 6) AS score
  FROM dots JOIN len1 USING (rid, line) JOIN len2 USING (template)),
hit AS (SELECT doc_id, path, line::INTEGER AS line, license, score, (license = '{licenses.RESERVED}')::INT AS rank FROM cos JOIN f USING (rid) WHERE score >= {licenses.MIN_COSINE}),
best AS (
  SELECT doc_id, path, min(rank) AS rank, arg_min(license, (rank, -score, line, license)) AS license, -min((rank, -score))[2] AS score,
    arg_min(line, (rank, -score, line, license)) AS line, bool_or(line = 0) AS covers
  FROM hit GROUP BY doc_id, path),
shown AS (
  SELECT doc_id, path, string_agg(DISTINCT license, ',' ORDER BY license) AS all_licenses
  FROM (SELECT doc_id, path, line, arg_min(license, (rank, -score, license)) AS license FROM hit GROUP BY doc_id, path, line) GROUP BY doc_id, path),
licensed AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS above, arg_min(license, (rank, -score, path, license)) AS license
  FROM best WHERE covers GROUP BY above),
dirs AS (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS directory FROM f),
ups AS (
  SELECT directory, depth, array_to_string(string_split(directory, '/')[1:depth], '/') AS above
  FROM (SELECT directory, unnest(range(0, CASE WHEN directory = '' THEN 1 ELSE len(string_split(directory, '/')) + 1 END)) AS depth FROM dirs)),
near AS (
  SELECT directory, arg_max(license, depth) AS inherited, arg_max(above, depth) AS inherited_from FROM ups JOIN licensed USING (above) GROUP BY directory)
SELECT f.doc_id, f.path, b.license AS own_license, b.score, b.line, s.all_licenses,
  CASE WHEN b.license IS NULL THEN inherited_from END AS inherited_from, coalesce(b.license, inherited) AS license
FROM f LEFT JOIN best b ON f.doc_id IS NOT DISTINCT FROM b.doc_id AND f.path = b.path
LEFT JOIN shown s ON f.doc_id IS NOT DISTINCT FROM s.doc_id AND f.path = s.path
LEFT JOIN near ON near.directory = regexp_replace(f.path, '/?[^/]*$', '')
"""

def _personal_sql() -> str:
    """Plain patterns with the places of their matches by running sums, the checks and the words beside them."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": rf"\b(?:{personal.IBAN_BODY})\b", "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"}
    proposed = " UNION ALL ".join(f"""
  SELECT rid, '{kind}' AS kind, unnest(regexp_extract_all(text, '{pattern}')) AS hit, unnest(string_split_regex(text, '{pattern}')) AS gap,
    unnest(range(1, len(string_split_regex(text, '{pattern}')) + 1)) AS i FROM d WHERE regexp_matches(text, '{pattern}')""" for kind, pattern in patterns.items())
    luhn = """list_sum(list_transform(range(1, length(number) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN substr(reverse(number), i, 1)::INT ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(reverse(number), i, 1)::INT + 1] END)) % 10 = 0"""
    mod_97 = f"""list_reduce(list_prepend(0, list_transform(range(1, length(plain) + 1), lambda i:
      instr('0123456789{personal.UPPER}', substr(plain[5:] || plain[:4], i, 1)) - 1)), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"""
    words = " ".join(f"WHEN '{k}' THEN regexp_matches(beside, '(^|[^a-z])({w})([^a-z]|$)')" for k, w in personal.WORDS.items())
    others = " ".join(f"WHEN '{k}' THEN regexp_matches(beside, '(^|[^a-z])({w})([^a-z]|$)')" for k, w in personal.OTHER_WORDS.items())
    scores = " ".join(f"WHEN '{k}' THEN {n}" for k, n in personal.SCORES.items())
    order = f"list_position({list(personal.KINDS)}, kind)"
    base = f"kind IN {personal.BASE}"
    spans = "string_agg(kind || ':' || first || ':' || last, ','"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
p AS ({proposed}),
placed AS (
  SELECT *, sum(length(gap)) OVER w + coalesce(sum(length(hit)) OVER (PARTITION BY rid, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first,
    lead(gap) OVER w AS after FROM p WINDOW w AS (PARTITION BY rid, kind ORDER BY i)),
numbered AS (
  SELECT *, regexp_replace(hit, '[^0-9]', '', 'g') AS number, replace(hit, ' ', '') AS plain,
    translate(right(gap, {personal.BEFORE}) || ' | ' || left(after, {personal.AFTER}), '{personal.UPPER}', '{personal.LOWER}') AS beside FROM placed WHERE hit IS NOT NULL),
kinds AS (
  SELECT rid, first::BIGINT AS first, (first + length(hit))::BIGINT AS last, beside, CASE kind
    WHEN 'ip' THEN CASE WHEN regexp_full_match(hit, '{personal.BYTE}(\\.{personal.BYTE}){{3}}') THEN 'ip' END
    WHEN 'card' THEN CASE WHEN length(number) BETWEEN 13 AND 19 THEN CASE WHEN {luhn} THEN CASE WHEN length(number) >= 16 THEN 'card' ELSE 'account' END END END
    WHEN 'phone' THEN CASE WHEN length(number) BETWEEN 8 AND 15 THEN 'phone' END
    WHEN 'iban' THEN CASE WHEN {mod_97} THEN 'iban' END
    WHEN 'ssn' THEN CASE WHEN NOT regexp_matches(hit, '^(000|666|9)|-00-|0000$') AND right(gap, 1) <> '-' AND left(after, 1) <> '-' THEN 'ssn' END
    ELSE kind END AS kind
  FROM numbered),
scored AS (
  SELECT *, least(100, CASE kind {scores} END + CASE WHEN CASE kind {words} END THEN {personal.CONTEXT_SCORE} ELSE 0 END
    - CASE WHEN CASE kind {others} ELSE false END THEN {personal.CONTEXT_SCORE} ELSE 0 END) AS score FROM kinds WHERE kind IS NOT NULL),
found AS (SELECT * FROM scored WHERE {base} OR score >= {personal.MIN_SCORE}),
texts AS (
  SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in personal.BASE)},
    {spans} ORDER BY {order}, first) FILTER ({base}) AS base, {spans} ORDER BY {order}, first) AS spans,
    string_agg(score::VARCHAR, ',' ORDER BY {order}, first) AS scores
  FROM found GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in personal.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN texts USING (rid)
"""


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(min(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark GROUP BY item_id),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM b) GROUP BY ALL),
c AS (SELECT count(*)::BIGINT AS documents, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
t AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term),
weighted AS (
  SELECT item_id, q.term, times * floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM q JOIN df ON q.term = df.term CROSS JOIN c),
impact AS (
  SELECT rid, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w)::BIGINT * documents) // total)) AS impact FROM t JOIN d USING (rid) CROSS JOIN c),
s AS (SELECT item_id, rid, sum(weight * impact)::BIGINT AS score FROM weighted w JOIN impact i ON w.term = i.term GROUP BY ALL),
r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM s JOIN d USING (rid) WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontamination, op2_exact_top_k, op3_simhash, op4_licenses, op5_token_files, op6_language, op7_sharding, op8_quality, op9_bpe, op10_secrets,
    op11_ranked_search, op12_personal_data, op13_periodic_runs)}
SQL: dict[str, str] = {"op1_decontamination": OP1_SQL, "op2_exact_top_k": OP2_SQL, "op4_licenses": OP4_SQL, "op11_ranked_search": OP11_SQL,
                       "op12_personal_data": _personal_sql()}
