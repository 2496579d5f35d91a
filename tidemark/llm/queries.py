"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, divergence, mixing, neardup, packing, periods, quality, substrings, topk, toxicity, turns, urls, warc
from tidemark.llm.words import words_column

Query = Callable[[SparkSession, str], DataFrame]
LISTED_ONE_IN = 7  # pages, by the hash of their ids, whose urls are op9's blocklist
WORD = r"[^\x20\x09-\x0D]+"


def tokenizer_path() -> str:
    """The public tokenizer's file, or TIDEMARK_TOKENIZER."""
    if named := os.environ.get("TIDEMARK_TOKENIZER"):
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    """The public rank file of op13, or TIDEMARK_RANKS."""
    if named := os.environ.get("TIDEMARK_RANKS"):
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    scores = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels").filter(~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.judged_texts(table(spark, folder, "documents")).drop("char_distance", "word_distance")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    scores = quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels").filter(~held_out))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixture(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), tokenizer_path())


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, folder, "embeddings"))
    return topk.exact_top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


def op8_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(table(spark, folder, "pages"))
    return warc.page_records(warc.read_chunks(spark, archives)).drop("intact")


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    listed = pages.filter(remainder(F.col("page_id"), LISTED_ONE_IN) == 0)
    return urls.judged_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substrings.repeats_removed(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def looped(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten (by the hash of its id) repeats a few words of its own from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), words_column(F.col("text")).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    left = F.col("n") - F.col("a")
    times = F.ceil(left / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int")), times))
    text = F.array_join(F.concat(F.slice("words", 1, F.col("a").cast("int")), F.slice(cycle, 1, left.cast("int"))), " ")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.repeated_runs(looped(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]))
    rows = found.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.p")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations of which one row in twenty each is dropped, emptied, cut of its stops, doubled, or made the user's."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    h = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), h.alias("h")).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return turns.with_every_conversation(turns.repair_report(damaged(conversations)), conversations)


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe.decoded(bpe.encoded(table(spark, folder, "documents"), ranks_path()), ranks_path())
    return tokens.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


REGISTRY: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_distribution_divergence, op3_quality_classifier, op4_source_mixing, op5_best_fit_packing,
    op6_minhash_near_dedup, op7_exact_top_k, op8_warc_chunks, op9_url_filter, op10_substring_dedup, op11_periodic_runs, op12_conversation_repair, op13_byte_bpe, pipeline,
)}


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_LISTS = " ".join(f"WHEN lang = '{lang}' THEN {_sql_list(words)}" for lang, words in divergence.COMMON_WORDS.items())

OP2 = rf"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
counts AS (
  SELECT doc_id, lang, text, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')))::BIGINT
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}'))))::BIGINT AS n_dup_lines
  FROM texts),
windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lists AS (
  SELECT counts.*, coalesce(covered.n, 0) AS n_repeat_words, length(text)::BIGINT AS n_chars,
    CASE {_LISTS} ELSE {_sql_list(divergence.OTHER_WORDS)} END AS common,
    len(regexp_extract_all(text, '[A-Z]'))::DOUBLE AS upper, len(regexp_extract_all(text, '[!-@\[-`{{-~]'))::DOUBLE AS ascii_marks,
    (strlen(text) - length(text))::DOUBLE AS wide, list_transform(w, lambda x: lower(x)) AS low
  FROM counts LEFT JOIN covered USING (doc_id)),
hists AS (
  SELECT *, [greatest(0, word_chars - upper - ascii_marks - wide), upper, ascii_marks - n_symbols, wide, n_symbols::DOUBLE, (n_chars - word_chars)::DOUBLE] AS ch,
    list_transform(common, lambda c: len(list_filter(low, lambda x: x = c))::DOUBLE) AS cw
  FROM lists),
full_hists AS (SELECT *, list_append(cw, greatest(0, n_words - coalesce(list_sum(cw), 0))::DOUBLE) AS wo FROM hists),
refs AS (
  SELECT lang, {", ".join(f"sum(ch[{k}]) AS c{k}" for k in range(1, 7))}, {", ".join(f"sum(wo[{k}]) AS w{k}" for k in range(1, 18))}
  FROM full_hists GROUP BY lang),
pairs AS (
  SELECT f.*, [{", ".join(f"c{k}" for k in range(1, 7))}] AS rc, [{", ".join(f"w{k}" for k in range(1, 18))}] AS rw
  FROM full_hists f JOIN refs r ON f.lang IS NOT DISTINCT FROM r.lang),
shares AS (
  SELECT *, list_transform(range(1, 7), lambda k: [ch[k] / nullif(list_sum(ch), 0), rc[k] / nullif(list_sum(rc), 0)]) AS sc,
    list_transform(range(1, 18), lambda k: [wo[k] / nullif(list_sum(wo), 0), rw[k] / nullif(list_sum(rw), 0)]) AS sw
  FROM pairs),
far AS (
  SELECT *,
    {", ".join(f'''sqrt(greatest(0, list_sum(list_transform({s}, lambda p:
      ((CASE WHEN p[1] > 0 THEN p[1] * log2(p[1] / ((p[1] + p[2]) / 2)) ELSE 0 END)
       + (CASE WHEN p[2] > 0 THEN p[2] * log2(p[2] / ((p[1] + p[2]) / 2)) ELSE 0 END)) / 2)))) AS {n}''' for s, n in (("sc", "dc"), ("sw", "dw")))}
  FROM shares)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(
    (n_chars >= {divergence.MIN_CHARS} AND dc > {divergence.MAX_CHAR_DISTANCE}) OR (n_words >= {divergence.MIN_WORDS} AND dw > {divergence.MAX_WORD_DISTANCE}), false)) AS kept
FROM far
"""

OP4 = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, [1, 2, 3][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM sized GROUP BY source),
run AS (
  SELECT *, (sum(s) OVER ())::BIGINT AS total, (sum(w) OVER ())::BIGINT AS all_w,
    coalesce(sum(3 * s) OVER before, 0)::BIGINT AS f, coalesce(sum(w) OVER before, 0)::BIGINT AS h
  FROM sources WINDOW before AS (ORDER BY s / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
held AS (SELECT *, (3 * s)::DOUBLE <= (total - f)::DOUBLE * w / (all_w - h) AS held FROM run),
level AS (
  SELECT *, coalesce(sum(CASE WHEN held THEN 3 * s END) OVER (), 0)::BIGINT AS spent, coalesce(sum(CASE WHEN held THEN w END) OVER (), 0)::BIGINT AS done FROM held),
targets AS (SELECT source, s, CASE WHEN held THEN (3 * s)::DOUBLE ELSE (total - spent)::DOUBLE * w / (all_w - done) END AS target FROM level),
plan AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS whole FROM targets),
places AS (
  SELECT source, key, sum(size) AS words, coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized GROUP BY source, key)
SELECT d.doc_id, d.size, p.s AS source_size, p.target,
  (d.size * (p.whole + CASE WHEN p.target - p.whole * p.s > 0 AND 2 * q.before + q.words <= 2 * (p.target - p.whole * p.s) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source JOIN places q ON q.source IS NOT DISTINCT FROM d.source AND q.key = d.key
"""

OP6 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common.n >= 75 * (s.n + t.n - common.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT e.b, reach.r FROM reach JOIN both_ways e ON e.a = reach.doc_id),
least AS (SELECT doc_id, min(r) AS component FROM reach GROUP BY doc_id)
SELECT t.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.component, t.doc_id) AS component_id, t.doc_id = coalesce(l.component, t.doc_id) AS kept
FROM texts t LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""

OP7 = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e, row_number() OVER () AS place FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""

OP8 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, ((i // 4) * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < first THEN first END AS refers_to
FROM f
"""

def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string expression in SQL."""
    bit = "lambda d, k: xor(d >> 1, (d & 1) * 3988292384)"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: list_reduce(range(0, 8), {bit}, xor(c, b)), 4294967295::BIGINT), 4294967295)"


_RULE = """CASE WHEN {fit4} THEN 'example.net/en/' WHEN {fit3} THEN 'example.com/de/' WHEN {fit2} THEN 'org/fr/' WHEN {fit1} THEN 'net/' END""".format(**{
    f"fit{k}": f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    for k, (h, p) in enumerate((("net", "/"), ("org", "/fr/"), ("example.com", "/de/"), ("example.net", "/en/")), 1)
})

OP9 = rf"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
keyed AS (
  SELECT *, {_RULE} AS rule, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS key FROM cut),
listed AS (SELECT DISTINCT key FROM keyed WHERE {_crc32("page_id::VARCHAR")} % {LISTED_ONE_IN} = 0 AND key IS NOT NULL)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM keyed k LEFT JOIN listed l ON k.key = l.key
"""

OP10 = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM texts WHERE len(w) >= 35)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM windows) WHERE n > 1),
places AS (SELECT doc_id, w[k] AS word, k FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM texts)),
last_start AS (
  SELECT p.doc_id, p.word, p.k, max(a.i) OVER (PARTITION BY p.doc_id ORDER BY p.k ROWS UNBOUNDED PRECEDING) AS i
  FROM places p LEFT JOIN again a ON a.doc_id = p.doc_id AND a.i = p.k),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n FROM last_start WHERE i IS NULL OR k > i + 34 GROUP BY doc_id)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, (len(t.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

OP11 = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
places AS (
  SELECT doc_id, w, h, len(w)::BIGINT AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM texts),
looped AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[(CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // parts) ELSE i END + 1)::BIGINT]) ELSE w END AS w
  FROM places),
words AS (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS word, unnest(range(0, len(w)))::BIGINT AS i FROM looped),
equals AS (
  SELECT x.doc_id, x.i, y.i - x.i AS p FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM equals),
stretches AS (SELECT doc_id, p, min(i) AS s, count(*)::BIGINT + p AS l FROM islands GROUP BY doc_id, p, island),
runs AS (SELECT doc_id, s, l, min(p) AS p FROM stretches WHERE l >= 6 AND l >= 4 * p GROUP BY doc_id, s, l),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + l))::BIGINT AS i FROM runs),
kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS t FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id),
totals AS (
  SELECT doc_id, count(*)::BIGINT AS n_runs, string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p) AS lines, arg_min([s, l, p], [-l, s, p]) AS best
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS start, best[2]::BIGINT AS length, best[3]::BIGINT AS period,
  (1000 * best[2] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_FIRST_EDITS = ", ".join(
    f"CASE WHEN 3 + b{s} = f{s} THEN 'D' WHEN 2 + f{n} = f{s} THEN 'I' WHEN k{s} = f{s} THEN 'K' ELSE 'R' END" for s, n in enumerate((2, 2, 3, 2))
)

OP12 = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM base WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS ended, left(role, 1) AS r FROM damaged),
rows AS (
  SELECT *, CASE WHEN ended = '' THEN 1 WHEN again > 1 THEN 2 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS two FROM placed),
totals AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1)::BIGINT AS blank,
    count(*) FILTER (fault = 2)::BIGINT AS duplicate, count(*) FILTER (fault = 3)::BIGINT AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM rows GROUP BY conv_id),
back AS (
  SELECT conv_id, n + 1 AS i, 0::BIGINT AS f0, 4::BIGINT AS f1, 2::BIGINT AS f2, 0::BIGINT AS f3, ['', '', '', ''] AS edits FROM totals
  UNION ALL
  SELECT conv_id, i, f0, f1, f2, f3, [{_FIRST_EDITS}]
  FROM (SELECT *, least(g0, 2 + f2) AS f0, least(g1, 2 + f2) AS f1
    FROM (SELECT *, least(g2, 2 + g3) AS f2, least(g3, 2 + g2) AS f3
      FROM (SELECT *, {", ".join(f"least(3 + b{s}, k{s}, 2 + t + b{n})" + f" AS g{s}" for s, n in enumerate((2, 2, 3, 2)))}
        FROM (SELECT *, CASE WHEN t < 9999999 AND r = 's' THEN t + b1 WHEN t < 9999999 AND r = 'u' THEN t + b2 ELSE 99999999 END AS k0,
            CASE WHEN t < 9999999 AND r = 'u' THEN t + b2 ELSE 99999999 END AS k1, CASE WHEN t < 9999999 AND r = 'a' THEN t + b3 ELSE 99999999 END AS k2,
            CASE WHEN t < 9999999 AND r = 'u' THEN t + b2 ELSE 99999999 END AS k3
          FROM (SELECT x.conv_id, x.i, x.r, CASE x.fault WHEN 3 THEN 1 WHEN 0 THEN 0 ELSE 9999999 END::BIGINT AS t, b.f0 AS b0, b.f1 AS b1, b.f2 AS b2, b.f3 AS b3
            FROM back b JOIN rows x ON x.conv_id IS NOT DISTINCT FROM b.conv_id AND x.i = b.i - 1)))))),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 0 AS s, ''::VARCHAR AS audit, []::VARCHAR[] AS lines FROM totals
  UNION ALL
  SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END, s2, audit || e,
    CASE WHEN e = 'D' THEN lines ELSE list_append(lines, CASE WHEN e = 'K' THEN role WHEN s2 = 2 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END) END
  FROM (SELECT *, CASE WHEN e = 'D' THEN s WHEN e = 'K' AND r = 's' THEN 1 WHEN s = 2 THEN 3 ELSE 2 END AS s2
    FROM (SELECT w.*, x.role, x.text, x.r, CASE WHEN x.i IS NULL THEN 'I' ELSE b.edits[w.s + 1] END AS e
      FROM walk w JOIN back b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i LEFT JOIN rows x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.i = w.i
      WHERE x.i IS NOT NULL OR w.s IN (1, 2)))),
done AS (
  SELECT w.conv_id, gaps, blank, duplicate, truncated, illegal, b.f0 AS cost, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
  FROM walk w JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = t.n + 1 AND w.s IN (0, 3)
  JOIN back b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLE: dict[str, str] = {
    "op2_distribution_divergence": OP2, "op4_source_mixing": OP4, "op6_minhash_near_dedup": OP6, "op7_exact_top_k": OP7,
    "op8_warc_chunks": OP8, "op9_url_filter": OP9, "op10_substring_dedup": OP10, "op11_periodic_runs": OP11, "op12_conversation_repair": OP12,
}
