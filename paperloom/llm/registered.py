"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.llm import (
    byte_bpe,
    embedding_dedup,
    jaccard_join,
    line_dedup,
    mixing,
    pieces,
    prefix_trie,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_alignment,
    toxicity,
    url_filter,
)
from paperloom.llm.common import stored, table

QUERIES = {}
SQL = {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register(
    f"""WITH sized AS (
  SELECT doc_id, source, len({WORDS}) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS DOUBLE) AS cap,
    [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)]::DOUBLE AS weight
  FROM sized GROUP BY source
), stops AS (
  SELECT *, row_number() OVER o AS place,
    (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per_weight
  FROM sources WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
), goals AS (
  SELECT source, source_size, coalesce(least(cap, weight * (
    SELECT arg_min(per_weight, place) FROM stops WHERE cap / weight > per_weight)), cap) AS target FROM stops
), budgets AS (
  SELECT *, coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0) AS copies FROM goals
), steps AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket) AS up_to
  FROM (SELECT source, hash >> 24 AS bucket, sum(size) AS words FROM sized GROUP BY ALL)
), ends AS (
  SELECT b.source, (bucket + CASE WHEN 2 * (target - copies * source_size - (up_to - words)) >= words THEN 1 ELSE 0 END) << 24 AS threshold
  FROM steps s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
  WHERE up_to > target - copies * source_size AND up_to - words <= target - copies * source_size
)
SELECT doc_id, size, source_size, target,
  size * least(3, copies + CASE WHEN hash < threshold THEN 1 ELSE 0 END) AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN ends e ON d.source IS NOT DISTINCT FROM e.source"""
)
def op7_mixing(spark, folder):
    mixed = mixing.mixed(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register(
    rf"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
), keyed AS (
  SELECT *, {LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM lines
), shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT k.*, coalesce(doc_id <> keeper, FALSE) AS gone FROM keyed k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
)
def op8_line_dedup(spark, folder):
    cut = line_dedup.without_shared_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_STOPS = "[" + ", ".join(f"'{w}'" for w in quality_rules._spellings()) + "]"


@register(
    rf"""WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), placed AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS place, words FROM split
), windows AS (
  SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, words[place], words[place + 1], words[place + 2]) AS n FROM placed
), covered AS (
  SELECT doc_id, count(DISTINCT place + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id
), base AS (
  SELECT doc_id, text, words, lines, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words
    AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1
    AND len(list_intersect(words, {_STOPS})) >= 2
    AND len(regexp_extract_all(text, '[A-Z]')) / word_chars <= 0.5
    AND len(list_filter(words, lambda x: x LIKE '%!')) / n_words <= 0.5
    AND n_dup_lines / len(lines) <= 0.5
    AND len(list_filter(lines, lambda x: regexp_matches(x, '^[-*•–]'))) / len(lines) <= 0.9
    AND len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…')) / len(lines) <= 0.5 AS kept
FROM base"""
)
def op10_quality_rules(spark, folder):
    judged = quality_rules.judged(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register()
def op1_quality_classifier(spark, folder):
    measured = stored(quality_classifier.text_statistics(table(spark, folder, "documents")), "quality-statistics")
    model = quality_classifier.fit(measured, table(spark, folder, "labels"))
    return quality_classifier.scores(measured, model)


@register()
def op9_toxicity(spark, folder):
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register()
def op3_url_filter(spark, folder):
    return url_filter.judged(table(spark, folder, "pages"))


@register()
def op4_embedding_dedup(spark, folder):
    return embedding_dedup.deduplicated(table(spark, folder, "embeddings"))


@register()
def op5_pieces(spark, folder):
    """Piece counts and scores, a digest of the ids, and of the text that they decode to."""
    rows = pieces.encoded(table(spark, folder, "documents"), pieces.Codec.load())
    return rows.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "score",
        F.sha2(F.array_join("piece_ids", " "), 256).alias("pieces_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register(
    rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM words)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), reached AS (
  SELECT doc_id AS start, doc_id AS place FROM documents UNION SELECT start, b FROM reached JOIN links ON place = a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM documents d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) USING (doc_id)
JOIN (SELECT start AS doc_id, min(place) AS component_id FROM reached GROUP BY start) USING (doc_id)"""
)
def op6_jaccard_join(spark, folder):
    return jaccard_join.classes(table(spark, folder, "documents"))


@register()
def op2_suffix_dedup(spark, folder):
    rows = suffix_dedup.without_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register()
def op11_byte_bpe(spark, folder):
    rows = byte_bpe.encoded(table(spark, folder, "documents"), byte_bpe.Codec.load())
    return rows.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register()
def op13_token_alignment(spark, folder):
    first, second = byte_bpe.Codec.load(), token_alignment.PieceEncoder.load()
    rows = token_alignment.aligned(table(spark, folder, "documents"), first, second)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    rows = stored(rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"), "alignment")
    return token_alignment.scored(rows, second.size()).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


_TURN = "md5(length(role) || ':' || role || text)"


@register(
    rf"""WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 20 AS base, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM numbered)
), heads AS (
  SELECT c, h, place AS d, {_TURN} AS turn, len({WORDS}) AS words FROM convs JOIN numbered ON conv_id = base AND place <= h
), rebuilt AS (
  SELECT c, d, turn, words FROM heads
  UNION ALL
  SELECT c, place - h + coalesce(n, 0), {_TURN}, len({WORDS}) FROM convs JOIN numbered ON conv_id = c AND place > h
    LEFT JOIN (SELECT c, count(*) AS n FROM heads GROUP BY c) USING (c)
), steps AS (
  SELECT c, d, words, md5(string_agg(turn, '') OVER (PARTITION BY c ORDER BY d)) AS key FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM steps GROUP BY key, d
), ended AS (
  SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (
    SELECT c, arg_max(key, d) AS key FROM steps GROUP BY c) GROUP BY key
), parents AS (
  SELECT n.*, p.key AS parent FROM nodes n LEFT JOIN steps p ON p.c = conv_id AND p.d = n.d - 1
), counted AS (
  SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p
  LEFT JOIN (SELECT parent AS key, count(*) AS n_children FROM parents GROUP BY parent) USING (key)
), below AS (
  SELECT s.key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved_tokens
  FROM counted u JOIN steps s ON s.c = u.conv_id AND s.d <= u.d GROUP BY s.key
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted n JOIN below USING (key) LEFT JOIN ended USING (key) LEFT JOIN nodes p ON p.key = n.parent"""
)
def op12_prefix_trie(spark, folder):
    turns = stored(prefix_trie.numbered(table(spark, folder, "conversations")), "trie-turns")
    members = turns.select("conv").distinct().withColumns(
        {"base": F.col("conv") - F.col("conv") % 20, "h": F.crc32(F.col("conv").cast("string")) % 4}
    )
    heads = turns.filter("depth <= 3").withColumnRenamed("conv", "head")
    first = members.join(heads, (F.col("base") == F.col("head")) & (F.col("depth") <= F.col("h")))
    taken = first.groupBy("conv").agg(F.count("*").alias("n")).withColumnRenamed("conv", "taker")
    shift = members.join(taken, F.col("conv") == F.col("taker"), "left").select(
        F.col("conv").alias("own"), "h", (F.coalesce("n", F.lit(0)) - F.col("h")).alias("shift")
    )
    rest = turns.join(shift, F.col("conv") == F.col("own")).filter("depth > h").withColumn("depth", F.col("depth") + F.col("shift"))
    columns = ["conv", "depth", "t1", "t2", "words"]
    return prefix_trie.trie(stored(first.select(columns).union(rest.select(columns)), "trie-rebuilt"), members.select("conv"))
