"""One query for each operator over its whole table, and its rows as SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docloom.llm.ann import nearest
from docloom.llm.bpe import encode_bpe
from docloom.llm.decontaminate import find_passages
from docloom.llm.filter_audit import CHECKS, REPEATED, audit_filters, filter_masks
from docloom.llm.hard_negatives import mine_hard_negatives
from docloom.llm.line_dedup import dedup_lines
from docloom.llm.ngram_join import ngram_join
from docloom.llm.packing import pack
from docloom.llm.pii import BASE, find_pii
from docloom.llm.quality import score_quality, scored_rows, train_quality
from docloom.llm.sharding import assign_shards
from docloom.llm.shared import table
from docloom.llm.topk import top_k
from docloom.llm.toxicity import score_toxicity, train_toxicity

SHARDS = 40


def vocabulary(name: str) -> str:
    """Where a public tokenizer file is on this machine; executors look at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pack(documents, vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), n=3, percent=90)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def _joined_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def _count_of(kind: str) -> Column:
    return F.size(F.filter("_pii", lambda s: s["kind"] == kind)).cast("long")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = [kind.name for kind in BASE]
    base = F.filter("_pii", lambda s: s["kind"].isin(names))
    return found.select(
        "doc_id",
        *[_count_of(name).alias(f"n_{name}") for name in names],
        F.sha2(_joined_spans(base).cast("binary"), 256).alias("base_sha256"), _joined_spans(F.col("_pii")).alias("spans"),
    )


def _asked(vec_id: Column) -> Column:
    return vec_id % 50 == 0


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), _asked, k=5)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), _asked, k=5, scale=256)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(documents, table(spark, sf_dir, "labels"))
    return scored_rows(score_quality(documents, model), threshold=0.7)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_bpe(documents, vocabulary("word_bpe_49k.json"), decode=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = dict.fromkeys(range(SHARDS), 1.0)
    placed = assign_shards(table(spark, sf_dir, "documents"), even, even | {SHARDS: 1.0})
    return placed.withColumn("law", F.lit("key"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(documents, table(spark, sf_dir, "labels"))
    return scored_rows(score_toxicity(documents, model), threshold=0.3)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_masks(table(spark, sf_dir, "documents"))
    return audit_filters(masks, table(spark, sf_dir, "labels"), "".join(CHECKS) + REPEATED)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", noisy.alias("label"))
    return mine_hard_negatives(vectors, _asked)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)
    items = F.sort_array(F.col("items").cast("array<string>"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_LINE_DEDUP = r"""
WITH parts AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), exploded AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM parts
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM exploded
), shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


_FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), worded AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    min(doc_id) OVER (PARTITION BY t) AS least FROM texts
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS f
  FROM worded LEFT JOIN marks USING (doc_id)
), counted AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failed GROUP BY part, f
), letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l) JOIN letters d ON d.l NOT IN (a.l, b.l, c.l)
  JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
  SELECT o, i AS step, substr(o, i, 1) AS l, left(o, i - 1) AS earlier FROM orders, range(1, 6) AS r(i)
), judged AS (
  SELECT part, o, step, l, f, n, good, bad, contains(f, l) AS fails, translate(f, earlier, '') <> f AS already FROM counted, steps
), summed AS (
  SELECT part, o, step, l, sum(n) FILTER (WHERE NOT fails AND NOT already) AS kept, sum(n) FILTER (WHERE fails AND NOT already) AS removed,
    sum(n) FILTER (WHERE fails AND already) AS redundant, sum(n) FILTER (WHERE f = l) AS unique_fails,
    sum(good) FILTER (WHERE fails AND NOT already) AS good_lost, sum(bad) FILTER (WHERE fails AND NOT already) AS toxic_lost
  FROM judged GROUP BY part, o, step, l
)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, l), 0) AS BIGINT) AS shapley
FROM summed"""


_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    CAST(list_sum(list_transform(list_zip(a.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), found AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3"""


_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = (
    rf"list_filter(string_split_regex(translate(coalesce(text, ''), {_ASCII}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)
_DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS words FROM benchmark
), sized AS (SELECT *, least(len(words), 10) AS size FROM items WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sized)
), texts AS (SELECT doc_id, {_WORDS} AS words FROM documents
), places AS (
  SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS w FROM (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM texts, (SELECT DISTINCT size FROM windows))
), hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, w)
), spots AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN spots USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _pii_kind(name: str, pattern: str, confirmed: str, score: str = "1.0") -> str:
    """Spans of one kind: matches stand between the pieces that splitting leaves, so lengths add up to places."""
    return f"""
SELECT doc_id, '{name}' AS kind, i, ends - length(m) AS s, ends AS e FROM (
  SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS ends FROM (
    SELECT doc_id, i, found[i] AS m, gaps[i] AS gap,
      right(gaps[i], 40) || chr(10) || left(gaps[i + 1], 40) AS around
    FROM (
      SELECT doc_id, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS gaps FROM texts
      )
    )
  )
) WHERE {confirmed} AND {score} >= 0.6"""


def _sql_pii() -> str:
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    digit = f"CAST(substr(reverse({digits}), i + 1, 1) AS INTEGER)"
    luhn = (
        f"list_sum(list_transform(range(0, length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN {digit}"
        f" WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0"
    )
    plain = "replace(m, ' ', '')"
    values = (
        f"list_transform(string_split(substr({plain}, 5) || substr({plain}, 1, 4), ''),"
        " lambda c: instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1)"
    )
    mod97 = f"list_reduce({values}, lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1"
    octets = "len(list_filter(string_split(m, '.'), lambda p: CAST(p AS DOUBLE) > 255)) = 0"

    def near(base: float, more: float, words: str) -> str:
        pattern = "(?i)(?:^|[^a-z])(?:" + "|".join(words.split()) + ")(?:[^a-z]|$)"
        return f"({base} + CASE WHEN regexp_matches(around, '{pattern}') THEN {more} ELSE 0.0 END)"

    card = "[0-9](?:[ -]?[0-9])+"
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", octets),
        ("card", card, f"length({digits}) BETWEEN 16 AND 19 AND {luhn}"),
        ("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({digits}) BETWEEN 8 AND 15"),
        ("iban", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", mod97, near(0.8, 0.2, "iban account bank konto compte cuenta")),
        ("short_card", card, f"length({digits}) BETWEEN 13 AND 15 AND {luhn}",
         near(0.4, 0.4, "card visa amex credit karte carte tarjeta")),
        ("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "true", near(0.3, 0.5, "ssn social security tax")),
    )
    spans = " UNION ALL ".join(f"SELECT {n} AS place, * FROM ({_pii_kind(*kind)})" for n, kind in enumerate(kinds))
    count = lambda kind: f"count(kind) FILTER (WHERE kind = '{kind}') AS n_{kind}"
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s){}, '')"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), spans AS ({spans})
SELECT doc_id, {count("email")}, {count("ip")}, {count("card")}, {count("phone")},
  sha256({joined.format(" FILTER (WHERE place < 4)")}) AS base_sha256, {joined.format("")} AS spans
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


def llm_queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def llm_oracles() -> dict[str, str]:
    return {
        "op3_line_dedup": _LINE_DEDUP, "op4_pii": _sql_pii(), "op6_topk": _TOP_K,
        "op11_filter_audit": _FILTER_AUDIT, "op12_hard_negatives": _HARD_NEGATIVES, "op13_decontamination": _DECONTAMINATION,
    }
