"""Inputs of the jobs, derived from the given tables.

Every document-shaped input is made inside the row of its source table: nothing is grouped, so no key,
source or set of copies can pile up in one task. Damage is spread by the remainder of ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docloom.schemas import COVERAGE_TYPES
from docloom.sources.tables import spread

LINES_PER_PAGE = 5

# Response shapes by ``doc_id % 12``.
(CLEAN, FENCED, WRAPPED, CUT_LENGTH, CUT_IN_STRING, CUT_STOPPED, NO_CHOICES,
 EXTRA_KEYS, PARTS, OUTPUT_TEXT, CUT_MAX_TOKENS, CUT_FULL_BUDGET) = range(12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with file name, path and lines."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return spread(table(spark, sf_dir, "documents").select(*columns)).select(
        "doc_id", "lang", "source", "n_chars", "text",
        name.alias("file_name"),
        F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), name).alias("file_path"),
        F.split("text", "\n").alias("lines"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing with one entry per document and four kinds of ending."""
    ending = F.element_at(
        F.array(F.lit(".pdf"), F.lit(".PDF"), F.lit(".Pdf"), F.lit(".txt")), (F.col("doc_id") % 4 + 1).cast("int")
    )
    path = F.concat(F.lit("dbfs:/corpus/"), F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), ending)
    return table(spark, sf_dir, "documents").select(path.alias("path"), F.col("n_chars").alias("length"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/corpus/"), F.col("source"), F.lit("/"), name).alias("path"), F.col("n_chars").alias("length"),
        F.lit(1).alias("modified"), F.coalesce("text", F.lit("")).alias("text"), (F.col("doc_id") % 10).alias("fate"), name.alias("name"),
    )


def saved_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine of ten documents as an earlier run saw them."""
    return _listed(spark, sf_dir).filter("fate <> 9").select("path", "length", "modified", F.sha2("text", 256).alias("digest"))


def listing_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files as they are now, with digests: some touched (5), rewritten (6), moved (7), gone (8) and new (9)."""
    text = F.when(F.col("fate") == 6, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return _listed(spark, sf_dir).filter("fate <> 8").select(
        F.when(F.col("fate") == 7, F.concat(F.lit("/moved/"), F.col("name"))).otherwise(F.col("path")).alias("path"),
        "length", F.when(F.col("fate").isin(5, 6), F.lit(2)).otherwise(F.col("modified")).alias("modified"), F.sha2(text, 256).alias("digest"),
    )


def page_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as arrays of pages of five lines; some pages and some documents could not be read."""
    starts = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / LINES_PER_PAGE).cast("int"))

    def page(number: Column) -> Column:
        text = F.array_join(F.slice("lines", number * LINES_PER_PAGE + 1, LINES_PER_PAGE), "\n")
        return F.struct(
            F.when(number % 9 != 8, text).alias("page_text"),
            F.when((number % 9 == 7) & (F.col("doc_id") % 3 == 0), F.lit("unreadable")).alias("error"),
        )

    return documents(spark, sf_dir).select(
        "doc_id", "file_name", "file_path",
        F.transform(starts, page).alias("pages"),
        F.when(F.col("doc_id") % 50 == 49, F.lit("damaged file")).alias("error"),
    )


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each page, and for each document that could not be read one row without a page number."""
    readable = F.when(F.col("error").isNull(), F.col("pages"))
    rows = page_arrays(spark, sf_dir).select("file_name", "file_path", "error", F.posexplode_outer(readable).alias("pos", "page"))
    return rows.select(
        "file_name", "file_path", (F.col("pos") + 1).alias("page_no"), "page.page_text",
        F.coalesce("page.error", "error").alias("error"),
    )


def parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parser output per document: an element per line, page ids from zero, a few failures."""

    def element(line: Column, i: Column) -> Column:
        kind = F.when(i == 0, F.lit("title")).when(i % 7 == 6, F.lit(" Page_Footer ")).otherwise(F.lit("text"))
        box = F.struct(F.floor(i / LINES_PER_PAGE).alias("page_id"))
        return F.to_json(F.struct(kind.alias("type"), line.alias("content"), F.array(box).alias("bbox")))

    elements = F.array_join(F.transform("lines", element), ",")
    whole = F.concat(F.lit('{"document":{"elements":['), elements, F.lit(',5,null]},"error_status":[]}'))
    fate = F.col("doc_id") % 50
    parsed = (
        F.when(fate == 46, F.lit('{"error_status":"E46"}'))
        .when(fate == 47, F.lit(None))
        .when(fate == 48, F.lit("not json"))
        .otherwise(whole)
    )
    return documents(spark, sf_dir).select("file_name", "file_path", parsed.alias("parsed_doc_json"))


_COVERAGE_TYPES = "array(" + ", ".join(f"'{kind}'" for kind in COVERAGE_TYPES) + ")"
_POLICY = """
    'policy_number', concat('PN-', doc_id), 'carrier', source, 'named_insured', concat('Insured ', lang),
    'effective_date', '2025-01-01', 'expiration_date', '2026-01-01',
    'policy_type', if(doc_id % 3 = 0, 'Primary', 'Excess'),
    'claims_made_or_occurrence', if(doc_id % 4 <> 0, 'Occurrence', NULL),
    'confidence', n_chars % 101 / 100.0D, 'page_reference', array(1)"""
_COVERAGES = f"""transform(lines, (line, i) -> named_struct(
    'coverage_name', if(i % 11 <> 10, line, NULL), 'coverage_section', lang,
    'coverage_type', element_at({_COVERAGE_TYPES}, i % 6 + 1),
    'limit_amount', length(line) * 1000.0D,
    'aggregate_limit', if(i % 2 = 0, length(line) * 2000.0D, NULL),
    'deductible_or_retention', if(i % 3 = 0, length(line) * 10.0D, NULL),
    'is_sublimit', i % 6 = 1, 'confidence', length(line) % 101 / 100.0D,
    'page_reference', array(i div {LINES_PER_PAGE} + 1)))"""


def _exposure(kind: str, value: str) -> str:
    return f"""named_struct('exposure_type', '{kind}', 'exposure_value', double({value}), 'basis', 'document',
        'confidence', 0.5D, 'page_reference', array(1))"""


def _message(content: str, finish: str, tokens: int) -> str:
    choice = f"named_struct('finish_reason', '{finish}', 'message', named_struct('content', {content}))"
    return f"to_json(named_struct('choices', array({choice}), 'usage', named_struct('completion_tokens', {tokens})))"


_CUT = f"shape IN ({CUT_LENGTH}, {CUT_IN_STRING}, {CUT_STOPPED}, {CUT_MAX_TOKENS}, {CUT_FULL_BUDGET})"
_CONTENT = f"""CASE
    WHEN shape = {FENCED} THEN concat('```json\\n', head, body, tail, '\\n```')
    WHEN shape = {WRAPPED} THEN concat('The result:\\n', head, body, tail, '\\nThat is all.')
    WHEN shape = {CUT_IN_STRING} THEN concat(head, '"coverages":[{{"coverage_name":"cut of')
    WHEN {_CUT} THEN concat(head, body, ',')
    WHEN shape = {EXTRA_KEYS} THEN concat('{{"notes":["none"],', substr(head, 2), body, tail)
    WHEN shape <> {PARTS} THEN concat(head, body, tail) END"""
_PARTS = "array(named_struct('type', 'text', 'text', head), named_struct('type', 'text', 'text', concat(body, tail)))"
_RESPONSE = f"""CASE
    WHEN shape = {NO_CHOICES} THEN '{{"error": "no capacity"}}'
    WHEN shape = {OUTPUT_TEXT} THEN to_json(named_struct('output_text', content))
    WHEN shape = {PARTS} THEN {_message(_PARTS, "stop", 900)}
    WHEN shape IN ({CUT_LENGTH}, {CUT_IN_STRING}) THEN {_message("content", "length", 16000)}
    WHEN shape = {CUT_MAX_TOKENS} THEN {_message("content", "max_tokens", 900)}
    WHEN shape = {CUT_FULL_BUDGET} THEN {_message("content", "stop", 15900)}
    ELSE {_message("content", "stop", 900)} END"""


def stored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored model response per document, in twelve clean and damaged shapes.

    The coverages are the lines of the document, so the JSON grows with the whole text.
    """
    kept = ["file_name", "file_path", "n_chars", "shape"]
    return (
        documents(spark, sf_dir)
        .withColumn("shape", F.expr("int(doc_id % 12)"))
        .selectExpr(
            *kept,
            f"""if(shape = {EXTRA_KEYS}, to_json(named_struct({_POLICY}, 'remark', 'kept apart')),
                   to_json(named_struct({_POLICY}))) AS policy""",
            f"""if(doc_id % 5 = 0, array(),
                   array({_exposure("characters", "n_chars")}, {_exposure("lines", "size(lines)")})) AS exposures""",
            f"{_COVERAGES} AS items",
        )
        .selectExpr(
            *kept,
            """concat('{"policy":', policy, ',') AS head""",
            f"""concat('"coverages":', if({_CUT}, concat('[', to_json(items[0])), to_json(items))) AS body""",
            """concat(',"exposures":', to_json(exposures), '}') AS tail""",
        )
        .selectExpr("*", f"{_CONTENT} AS content")
        .selectExpr(
            "file_name", "file_path", "shape + 1 AS page_count", "n_chars AS request_chars", f"{_RESPONSE} AS response_json",
            "string(NULL) AS call_error", "shape",
        )
    )


# Shapes of ``odd_responses`` by ``doc_id % 8``.
(ODD_PLAIN, ODD_NAN_TOKENS, ODD_REPEATED, ODD_TRAILING, ODD_CALL_ERROR, ODD_INFINITE, ODD_NAN_CONTENT, ODD_CUT) = range(8)


def odd_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses whose JSON only Python's rules settle; the content names the document and its text's digest."""
    content = F.concat(
        F.lit('{\\"policy\\":{\\"policy_number\\":\\"PN-'), F.col("doc_id").cast("string"),
        F.lit('\\",\\"carrier\\":\\"'), F.sha2("text", 256), F.lit('\\"}}'),
    )
    shape = F.col("doc_id") % 8
    message = F.when(shape == ODD_NAN_CONTENT, F.lit("NaN")).otherwise(F.concat(F.lit('"'), content, F.lit('"')))
    choices = F.concat(F.lit('"choices":[{"finish_reason":"stop","message":{"content":'), message, F.lit("}}]"))
    used = F.when(shape == ODD_NAN_TOKENS, "NaN").when(shape == ODD_INFINITE, "Infinity").otherwise("9")
    whole = F.concat(
        F.lit("{"), F.when(shape == ODD_REPEATED, '"choices":[],').otherwise(""), choices, F.lit(',"usage":{"completion_tokens":'), used, F.lit("}}"),
        F.when(shape == ODD_TRAILING, " and more").otherwise(""),
    )
    response = F.when(shape == ODD_CUT, F.expr("substr(whole, 1, length(whole) - 1)")).when(shape != ODD_CALL_ERROR, F.col("whole"))
    return documents(spark, sf_dir).withColumn("whole", whole).select(
        "file_name", "file_path", F.lit(1).alias("page_count"), F.col("n_chars").alias("request_chars"), response.alias("response_json"),
        F.when(shape == ODD_CALL_ERROR, F.lit("no capacity")).alias("call_error"),
    )


def _order_file(key: str) -> list[Column]:
    name = F.concat(F.lit("policy_"), F.col(key).cast("string"), F.lit(".pdf"))
    folder = (F.col(key) % 16).cast("string")
    return [name.alias("file_name"), F.concat(F.lit("/orders/"), folder, F.lit("/"), name).alias("file_path")]


def policy_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy row per order."""
    return table(spark, sf_dir, "orders").select(
        *_order_file("o_orderkey"),
        F.col("o_orderkey").cast("string").alias("policy_number"),
        F.concat(F.lit("Carrier "), F.col("o_orderstatus")).alias("carrier"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("named_insured"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_date"),
        F.when(
            F.col("o_orderkey") % 40 != 0,
            F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 12), "yyyy-MM-dd"),
        ).otherwise(F.lit("on cancellation")).alias("expiration_date"),
        F.col("o_orderpriority").alias("policy_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Claims-Made"))
        .when(F.col("o_orderstatus") == "O", F.lit("occurrence based"))
        .alias("claims_made_or_occurrence"),
        (F.col("o_orderkey") % 101 / 100.0).alias("policy_confidence"),
        F.array((F.col("o_orderkey") % 9).cast("int")).alias("policy_page_reference"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("page_count"),
    )


def coverage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coverage row per order line, with the order's name and path; some have no name."""
    return table(spark, sf_dir, "lineitem").select(
        *_order_file("l_orderkey"),
        F.when(F.col("l_linenumber") != 5, F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))).alias("coverage_name"),
        F.col("l_returnflag").alias("coverage_section"),
        F.col("l_extendedprice").alias("limit_amount"),
        F.when(F.col("l_returnflag") == "N", F.col("l_extendedprice") * 2).alias("aggregate_limit"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") * 100).alias("deductible_or_retention"),
        (F.col("l_returnflag") == "R").alias("is_sublimit"),
        F.col("l_tax").alias("coverage_confidence"),
        F.array(F.col("l_linenumber")).alias("coverage_page_reference"),
    )


def dated_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loss per order, up to 500 days after it, of the order's customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loss_id"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("insured"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 501).cast("int")).alias("day"),
    )


def coverage_table_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverages as a later run found them: by order, some are missing, have another limit, or show twice."""
    key = F.regexp_extract("file_name", "[0-9]+", 0).cast("long") % 10
    times = F.when(key == 1, 0).when(key == 3, 2).otherwise(1)
    rows = coverage_table(spark, sf_dir).withColumn("time", F.explode(F.array_repeat(F.lit(1), times))).drop("time")
    return rows.withColumn("limit_amount", F.when(key == 2, F.col("limit_amount") + 1).otherwise(F.col("limit_amount")))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header record per order, some without a name or with a policy type outside the enumeration."""
    kind = F.element_at(
        F.array(*map(F.lit, ("primary", "excess", "cyber", "unknown", "marine"))),
        F.substring("o_orderpriority", 1, 1).cast("int"),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("policy_id"),
        *_order_file("o_orderkey")[:1],
        F.concat(F.lit("Carrier "), F.col("o_orderstatus")).alias("carrier"),
        F.when(F.col("o_custkey") % 20 != 0, F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))).alias("named_insured"),
        F.col("o_orderkey").cast("string").alias("policy_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_date"),
        F.lit(None).cast("string").alias("expiration_date"),
        kind.alias("policy_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("claims-made")).when(F.col("o_orderstatus") == "O", F.lit("occurrence")).alias("claims_made_or_occurrence"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("page_count"),
        F.lit("mock").alias("model_used"),
        F.lit("2026-01-01T00:00:00").alias("processed_at"),
        F.col("o_orderpriority").alias("declarations_source_text"),
    )


def _element_id() -> Column:
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("-", *[F.col(key).cast("string") for key in keys])


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coverage element per order line."""
    section = F.when(F.col("l_linestatus") == "F", F.lit("coverage")).when(F.col("l_linenumber") < 7, F.lit("endorsement")).otherwise(F.lit("annex"))
    return table(spark, sf_dir, "lineitem").select(
        _element_id().alias("element_id"),
        F.col("l_orderkey").cast("string").alias("policy_id"),
        F.when(F.col("l_linenumber") != 5, F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))).alias("coverage_name"),
        F.col("l_returnflag").alias("coverage_section"),
        F.when(F.col("l_quantity") > 5, F.col("l_extendedprice")).alias("limit_amount"),
        F.when(F.col("l_returnflag") == "N", F.col("l_extendedprice") * 2).alias("aggregate_limit"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") * 100).alias("deductible_or_retention"),
        F.when(F.col("l_returnflag") == "R", F.lit(True)).alias("is_sublimit"),
        F.when(F.col("l_quantity") <= 5, F.lit("INHERIT_AGGREGATE")).alias("included_state"),
        F.col("l_tax").alias("confidence"),
        section.alias("section_type"),
    )


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A citation per order line; some passages are empty or short."""
    passage = F.when(F.col("l_quantity") == 1, F.lit("")).otherwise(
        F.concat(F.lit("Limit of insurance for part "), F.col("l_partkey").cast("string"), F.lit(" as scheduled with supplier "), F.col("l_suppkey").cast("string"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("C-"), _element_id()).alias("citation_id"),
        _element_id().alias("element_id"),
        F.col("l_linenumber").alias("page_number"),
        F.col("l_returnflag").alias("section"),
        passage.alias("passage"),
    )


def textual_coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverages whose amounts are text, in nine wordings by ``l_partkey % 9``."""
    wording = F.col("l_partkey") % 9
    count, line = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string")
    price = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    limit = (
        F.when(wording == 1, F.concat(F.lit("$"), count, F.lit("M xs $"), line, F.lit("M")))
        .when(wording == 5, F.lit("Included"))
        .when(wording == 7, F.concat(count, F.lit("K excess of "), line, F.lit("K")))
        .when(wording == 8, F.lit("see schedule"))
        .when(wording == 2, F.concat(F.lit("USD "), count, F.lit(".5 million")))
        .when(wording == 3, F.concat(F.lit("$"), count, F.lit("MM")))
        .otherwise(price)
    )
    deductible = (
        F.when(wording == 2, F.concat(count, F.lit(" hours")))
        .when(wording == 3, F.concat(count, F.lit(" days")))
        .when(wording == 4, F.lit("5%"))
        .when(wording == 6, F.concat(F.lit("2% subject to $"), F.format_number(F.col("l_quantity") * 1000, 0), F.lit(" minimum")))
        .when(wording == 8, F.concat(F.lit("$ "), count, F.lit(",000")))
        .when(wording == 7, F.concat(count, F.lit(",000 USD")))
        .when(wording == 5, F.lit("30 days waiting"))
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return spread(lines).select(
        *_order_file("l_orderkey"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("coverage_name"),
        limit.alias("limit_text"),
        F.when(F.col("l_returnflag") == "N", price).alias("aggregate_text"),
        deductible.alias("deductible_text"),
        F.element_at(F.array(*map(F.lit, COVERAGE_TYPES)), F.col("l_linenumber") % 6 + 1).alias("coverage_type"),
    )
