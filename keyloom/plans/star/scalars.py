"""Scalar functions over the star tables and whole document texts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.dates import fiscal_month_order, fiscal_year, lenient_timestamp, local_date_text
from keyloom.functions.rules import fill_null_from_sibling, money, ratio
from keyloom.functions.schema import cast_to
from keyloom.functions.text import (
    bullets,
    capitalize,
    clean_digits,
    clean_email,
    clean_id,
    clean_value,
    norm,
    script_or,
    strip_unicode,
    upper_or,
)
from keyloom.plans.star.registry import query

LATIN_1_LETTERS = ("À", "ÿ")

# Every blank Unicode knows, for the SQL side.
SQL_BLANKS = "[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x{85}]"


@query(
    "X1_upper_trim_fallback",
    """
    SELECT p_partkey, upper(trim(CASE WHEN th IS NULL OR trim(th) = '' THEN en ELSE th END)) AS name FROM (
      SELECT p_partkey, p_name AS en, CASE p_type WHEN 'ECONOMY' THEN '  ' WHEN 'SMALL' THEN ' ' || p_brand || ' '
             WHEN 'PROMO' THEN NULL ELSE p_type END AS th FROM part)
    """,
)
def upper_fallback(t):
    kind = F.col("p_type")
    th = (
        F.when(kind == "ECONOMY", "  ")
        .when(kind == "SMALL", F.concat(F.lit(" "), "p_brand", F.lit(" ")))
        .when(kind != "PROMO", kind)
    )
    return t.part.select("p_partkey", upper_or(th, "p_name").alias("name"))


@query(
    "X2_capitalize",
    """
    SELECT p_partkey, upper(left(n, 1)) || lower(substr(n, 2)) AS name, upper(left(b, 1)) || lower(substr(b, 2)) AS brand
    FROM (SELECT p_partkey, nullif(p_name, 'blue bolt') AS n, upper(p_brand) || ' ' || p_type AS b FROM part)
    """,
)
def capitals(t):
    name = F.nullif(F.col("p_name"), F.lit("blue bolt"))
    brand = F.concat(F.upper("p_brand"), F.lit(" "), "p_type")
    return t.part.select("p_partkey", capitalize(name).alias("name"), capitalize(brand).alias("brand"))


@query(
    "X3_null_concat",
    "SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') || '-001-B' AS code FROM customer",
)
def null_concat(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return t.customer.select("c_custkey", F.concat(segment, F.lit("-001-B")).alias("code"))


@query(
    "X4_substring",
    "SELECT c_custkey, substr(c_name, 1, 4) AS head, left(c_name, 1) AS initial, length(c_name) AS n FROM customer",
)
def substrings(t):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 1, 4).alias("head"),
        F.left("c_name", F.lit(1)).alias("initial"),
        F.length("c_name").alias("n"),
    )


@query(
    "X5_clean_value",
    """
    SELECT doc_id, nullif(trim(translate(text, chr(160) || chr(9), '  ')), '') AS cleaned,
           coalesce(nullif(lang, 'fr'), source) AS tag FROM documents
    """,
)
def cleaned_values(t):
    tag = F.coalesce(F.nullif(F.col("lang"), F.lit("fr")), "source")
    return t.documents.select("doc_id", clean_value("text").alias("cleaned"), tag.alias("tag"))


@query(
    "X6_norm",
    """
    SELECT c_custkey, lower(coalesce(trim(translate(v, chr(160) || chr(9), '  ')), '')) AS v FROM (
      SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN chr(160) || c_name || chr(9) WHEN 'MACHINERY' THEN NULL
             WHEN 'FURNITURE' THEN chr(9) || chr(160) ELSE c_mktsegment END AS v FROM customer)
    """,
)
def normalized(t):
    segment = F.col("c_mktsegment")
    v = (
        F.when(segment == "BUILDING", F.concat(F.lit("\u00a0"), "c_name", F.lit("\t")))
        .when(segment == "FURNITURE", "\t\u00a0")
        .when(segment != "MACHINERY", segment)
    )
    return t.customer.select("c_custkey", norm(v).alias("v"))


@query(
    "X7_arithmetic",
    """
    SELECT l_returnflag, sum(abs(CAST(l_extendedprice AS DECIMAL(18,2)) - 40000)) AS distance,
           sum(CAST(l_quantity AS DECIMAL(18,2)) * 0.48) AS cost, count_if(abs(l_quantity - 25) > 10) AS far
    FROM lineitem GROUP BY 1
    """,
)
def arithmetic(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum(F.abs(money("l_extendedprice") - 40000)).alias("distance"),
        F.sum(money("l_quantity") * F.lit("0.48").cast("decimal(3,2)")).alias("cost"),
        F.count_if(F.abs(F.col("l_quantity") - 25) > 10).alias("far"),
    )


@query(
    "X8_buddhist_date",
    """
    SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%d/%m/') || (year(ts + INTERVAL 7 HOUR) + 543) AS thai,
           strftime(ts + INTERVAL 7 HOUR, '%d/%m/%Y') AS iso FROM events
    """,
)
def buddhist(t):
    return t.events.select("event_id", local_date_text("ts").alias("thai"), local_date_text("ts", "iso").alias("iso"))


@query(
    "X9_date_parts",
    """
    SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, year(ts) AS y, month(ts) AS m, count(*) AS events
    FROM events GROUP BY 1, 2, 3
    """,
)
def date_parts(t):
    day = F.to_date("ts")
    keys = [day.cast("string").alias("day"), F.year("ts").alias("y"), F.month("ts").alias("m")]
    return t.events.groupBy(*keys).agg(F.count("*").alias("events"))


@query(
    "X10_fiscal",
    """
    SELECT year(l_shipdate + INTERVAL 3 MONTH) AS fiscal_year, month(l_shipdate + INTERVAL 3 MONTH) AS fiscal_month,
           count(*) AS lines FROM lineitem GROUP BY 1, 2
    """,
)
def fiscal(t):
    keys = [fiscal_year("l_shipdate").alias("fiscal_year"), fiscal_month_order("l_shipdate").alias("fiscal_month")]
    return t.lineitem.groupBy(*keys).agg(F.count("*").alias("lines"))


@query(
    "X11_lenient_dates",
    """
    SELECT o_orderkey, strftime(coalesce(try_strptime(d, '%d/%m/%Y'), TRY_CAST(d AS TIMESTAMP)), '%Y-%m-%d') AS d FROM (
      SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 'P' THEN o_orderpriority
             ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
    """,
)
def lenient_dates(t):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(status == "P", F.col("o_orderpriority"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    parsed = lenient_timestamp(text, ["dd/MM/yyyy"])
    return t.orders.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("d"))


@query(
    "X12_casts",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS BIGINT) AS p_size,
           CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part
    """,
)
def strict_casts(t):
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.StringType()),
            T.StructField("p_size", T.LongType()),
            T.StructField("p_retailprice", T.DecimalType(18, 2)),
        ]
    )
    return cast_to(t.part, schema)


@query(
    "X12_lenient_casts",
    "SELECT TRY_CAST(p_brand AS BIGINT) AS p_brand, TRY_CAST(substr(p_brand, 7) AS BIGINT) AS p_number, count(*) AS n FROM part GROUP BY 1, 2",
)
def lenient_casts(t):
    schema = T.StructType([T.StructField("p_brand", T.LongType()), T.StructField("p_number", T.LongType())])
    numbered = t.part.select("p_brand", F.substring("p_brand", 7, 10).alias("p_number"))
    return cast_to(numbered, schema, strict=False).groupBy("p_brand", "p_number").agg(F.count("*").alias("n"))


@query(
    "X13_fill_constant",
    "SELECT event_id, coalesce(nullif(event_type, 'error'), 'N/A') AS grade FROM events",
)
def fill_constant(t):
    grade = F.nullif(F.col("event_type"), F.lit("error")).alias("grade")
    return t.events.select("event_id", grade).na.fill({"grade": "N/A"})


@query(
    "X14_clean_digits",
    """
    SELECT c_custkey, CASE WHEN regexp_full_match(v, '[0-9]+') THEN v END AS v FROM (
      SELECT c_custkey, regexp_replace(CASE c_mktsegment WHEN 'BUILDING' THEN ' 5' || c_custkey || ' 7' || chr(8203)
             WHEN 'MACHINERY' THEN chr(160) || c_custkey || chr(9) WHEN 'FURNITURE' THEN NULL ELSE c_name END,
             '[\\s\\x{A0}\\x{200B}]', '', 'g') AS v FROM customer)
    """,
)
def digits(t):
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    v = (
        F.when(segment == "BUILDING", F.concat(F.lit(" 5"), key, F.lit(" 7\u200b")))
        .when(segment == "MACHINERY", F.concat(F.lit("\u00a0"), key, F.lit("\t")))
        .when(segment != "FURNITURE", F.col("c_name"))
    )
    return t.customer.select("c_custkey", clean_digits(v).alias("v"))


@query(
    "X15_clean_id",
    """
    SELECT o_orderkey, CASE WHEN v IN ('', 'None', 'nan', 'NaT') THEN NULL ELSE v END AS v FROM (
      SELECT o_orderkey, regexp_replace(trim(CASE o_orderstatus WHEN 'F' THEN ' ' || o_orderkey || '.0' WHEN 'P' THEN 'nan '
             ELSE o_orderkey || '.05' END), '\\.0$', '') AS v FROM orders)
    """,
)
def ids(t):
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    v = (
        F.when(status == "F", F.concat(F.lit(" "), key, F.lit(".0")))
        .when(status == "P", "nan ")
        .otherwise(F.concat(key, F.lit(".05")))
    )
    return t.orders.select("o_orderkey", clean_id(v).alias("v"))


MAIL_SQL = """
    SELECT {key}, CASE WHEN lower(w) NOT IN ('none', 'null', 'nan')
                        AND regexp_full_match(m, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}') THEN m END AS mail
    FROM (SELECT {key}, w, trim(split_part(trim(split_part(trim(split_part(w, ',', 1)), ';', 1)), ' ', 1), '<>"''()[]') AS m
          FROM (SELECT {key}, trim({word}) AS w FROM {source}))
"""


@query(
    "X16_clean_email",
    MAIL_SQL.format(
        key="c_custkey",
        word="""CASE c_mktsegment WHEN 'BUILDING' THEN ' <c' || c_custkey || '@mail.example>; second@mail.example'
                WHEN 'MACHINERY' THEN 'NULL' WHEN 'FURNITURE' THEN 'a.b+' || c_custkey || '@x.org, other'
                WHEN 'AUTOMOBILE' THEN c_name ELSE 'c' || c_custkey || '@host' END""",
        source="customer",
    ),
)
def mails(t):
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    field = (
        F.when(segment == "BUILDING", F.concat(F.lit(" <c"), key, F.lit("@mail.example>; second@mail.example")))
        .when(segment == "MACHINERY", "NULL")
        .when(segment == "FURNITURE", F.concat(F.lit("a.b+"), key, F.lit("@x.org, other")))
        .when(segment == "AUTOMOBILE", F.col("c_name"))
        .otherwise(F.concat(F.lit("c"), key, F.lit("@host")))
    )
    return t.customer.select("c_custkey", clean_email(field).alias("mail"))


@query(
    "X16_document_mails",
    MAIL_SQL.format(
        key="doc_id",
        word="word",
        source="""(SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word
                   FROM documents) WHERE contains(word, '@'))""",
    ),
)
def document_mails(t):
    """Every word with an @ in the whole texts."""
    words = F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "))
    found = t.documents.select("doc_id", words.alias("word")).filter(F.contains("word", F.lit("@")))
    return found.select("doc_id", clean_email("word").alias("mail"))


@query(
    "X17_script_fallback",
    """
    SELECT doc_id, CASE WHEN regexp_matches(text, '[À-ÿ]') THEN text ELSE source END AS chosen FROM documents
    """,
)
def script(t):
    return t.documents.select("doc_id", script_or("text", "source", LATIN_1_LETTERS).alias("chosen"))


@query(
    "X18_bullets",
    f"""
    SELECT doc_id, nullif(array_to_string(list_filter(list_transform(
        string_split(replace(concat_ws(chr(10), '- ' || lang, coalesce(text, ''), '-', ' - ' || source), chr(13) || chr(10), chr(10)), chr(10)),
        lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^{SQL_BLANKS}+|{SQL_BLANKS}+$', '', 'g'), '^- ', ''),
                            '^{SQL_BLANKS}+|{SQL_BLANKS}+$', '', 'g')),
        lambda x: x NOT IN ('', '-')), ', '), '') AS items FROM documents
    """,
)
def bullet_texts(t):
    columns = [F.concat(F.lit("- "), "lang"), F.col("text"), F.lit("-"), F.concat(F.lit(" - "), "source")]
    return t.documents.select("doc_id", bullets(columns).alias("items"))


@query(
    "X18_bullets_unlimited",
    f"""
    SELECT conv_id, turn, nullif(array_to_string(list_filter(list_transform(
        string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)),
        lambda x: regexp_replace(regexp_replace(regexp_replace(x, '^{SQL_BLANKS}+|{SQL_BLANKS}+$', '', 'g'), '^- ', ''),
                            '^{SQL_BLANKS}+|{SQL_BLANKS}+$', '', 'g')),
        lambda x: x NOT IN ('', '-')), ', '), '') AS items FROM conversations
    """,
)
def conversation_items(t):
    return t.conversations.select("conv_id", "turn", bullets(["text"], limit=None).alias("items"))


@query(
    "X5_strip_unicode",
    f"""
    SELECT page_id, regexp_replace(html, '^{SQL_BLANKS}+|{SQL_BLANKS}+$', '', 'g') AS html,
           regexp_replace(chr(160) || chr(8195) || url || chr(10), '^{SQL_BLANKS}+|{SQL_BLANKS}+$', '', 'g') AS url FROM pages
    """,
)
def stripped(t):
    padded = F.concat(F.lit("\u00a0\u2003"), "url", F.lit("\n"))
    return t.pages.select("page_id", strip_unicode("html").alias("html"), strip_unicode(padded).alias("url"))


@query(
    "X21_fill_from_sibling",
    "SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN ' ' WHEN 'O' THEN 'open' END, o_orderpriority) AS studentstatus FROM orders",
)
def sibling(t):
    status = F.when(F.col("o_orderstatus") == "F", " ").when(F.col("o_orderstatus") == "O", "open")
    df = t.orders.select("o_orderkey", status.alias("studentstatus"), F.col("o_orderpriority").alias("statusname"))
    return fill_null_from_sibling(df, "studentstatus", "statusname")


@query(
    "X23_rounded_ratio",
    """
    SELECT o_custkey, round(coalesce(CAST(count_if(o_orderstatus = 'F') AS DOUBLE) / nullif(count_if(o_orderstatus <> 'P'), 0), 0), 4) AS share
    FROM orders GROUP BY 1
    """,
)
def rounded(t):
    status = F.col("o_orderstatus")
    counts = t.orders.groupBy("o_custkey").agg(
        F.count_if(status == "F").alias("finished"), F.count_if(status != "P").alias("known")
    )
    return counts.select("o_custkey", ratio("finished", "known").alias("share"))
