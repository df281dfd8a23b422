"""Registered column-wise jobs; each runs over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.catalog.sql import money
from ledgerlark.functions import exact_sum
from ledgerlark.jobs import scalars
from ledgerlark.operators.settle import scratch_path
from ledgerlark.sources import table


def text_normalise(spark, sf_dir):
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "'  ' || p_name || ' o''neil-' || p_brand || '  ' AS name"
    )
    return scalars.text_normalise(parts, "p_partkey", "name")


def text_search_replace(spark, sf_dir):
    return scalars.text_search_replace(table(spark, sf_dir, "pages"), "page_id", "url")


def number_math(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "*",
        "CASE WHEN o_orderkey % 13 = 0 THEN double('NaN') WHEN o_orderkey % 17 = 0 THEN double('Infinity') "
        "WHEN o_orderkey % 19 = 0 THEN double('-Infinity') ELSE o_totalprice END AS measure",
    )
    return scalars.number_math(orders, "o_orderkey", "o_totalprice", "measure")


def text_classes(spark, sf_dir):
    """Texts of all kinds made from the parts: words, brands, blanks, digits, other scripts."""
    texts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """CASE p_partkey % 8 WHEN 0 THEN replace(p_name, ' ', '') WHEN 1 THEN p_brand WHEN 2 THEN '  '
                WHEN 3 THEN string(p_size) WHEN 4 THEN upper(p_name) WHEN 5 THEN 'é' || replace(p_name, ' ', 'ü')
                WHEN 6 THEN replace(p_name, ' ', '7') ELSE '' END AS t""",
    )
    return scalars.text_classes(texts, "p_partkey", "t")


def text_pieces(spark, sf_dir):
    return scalars.text_pieces(table(spark, sf_dir, "documents"), "doc_id", "text")


def nested_documents(spark, sf_dir):
    """Events as nested documents, written as VARIANT, read back and asked by path."""
    path = scratch_path(spark)
    table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """parse_json('{"user":{"id":' || user_id || ',"settings":'
           || CASE event_type WHEN 'click' THEN '{"theme":"dark"}' WHEN 'view' THEN '{"theme":null}'
                              WHEN 'error' THEN 'null' ELSE '{}' END
           || '},"seen":[' || event_id % 3 || ',' || user_id || ']}') AS document""",
        "parse_json(props) AS props",
    ).write.parquet(path)
    read = spark.read.parquet(path)
    return scalars.nested_values(read, "event_id", "document", {
        "user_id": ("$.user.id", "bigint", "-1"),
        "theme": ("$.user.settings.theme", "string", "'light'"),
        "admin_theme": ("$.admin.settings.theme", "string", "'none'"),
        "second_seen": ("$.seen[1]", "bigint", "-1"),
        "third_seen": ("$.seen[2]", "bigint", "event_id"),
        "first_as_text": ("$.seen[0]", "string", "''"),
        "k": ("$.k", "int", "try_variant_get(props, '$.k', 'int')"),
    })


def date_parts(spark, sf_dir):
    return scalars.date_parts(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")


def array_map_ops(spark, sf_dir):
    return scalars.array_map_ops(table(spark, sf_dir, "part"), "p_partkey", "p_name")


def json_roundtrip(spark, sf_dir):
    return scalars.json_roundtrip(table(spark, sf_dir, "events"))


def balances_by_segment_kind(spark, sf_dir):
    """One text form for home segments, another for foreign ones, none for the rest."""
    balances = (
        table(spark, sf_dir, "customer")
        .groupBy("c_mktsegment")
        .agg(exact_sum("c_acctbal").alias("balance"))
        .withColumn(
            "kind",
            F.expr(
                "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'domestic' "
                "WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'international' END"
            ),
        )
    )
    return scalars.formatted_by_kind(balances, "c_mktsegment", "balance", "kind")


QUERIES = {
    f.__name__: f
    for f in (
        text_normalise,
        text_search_replace,
        text_classes,
        text_pieces,
        nested_documents,
        number_math,
        date_parts,
        array_map_ops,
        json_roundtrip,
        balances_by_segment_kind,
    )
}

_T = "t.name"
_TITLE = (
    "array_to_string(list_transform(regexp_extract_all(t.name, '([A-Za-z]+|[^A-Za-z]+)'), "
    "lambda x: upper(x[1:1]) || lower(x[2:])), '')"
)
_W = "string_split(p_name, ' ')"

ORACLE = {
    "text_normalise": f"""
SELECT p_partkey, upper({_T}) AS upper_text, lower({_T}) AS lower_text, {_TITLE} AS title,
  upper(left({_T}, 1)) || lower(substr({_T}, 2)) AS capitalized,
  translate({_T}, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz') AS swapped,
  trim({_T}) AS stripped, ltrim({_T}) AS left_stripped, rtrim({_T}) AS right_stripped,
  trim({_T}, ' #0123456789') AS custom_stripped,
  CASE WHEN length({_T}) < 24 THEN rpad({_T}, 24, '.') ELSE {_T} END AS padded,
  CASE WHEN length({_T}) < 24 THEN lpad({_T}, 24, '.') ELSE {_T} END AS right_justified,
  CASE WHEN length({_T}) < 24
       THEN repeat('*', (24 - length({_T})) // 2) || {_T} || repeat('*', 24 - length({_T}) - (24 - length({_T})) // 2)
       ELSE {_T} END AS centred,
  CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0')
       ELSE CAST(p_partkey AS VARCHAR) END AS zero_filled,
  hex(encode(trim({_T}))) AS encoded, true AS decodes_back,
  coalesce(nullif(trim(regexp_replace({_T}, '[^0-9]', '', 'g')), ''), 'Anonymous') AS digits_or_default
FROM (SELECT p_partkey, '  ' || p_name || ' o''neil-' || p_brand || '  ' AS name FROM part) t""",
    "text_search_replace": """
SELECT page_id, CAST(instr(url, '/') - 1 AS INT) AS first_slash,
  CAST(length(url) - instr(reverse(url), '/') AS INT) AS last_slash,
  CAST(length(url) - length(replace(url, '/', '')) AS INT) AS slashes,
  starts_with(url, 'https') AS is_secure, suffix(url, 'html') AS ends_in_html, contains(url, 'example') AS has_example,
  replace(url, '/', '|') AS replaced_all,
  regexp_replace(regexp_replace(url, '/', '|'), '/', '|') AS replaced_two,
  regexp_replace(url, '[0-9]', '#', 'g') AS masked,
  array_to_string(regexp_extract_all(url, '[0-9]+'), ',') AS numbers,
  regexp_extract(url, '^(https?)://', 1) AS scheme, string_split(url, '/')[3] AS host,
  string_split(url, '/')[-1] AS last_part, CAST(len(string_split(url, '/')) AS INT) AS parts,
  regexp_full_match(string_split(url, '/')[3], '[A-Za-z]+') AS host_is_letters,
  regexp_full_match(string_split(url, '/')[-1], '[0-9]+') AS last_is_digits
FROM pages""",
    "number_math": """
SELECT o_orderkey, abs(o_totalprice - 250000) AS distance, pow(o_orderkey % 7, 2) AS squared,
  CAST(floor((o_orderkey - 5000) / 7) AS BIGINT) AS floor_quotient,
  ((o_orderkey - 5000) % 7 + 7) % 7 AS floor_remainder,
  round_even(o_totalprice / 1000, 0) AS thousands, CAST(ceil(o_totalprice / 1000) AS BIGINT) AS thousands_up,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands_down,
  CAST(trunc((o_totalprice - 250000) / 1000) AS BIGINT) AS thousands_cut,
  round(sqrt(o_totalprice), 6) AS root, round(ln(o_totalprice + 1), 6) AS log_e,
  round(log10(o_totalprice + 1), 6) AS log_10, round(log2(o_totalprice + 1), 6) AS log_2,
  round(degrees(atan2(o_orderkey % 7, 3)), 6) AS angle, round(sin(radians(o_orderkey % 360)), 6) AS sine,
  round(sqrt(o_totalprice * o_totalprice + 1000000.0), 4) AS hypotenuse,
  CAST(factorial(CAST(o_orderkey % 10 AS INT)) AS BIGINT) AS factorials,
  isnan(measure) OR isinf(measure) AS not_finite,
  CASE WHEN isfinite(measure) THEN measure END AS finite_or_null,
  greatest(o_orderkey % 5, o_orderkey % 7, 3) AS largest,
  bin(o_orderkey) AS binary_text, hex(o_orderkey) AS hex_text, CAST(o_orderkey AS VARCHAR) AS back_to_decimal,
  CAST(65 + o_orderkey % 26 AS INT) AS code_point, chr(CAST(65 + o_orderkey % 26 AS INT)) AS letter,
  format('{:,.2f}', o_totalprice) AS formatted,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS parsed
FROM (SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN 'nan'::DOUBLE WHEN o_orderkey % 17 = 0 THEN 'inf'::DOUBLE
                     WHEN o_orderkey % 19 = 0 THEN '-inf'::DOUBLE ELSE o_totalprice END AS measure FROM orders)""",
    "text_classes": r"""
SELECT p_partkey, regexp_matches(t, '^\p{L}+$') AS is_letters, regexp_matches(t, '^[0-9]+$') AS is_digits,
  regexp_matches(t, '^[\p{L}\p{N}]+$') AS is_letters_or_digits, length(t) > 0 AND trim(t) = '' AS is_blank,
  t = upper(t) AND t <> lower(t) AS is_upper, t = lower(t) AND t <> upper(t) AS is_lower
FROM (SELECT p_partkey,
    CASE p_partkey % 8 WHEN 0 THEN replace(p_name, ' ', '') WHEN 1 THEN p_brand WHEN 2 THEN '  '
         WHEN 3 THEN CAST(p_size AS VARCHAR) WHEN 4 THEN upper(p_name) WHEN 5 THEN 'é' || replace(p_name, ' ', 'ü')
         WHEN 6 THEN replace(p_name, ' ', '7') ELSE '' END AS t
  FROM part)""",
    "text_pieces": r"""
SELECT doc_id, CAST(len(l) AS INT) AS n_lines, CAST(len(p) AS INT) AS n_pieces,
  CAST(list_max(list_transform(l, lambda x: length(x))) AS INT) AS longest_line,
  p[1] AS first_piece, sha256(array_to_string(p, ' ')) AS joined_sha256
FROM (SELECT doc_id,
    CASE WHEN text = '' THEN [] ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') END AS l,
    list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS p
  FROM documents)""",
    "nested_documents": """
SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN 'dark' ELSE 'light' END AS theme, 'none' AS admin_theme,
  user_id AS second_seen, event_id AS third_seen, CAST(event_id % 3 AS VARCHAR) AS first_as_text,
  CAST(json_extract(props, '$.k') AS INT) AS k
FROM events""",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(day(o_orderdate) AS INT) AS day, CAST(isodow(o_orderdate) - 1 AS INT) AS weekday,
  strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%B %d, %Y') AS long_text,
  CAST(o_orderdate AS DATE) AS parsed_back, CAST(o_orderdate AS DATE) + 30 AS in_thirty_days,
  CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INT) AS days_since_start,
  CAST(o_orderdate AS DATE) + 7 > last_day(o_orderdate) AS in_last_week
FROM orders""",
    "array_map_ops": f"""
SELECT p_partkey, upper(p_name) AS upper_words, array_to_string(list_reverse(w), ' ') AS reversed_words,
  array_to_string(list_filter(w, lambda x: length(x) > 4), ' ') AS long_words,
  list_contains(w, 'red') AS has_red,
  CAST(length(w[1]) + length(w[2]) AS INT) AS total_length,
  CAST(greatest(length(w[1]), length(w[2])) AS INT) AS reduced_max,
  p_name || ' end' AS flattened, w[1] AS every_second,
  w[1] || ':' || length(w[1]) AS zipped,
  array_to_string(list_filter([CASE WHEN w[1] LIKE 'b%' THEN '0' END, CASE WHEN w[2] LIKE 'b%' THEN '1' END],
                              lambda x: x IS NOT NULL), ',') AS positions_of_b,
  CAST(greatest(length(w[1]), length(w[2]), 5) AS INT) AS max_of_lists,
  length(w[1]) || ',2' AS first_column,
  CASE WHEN list_contains(w, 'red') THEN 3 ELSE 0 END AS red_or_zero,
  CAST(CASE WHEN list_contains(w, 'red') THEN length('red') END AS INT) AS nested_value, w[1] AS inverted,
  CAST(length(p_name) + CASE WHEN list_contains(w, 'red') THEN length('red') ELSE 0 END AS INT) AS merged_red,
  CASE WHEN w[1] = w[2] THEN w[1]
       WHEN length(w[1]) < length(w[2]) OR (length(w[1]) = length(w[2]) AND w[1] < w[2]) THEN w[1] || ' ' || w[2]
       ELSE w[2] || ' ' || w[1] END AS by_length
FROM (SELECT p_partkey, p_name, {_W} AS w FROM part)""",
    "json_roundtrip": """
SELECT event_id, k, coalesce(k * 2, 0) AS twice,
  '{"user_id":' || user_id || ',"event_type":"' || event_type || '","props":{"k":' || k || '}}' AS record
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)""",
    "balances_by_segment_kind": f"""
SELECT c_mktsegment,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
       THEN c_mktsegment || ' (domestic): $' || format('{{:,.2f}}', {money('c_acctbal')})
       WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')
       THEN c_mktsegment || ' (international): $' || format('{{:,.2f}}', {money('c_acctbal')}) || ' USD' END AS line
FROM customer GROUP BY 1""",
}
