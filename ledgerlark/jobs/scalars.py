"""Column-wise text, number, date, array and JSON work as table jobs.

Each job is one projection of built-in expressions over a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions import title_case

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_normalise(frame: DataFrame, key: str, text: str) -> DataFrame:
    """Case, trimming, padding, encoding and a default for empty text."""
    return frame.withColumn("title", title_case(text)).selectExpr(
        key,
        f"upper({text}) AS upper_text",
        f"lower({text}) AS lower_text",
        "title",
        f"upper(left({text}, 1)) || lower(substr({text}, 2)) AS capitalized",
        f"translate({text}, '{_LOWER}{_UPPER}', '{_UPPER}{_LOWER}') AS swapped",
        f"trim({text}) AS stripped",
        f"ltrim({text}) AS left_stripped",
        f"rtrim({text}) AS right_stripped",
        f"trim(BOTH ' #0123456789' FROM {text}) AS custom_stripped",
        # Padding never shortens: longer text stays as it is.
        f"IF(length({text}) < 24, rpad({text}, 24, '.'), {text}) AS padded",
        f"IF(length({text}) < 24, lpad({text}, 24, '.'), {text}) AS right_justified",
        # An odd number of blanks leaves the larger half on the right.
        f"IF(length({text}) < 24, rpad(lpad({text}, int(12 + floor(length({text}) / 2)), '*'), 24, '*'), {text})"
        " AS centred",
        f"IF(length({key}) < 6, lpad(string({key}), 6, '0'), string({key})) AS zero_filled",
        f"hex(encode(trim({text}), 'UTF-8')) AS encoded",
        f"decode(encode({text}, 'UTF-8'), 'UTF-8') = {text} AS decodes_back",
        f"coalesce(nullif(trim(regexp_replace({text}, '[^0-9]', '')), ''), 'Anonymous') AS digits_or_default",
    )


def text_search_replace(frame: DataFrame, key: str, text: str) -> DataFrame:
    """Finding, counting, splitting, replacing and pattern checks; positions from 0."""
    return frame.selectExpr(
        key,
        f"instr({text}, '/') - 1 AS first_slash",
        f"length({text}) - instr(reverse({text}), '/') AS last_slash",
        f"regexp_count({text}, '/') AS slashes",
        f"startswith({text}, 'https') AS is_secure",
        f"endswith({text}, 'html') AS ends_in_html",
        f"contains({text}, 'example') AS has_example",
        f"replace({text}, '/', '|') AS replaced_all",
        f"array_join(split({text}, '/', 3), '|') AS replaced_two",
        f"regexp_replace({text}, '[0-9]', '#') AS masked",
        f"array_join(regexp_extract_all({text}, '([0-9]+)', 1), ',') AS numbers",
        f"regexp_extract({text}, '^(https?)://', 1) AS scheme",
        f"get(split({text}, '/'), 2) AS host",
        f"substring_index({text}, '/', -1) AS last_part",
        f"size(split({text}, '/')) AS parts",
        f"get(split({text}, '/'), 2) RLIKE '^[A-Za-z]+$' AS host_is_letters",
        f"substring_index({text}, '/', -1) RLIKE '^[0-9]+$' AS last_is_digits",
    )


def text_classes(frame: DataFrame, key: str, text: str) -> DataFrame:
    """What kind of characters a text is made of, in any script; an empty text is none."""
    return frame.selectExpr(
        key,
        rf"{text} RLIKE '^\\p{{L}}+$' AS is_letters",
        rf"{text} RLIKE '^[0-9]+$' AS is_digits",
        rf"{text} RLIKE '^[\\p{{L}}\\p{{N}}]+$' AS is_letters_or_digits",
        rf"{text} RLIKE '^\\s+$' AS is_blank",
        rf"{text} RLIKE '\\p{{Lu}}' AND NOT {text} RLIKE '\\p{{Ll}}' AS is_upper",
        rf"{text} RLIKE '\\p{{Ll}}' AND NOT {text} RLIKE '\\p{{Lu}}' AS is_lower",
    )


def text_pieces(frame: DataFrame, key: str, text: str) -> DataFrame:
    """Lines, whatever ends them, and pieces between runs of blanks."""
    lines = rf"split(regexp_replace({text}, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n')"
    return frame.selectExpr(
        key,
        f"IF({text} = '', array(), {lines}) AS _lines",
        rf"filter(split({text}, '\\s+'), x -> x <> '') AS _pieces",
    ).selectExpr(
        key,
        "size(_lines) AS n_lines",
        "size(_pieces) AS n_pieces",
        "array_max(transform(_lines, x -> length(x))) AS longest_line",
        "get(_pieces, 0) AS first_piece",
        "sha2(array_join(_pieces, ' '), 256) AS joined_sha256",
    )


def number_math(frame: DataFrame, key: str, amount: str, measure: str | None = None) -> DataFrame:
    """Arithmetic with floor division and non-negative remainders, rounding and bases.

    ``measure`` is the column that may hold NaN and infinities; ``amount`` if not given.
    """
    measure = measure or amount
    return frame.selectExpr(
        key,
        f"abs({amount} - 250000D) AS distance",
        f"pow({key} % 7, 2) AS squared",
        f"bigint(floor(({key} - 5000) / 7)) AS floor_quotient",
        f"pmod({key} - 5000, 7) AS floor_remainder",
        f"bround({amount} / 1000, 0) AS thousands",
        f"bigint(ceil({amount} / 1000)) AS thousands_up",
        f"bigint(floor({amount} / 1000)) AS thousands_down",
        f"bigint(({amount} - 250000D) / 1000) AS thousands_cut",
        f"round(sqrt({amount}), 6) AS root",
        f"round(ln({amount} + 1), 6) AS log_e",
        f"round(log10({amount} + 1), 6) AS log_10",
        f"round(log2({amount} + 1), 6) AS log_2",
        f"round(sin(radians({key} % 360)), 6) AS sine",
        f"round(degrees(atan2(double({key} % 7), 3D)), 6) AS angle",
        f"round(hypot({amount}, 1000D), 4) AS hypotenuse",
        f"factorial(int({key} % 10)) AS factorials",
        f"isnan({measure}) OR abs({measure}) = double('Infinity') AS not_finite",
        f"IF(isnan({measure}) OR abs({measure}) = double('Infinity'), NULL, {measure}) AS finite_or_null",
        f"greatest({key} % 5, {key} % 7, 3) AS largest",
        f"bin({key}) AS binary_text",
        f"hex({key}) AS hex_text",
        f"conv(hex({key}), 16, 10) AS back_to_decimal",
        f"ascii(chr(int(65 + {key} % 26))) AS code_point",
        f"chr(int(65 + {key} % 26)) AS letter",
        f"format_number({amount}, 2) AS formatted",
        f"try_cast(IF({key} % 3 = 0, 'n/a', string({key})) AS bigint) AS parsed",
    )


def date_parts(frame: DataFrame, key: str, moment: str) -> DataFrame:
    """Parts, formats, parsing, shifts and differences of a date; Monday is 0."""
    return frame.selectExpr(
        key,
        f"year({moment}) AS year",
        f"month({moment}) AS month",
        f"day({moment}) AS day",
        f"weekday({moment}) AS weekday",
        f"date_format({moment}, 'yyyy-MM-dd') AS iso",
        f"date_format({moment}, 'MMMM dd, yyyy') AS long_text",
        f"to_date(date_format({moment}, 'dd/MM/yyyy'), 'dd/MM/yyyy') AS parsed_back",
        f"date_add(date({moment}), 30) AS in_thirty_days",
        f"datediff(date({moment}), DATE'1995-01-01') AS days_since_start",
        f"date({moment}) + INTERVAL '7' DAY > last_day(date({moment})) AS in_last_week",
    )


def array_map_ops(frame: DataFrame, key: str, words: str) -> DataFrame:
    """Lists and maps made from a text of words; results are joined to text."""
    lists = frame.selectExpr(
        key,
        f"length({words}) AS whole",
        f"split({words}, ' ') AS w",
        f"transform(split({words}, ' '), x -> length(x)) AS n",
    ).selectExpr("*", "map_from_entries(array_distinct(arrays_zip(w, n))) AS lengths")
    return lists.selectExpr(
        key,
        "array_join(transform(w, x -> upper(x)), ' ') AS upper_words",
        "array_join(reverse(w), ' ') AS reversed_words",
        "array_join(filter(w, x -> length(x) > 4), ' ') AS long_words",
        "array_contains(w, 'red') AS has_red",
        "aggregate(n, 0, (total, x) -> total + x) AS total_length",
        "aggregate(n, 0, (most, x) -> greatest(most, x)) AS reduced_max",
        "array_join(flatten(array(w, array('end'))), ' ') AS flattened",
        "array_join(transform(filter(transform(w, (x, i) -> struct(x, i)), p -> p.i % 2 = 0), p -> p.x), ' ')"
        " AS every_second",
        "array_join(transform(filter(arrays_zip(w, slice(n, 1, 1)), p -> p['1'] IS NOT NULL),"
        " p -> p.w || ':' || p['1']), ' ') AS zipped",
        "array_join(transform(filter(transform(w, (x, i) -> struct(x, i)), p -> p.x LIKE 'b%'),"
        " p -> string(p.i)), ',') AS positions_of_b",
        "greatest(array_max(n), array_max(array(4, 5))) AS max_of_lists",
        "array_join(transform(array(array(n[0], 1), array(2, 3)), r -> string(r[0])), ',') AS first_column",
        "coalesce(try_element_at(lengths, 'red'), 0) AS red_or_zero",
        "try_element_at(try_element_at(map_from_arrays(w, transform(w, x -> map('letters', length(x)))), 'red'),"
        " 'letters') AS nested_value",
        "map_from_arrays(map_values(map_filter(lengths, (k, v) -> k = w[0])), array(w[0]))[length(w[0])]"
        " AS inverted",
        "map_zip_with(lengths, map('red', whole), (k, a, b) -> coalesce(a, 0) + coalesce(b, 0))['red']"
        " AS merged_red",
        "array_join(transform(array_sort(transform(map_entries(lengths), e -> struct(e.value, e.key))),"
        " e -> e.key), ' ') AS by_length",
    )


def json_roundtrip(frame: DataFrame) -> DataFrame:
    """Read nested JSON with a declared schema and write it again inside a record."""
    read = frame.withColumn("p", F.from_json("props", "k INT"))
    return read.select(
        "event_id",
        F.col("p.k").alias("k"),
        F.coalesce(F.col("p.k") * 2, F.lit(0)).alias("twice"),
        F.to_json(F.struct("user_id", "event_type", F.struct("p.k").alias("props"))).alias("record"),
    )


def nested_values(documents: DataFrame, key: str, document: str, paths: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Values at paths of a VARIANT column, with a default where a level is missing.

    ``paths`` maps an output name to (path, type, default).
    """
    return documents.selectExpr(
        key,
        *[
            f"coalesce(try_variant_get({document}, '{path}', '{kind}'), {default}) AS {name}"
            for name, (path, kind, default) in paths.items()
        ],
    )


def formatted_by_kind(frame: DataFrame, name: str, amount: str, kind: str) -> DataFrame:
    """The text form chosen by ``kind``; an unknown kind has none."""
    money = f"format_number({amount}, 2)"
    return frame.selectExpr(
        name,
        f"CASE {kind} WHEN 'domestic' THEN {name} || ' (domestic): $' || {money} "
        f"WHEN 'international' THEN {name} || ' (international): $' || {money} || ' USD' END AS line",
    )
