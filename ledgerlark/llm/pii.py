"""Personal data: base patterns, and terms that give a person away by co-occurrence.

Base spans (email, ip, card, phone) are protected entities.  A term that appears in the
same line as an entity tells something about it; how much is measured over the whole
corpus, as pointwise mutual information relative to the entity's own information
content:

    disclosure(entity, term) = log(p * N / n_e) / log(N / n_e)

``N`` is the number of lines, ``n_e``, ``n_t``, ``n_et`` the lines that hold the entity, the
term, and both.  ``p`` is how likely a line with the term holds the entity: not the plain
share ``n_et / n_t``, which would be 1 for every word that occurs once, but the lower end of
its 95 % confidence interval (Wilson, one-sided).  So any entity and any term counts, on
however few lines, and few lines weigh little.  1 would mean that the term is only ever
seen with the entity, 0 that it says nothing.  Terms at or above ``remove_at`` are removed
and those at or above ``generalise_at`` become a class mark, in every document that holds
the entity.

Only DataFrame functions are used, so everything stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlark.llm.shared import attach, stage, table, with_document_key

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, written so that a match is found in one pass: possessive
# repeats, and no try from the middle of a run that failed at its head (\G is the end of
# the match before, where a new one may begin).
_MID_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
_MID_DIGIT = r"(?:(?<![0-9])|\G)"
PATTERNS = {
    "email": _MID_EMAIL + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _MID_DIGIT + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold at all to be searched.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = r"[\p{L}\p{N}]+"
REMOVE_AT, GENERALISE_AT = 0.9, 0.75
# One-sided 95 %.
Z = 1.645
_SPAN = "array<struct<kind:string,start:int,end:int,text:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    """Luhn's checksum of one digit or more, counted from the right."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc + _luhn_digit(F.substring(digits, i, F.lit(1)).cast("int"), (n - i) % 2 == 1),
    )
    return total % 10 == 0


def _luhn_digit(d: Column, doubled: Column) -> Column:
    return F.when(~doubled, d).when(d > 4, 2 * d - 9).otherwise(2 * d)


def _valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), _passes_luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _placed(kind: str, hits: Column, pieces: Column) -> Column:
    """Valid spans of one kind, in order; code points, end exclusive.

    A match begins where the pieces and matches before it end.
    """
    none = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["hit"].alias("text")
        )
        spans = F.when(
            _valid(kind, x["hit"]), F.concat(acc["spans"], F.array(span).cast(_SPAN))
        ).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    steps = F.zip_with(
        F.slice(pieces, 1, F.size(hits)), hits,
        lambda piece, hit: F.struct(F.length(piece).alias("gap"), hit.alias("hit")),
    )
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    spans = F.aggregate(steps, begin, step, lambda acc: acc["spans"])
    return F.when(F.size(hits) > 0, spans).otherwise(none)


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one column per kind: its spans (kind, start, end, text)."""
    value = F.col(text)
    held = {
        k: F.contains(value, F.lit(need)) if need else F.regexp_like(value, F.lit("[0-9]"))
        for k, need in _NEEDS.items()
    }
    none = F.array().cast("array<string>")
    hits = docs.select("*", *[
        F.when(held[k], F.regexp_extract_all(value, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"_h_{k}")
        for k in KINDS
    ])
    pieces = hits.select("*", *[
        F.when(F.size(f"_h_{k}") > 0, F.split(value, PATTERNS[k], -1)).otherwise(none).alias(f"_p_{k}")
        for k in KINDS
    ])
    return pieces.select(*docs.columns, *[_placed(k, F.col(f"_h_{k}"), F.col(f"_p_{k}")).alias(k) for k in KINDS])


def _entity(span: Column) -> Column:
    """What makes two spans the same entity: the address, or the digits of a number."""
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["text"])).otherwise(F.lower(span["text"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def surely(n_et: str, n_t: str) -> Column:
    """Lower end of the confidence interval of the share ``n_et / n_t`` (Wilson's score)."""
    n, share = F.col(n_t).cast("double"), F.col(n_et) / F.col(n_t).cast("double")
    z2 = Z * Z
    middle = share + z2 / (2 * n)
    spread = Z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))
    return (middle - spread) / (1 + z2 / n)


def disclosing_terms(
    docs: DataFrame, found: DataFrame, remove_at: float = REMOVE_AT, generalise_at: float = GENERALISE_AT
) -> tuple[DataFrame, DataFrame]:
    """``(entity, a, b)`` and ``(a, b, term, remove)``: terms that give an entity away.

    ``docs`` are all documents, ``found`` those that hold base spans.  Entities that stand
    on the same lines have the same terms, so they are one set, named (a, b); a line with
    thousands of entities is then a row for each of its terms and not for each pair.
    """
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line"))
    # Counted over the whole corpus; both fold before they are shuffled.
    counts = lines.select(F.explode(_terms(F.col("line"))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_t")
    )
    total = lines.agg(F.count(F.lit(1))).scalar().cast("double")

    near = with_base_spans(
        found.select(F.explode(F.split("text", "\n", -1)).alias("line")), "line"
    ).select("line", F.concat(*KINDS).alias("spans")).filter(F.size("spans") > 0)
    rest = F.col("line")
    for kind in KINDS:
        rest = F.regexp_replace(rest, PATTERNS[kind], " ")
    near = stage(near.select(
        F.xxhash64("line").alias("l1"), F.xxhash64(F.lit("second"), F.col("line")).alias("l2"),
        F.array_distinct(F.transform("spans", _entity)).alias("entities"), _terms(rest).alias("terms"),
    ).groupBy("l1", "l2").agg(
        F.count(F.lit(1)).alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms")
    ))
    # An entity's lines by their hashes, in any order.
    entities = stage(
        near.select("l1", "l2", "copies", F.explode("entities").alias("entity"))
        .groupBy("entity").agg(F.bit_xor("l1").alias("a"), F.bit_xor("l2").alias("b"), F.sum("copies").alias("n_e"))
    )
    sets = stage(
        near.select("l1", "l2", "copies", F.explode("entities").alias("entity"))
        .join(entities, "entity").groupBy("a", "b", "l1", "l2").agg(F.max("n_e").alias("n_e"), F.max("copies").alias("copies"))
    )
    most = sets.groupBy("l1", "l2").agg(F.max("n_e").alias("most"))
    # A term on more lines than this cannot reach the threshold for any entity of the line.
    rare = F.col("n_t") <= F.pow(F.col("most").cast("double"), F.lit(generalise_at)) * F.pow(
        F.col("n"), F.lit(1 - generalise_at)
    )
    terms = (
        near.select("l1", "l2", F.explode("terms").alias("term")).join(counts, "term").join(most, ["l1", "l2"])
        .withColumn("n", total).filter(rare).select("l1", "l2", "term", "n_t", "n")
    )
    pairs = sets.join(terms, ["l1", "l2"]).groupBy("a", "b", "n_e", "term", "n_t", "n").agg(F.sum("copies").alias("n_et"))
    alone = F.col("n") / F.col("n_e")
    share = F.try_divide(F.log(surely("n_et", "n_t") * alone), F.log(alone))
    disclosed = pairs.select("a", "b", "term", F.round(share, 9).alias("disclosure")).filter(
        F.col("disclosure") >= generalise_at
    )
    return entities.select("entity", "a", "b"), disclosed.select("a", "b", "term", (F.col("disclosure") >= remove_at).alias("remove"))


def term_spans(found: DataFrame, entities: DataFrame, disclosed: DataFrame) -> DataFrame:
    """``(doc_id, _t, terms)``: where disclosing terms stand outside of base spans."""
    keyed = found.select("doc_id", "_t", F.concat(*KINDS).alias("base"), "text").dropDuplicates(["doc_id", "_t"])
    owed = (
        keyed.select("doc_id", "_t", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
        .join(entities, "entity").select("doc_id", "_t", "a", "b").distinct()
        .join(disclosed, ["a", "b"])
        .groupBy("doc_id", "_t", "term").agg(F.max("remove").alias("remove"))
        .withColumnsRenamed({"doc_id": "_doc", "_t": "_text", "term": "_term"})
    )
    # Each word with the text before it; the places are running sums within a document.
    words = keyed.select(
        "doc_id", "_t", "base",
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("word"),
                F.slice(
                    F.transform(F.split("text", TERM, -1), lambda p: F.length(p)), F.lit(1),
                    F.size(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))),
                ).alias("gap"),
            )
        ).alias("i", "w"),
    )
    so_far = Window.partitionBy("doc_id", "_t").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = words.select(
        "doc_id", "_t", "base", F.lower("w.word").alias("term"), F.length("w.word").alias("n"),
        F.sum(F.col("w.gap") + F.length("w.word")).over(so_far).cast("int").alias("end"),
        F.col("w.word").alias("word"),
    ).select("doc_id", "_t", "base", "term", (F.col("end") - F.col("n")).alias("start"), "end", "word")
    hit = placed.join(
        owed,
        placed["doc_id"].eqNullSafe(owed["_doc"]) & (placed["_t"] == owed["_text"]) & (placed["term"] == owed["_term"]),
    ).filter(
        ~F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    )
    span = F.struct(
        F.when(F.col("remove"), "removed").otherwise("generalised").alias("kind"),
        "start", "end", F.col("word").alias("text"),
    )
    return hit.groupBy("doc_id", "_t").agg(
        F.sort_array(F.collect_list(F.struct("start", span.alias("span")))).alias("all")
    ).select("doc_id", "_t", F.transform("all", lambda x: x["span"]).cast(_SPAN).alias("terms"))


def _mark(span: Column) -> Column:
    return (
        F.when(span["kind"] == "removed", "")
        .when((span["kind"] == "generalised") & span["text"].rlike("[0-9]"), "[NUMBER]")
        .when(span["kind"] == "generalised", "[WORD]")
        .otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
    )


def sanitised(text: Column, spans: Column) -> Column:
    """The text with its spans replaced; spans that overlap share the mark of the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("at"), s.alias("span"))))

    def step(acc: Column, x: Column) -> Column:
        s = x["span"]
        apart = s["start"] >= acc["at"]
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        parts = F.when(apart, F.concat(acc["parts"], F.array(before, _mark(s)))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(
        ordered, begin, step,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )


def private_spans(docs: DataFrame, remove_at: float = REMOVE_AT, generalise_at: float = GENERALISE_AT) -> DataFrame:
    """``(doc_id, _t, email, ip, card, phone, terms)`` for every row of keyed ``docs``."""
    spotted = with_base_spans(docs)
    # The patterns are searched once; the texts are kept where something was found.
    known = stage(
        spotted.select("doc_id", "_t", *KINDS, F.when(F.size(F.concat(*KINDS)) > 0, F.col("text")).alias("text"))
    )
    found = known.filter(F.col("text").isNotNull())
    entities, disclosed = disclosing_terms(docs, found, remove_at, generalise_at)
    return attach(known.drop("text"), term_spans(found, entities, disclosed)).select(
        "doc_id", "_t", *KINDS, F.coalesce("terms", F.array().cast(_SPAN)).alias("terms")
    )


def sanitise(docs: DataFrame, remove_at: float = REMOVE_AT, generalise_at: float = GENERALISE_AT) -> DataFrame:
    """``(doc_id, email, ip, card, phone, terms, clean_text)`` for every row of ``docs``.

    The span columns hold (kind, start, end, text) in order of place.

    Null or empty text: no spans.  Null doc_id: a document like any other.  Repeated rows
    (same doc_id and text) each get the result and count as lines of their own.  Other
    columns are ignored.  An empty table gives no rows.
    """
    keyed = with_document_key(docs)
    spans = private_spans(keyed, remove_at, generalise_at).dropDuplicates(["doc_id", "_t"])
    return attach(keyed, spans).select(
        "doc_id", *KINDS, "terms", sanitised(F.col("text"), F.concat(*KINDS, "terms")).alias("clean_text")
    )


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: counts, every span as kind:start:end, the sanitised text's hash."""
    found = sanitise(table(spark, sf_dir, "documents"))

    def written(all_spans: Column) -> Column:
        return F.array_join(
            F.transform(all_spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    # Terms by kind, then by place, behind the base kinds.
    terms = F.concat(
        F.filter("terms", lambda s: s["kind"] == "generalised"),
        F.filter("terms", lambda s: s["kind"] == "removed"),
    )
    base = F.concat(*KINDS)
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.concat(base, terms)).alias("spans"),
        F.size("terms").cast("bigint").alias("n_terms"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )


PII_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT doc_id, 'email' AS kind, 1 AS rank,
        regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS hits,
        regexp_split_to_array(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS pieces FROM docs
    UNION ALL SELECT doc_id, 'ip', 2,
        regexp_extract_all(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'),
        regexp_split_to_array(text, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') FROM docs
    UNION ALL SELECT doc_id, 'card', 3,
        regexp_extract_all(text, '[0-9](?:[ -]?[0-9])+'),
        regexp_split_to_array(text, '[0-9](?:[ -]?[0-9])+') FROM docs
    UNION ALL SELECT doc_id, 'phone', 4,
        regexp_extract_all(text, '\+[0-9][ ().0-9-]+[0-9]'),
        regexp_split_to_array(text, '\+[0-9][ ().0-9-]+[0-9]') FROM docs
), each AS (
    SELECT doc_id, kind, rank, unnest(range(len(hits))) AS i, unnest(hits) AS hit,
        unnest(pieces[1:len(hits)]) AS gap FROM cut
), placed AS (
    SELECT *, CAST(sum(length(gap) + length(hit)) OVER (
        PARTITION BY doc_id, kind ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop,
        regexp_replace(hit, '[^0-9]', '', 'g') AS digits FROM each
), base AS (
    SELECT doc_id, kind, rank, stop - length(hit) AS start, stop, hit, kind || ':' ||
        CASE WHEN kind IN ('card', 'phone') THEN digits ELSE lower(hit) END AS entity
    FROM placed WHERE kind = 'email'
        OR kind = 'ip' AND list_max(list_transform(string_split(hit, '.'), lambda x: CAST(x AS HUGEINT))) <= 255
        OR kind = 'phone' AND length(digits) BETWEEN 9 AND 15
        OR kind = 'card' AND length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(
            range(1, length(digits) + 1), lambda i: CASE
                WHEN (length(digits) - i) % 2 = 0 THEN CAST(digits[i] AS INT)
                WHEN CAST(digits[i] AS INT) > 4 THEN 2 * CAST(digits[i] AS INT) - 9
                ELSE 2 * CAST(digits[i] AS INT) END)) % 10 = 0
), lines AS (
    SELECT doc_id, unnest(range(len(l))) AS no, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM docs)
), bounds AS (
    SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY no ROWS UNBOUNDED PRECEDING) AS upto FROM lines
), total AS (SELECT count(*) AS n FROM lines
), term_counts AS (
    SELECT term, count(*) AS n_t FROM (
        SELECT unnest(list_distinct(regexp_extract_all(lower(line), '[\p{L}\p{N}]+'))) AS term FROM lines)
    GROUP BY term
), near AS (
    SELECT b.line, list_distinct(list(e.entity)) AS entities, count(DISTINCT (b.doc_id, b.no)) AS copies
    FROM base e JOIN bounds b ON b.doc_id = e.doc_id AND e.stop <= b.upto AND e.start >= b.upto - length(b.line) - 1
    GROUP BY b.line
), rest AS (
    SELECT line, copies, entities, list_distinct(regexp_extract_all(lower(
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(line,
            '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', ' ', 'g'),
            '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+', ' ', 'g'),
            '[0-9]+(?:[ -][0-9]+)*', ' ', 'g'),
            '\+[0-9][ ().0-9-]+[0-9]', ' ', 'g')), '[\p{L}\p{N}]+')) AS terms FROM near
), held AS (
    SELECT line, copies, terms, unnest(entities) AS entity FROM rest
), entities AS (SELECT entity, sum(copies) AS n_e FROM held GROUP BY entity
), pairs AS (
    SELECT entity, term, sum(copies) AS n_et FROM (SELECT line, copies, entity, unnest(terms) AS term FROM held)
    GROUP BY entity, term
), sure AS (
    SELECT entity, term, n_et / n_t::DOUBLE AS s, n_t::DOUBLE AS m FROM pairs JOIN term_counts USING (term)
), disclosed AS (
    SELECT entity, term, round(ln((s + 1.645::DOUBLE * 1.645 / (2 * m)
            - 1.645::DOUBLE * sqrt(s * (1 - s) / m + 1.645::DOUBLE * 1.645 / (4 * m * m)))
            / (1 + 1.645::DOUBLE * 1.645 / m) * (n::DOUBLE / n_e)) / ln(n::DOUBLE / n_e), 9) AS d
    FROM sure JOIN entities USING (entity), total WHERE n > n_e
), owed AS (
    SELECT b.doc_id, d.term, max(d.d) >= 0.9 AS remove
    FROM (SELECT DISTINCT doc_id, entity FROM base) b JOIN disclosed d ON d.entity = b.entity AND d.d >= 0.75
    GROUP BY b.doc_id, d.term
), word_cut AS (
    SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS hits,
        regexp_split_to_array(text, '[\p{L}\p{N}]+') AS pieces
    FROM docs WHERE doc_id IN (SELECT doc_id FROM owed)
), words AS (
    SELECT doc_id, unnest(range(len(hits))) AS i, unnest(hits) AS word, unnest(pieces[1:len(hits)]) AS gap FROM word_cut
), word_places AS (
    SELECT *, CAST(sum(length(gap) + length(word)) OVER (
        PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM words
), term_spans AS (
    SELECT w.doc_id, CASE WHEN o.remove THEN 'removed' ELSE 'generalised' END AS kind,
        CASE WHEN o.remove THEN 6 ELSE 5 END AS rank, w.stop - length(w.word) AS start, w.stop
    FROM word_places w JOIN owed o ON o.doc_id = w.doc_id AND o.term = lower(w.word)
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id
        AND b.start < w.stop AND b.stop > w.stop - length(w.word))
), every AS (
    SELECT doc_id, kind, rank, start, stop FROM base UNION ALL SELECT * FROM term_spans
), told AS (
    SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        count(*) FILTER (rank > 4) AS n_terms,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) FILTER (rank <= 4) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY rank, start) AS spans
    FROM every GROUP BY doc_id
), in_turn AS (
    SELECT e.*, d.text, coalesce(max(stop) OVER (
        PARTITION BY doc_id ORDER BY start, kind, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
    FROM every e JOIN docs d USING (doc_id)
), cleaned AS (
    SELECT doc_id, string_agg(substr(text, upto + 1, start - upto) || CASE
            WHEN kind = 'removed' THEN ''
            WHEN kind = 'generalised' THEN CASE WHEN regexp_matches(substr(text, start + 1, stop - start), '[0-9]')
                THEN '[NUMBER]' ELSE '[WORD]' END
            ELSE '[' || upper(kind) || ']' END, '' ORDER BY start, kind, stop) FILTER (start >= upto)
        || substr(any_value(text), max(stop) + 1) AS clean
    FROM in_turn GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
    coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_terms, 0) AS n_terms, sha256(coalesce(c.clean, d.text)) AS clean_sha256
FROM docs d LEFT JOIN told t ON t.doc_id = d.doc_id LEFT JOIN cleaned c ON c.doc_id = d.doc_id
"""
