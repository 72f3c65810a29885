"""SQL for the oracle, assembled from named parts.

Each part is written in plain SQL apart from the Spark code it checks.
"""

from __future__ import annotations

from tallyspark import lookups
from tallyspark.checks import adapter

BLANK = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANK}+', ' ', 'g'))"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def p8(x: str) -> str:
    """Evidence normalizer: every blank doubled, so that neighbouring numbers do not share one."""
    spaced = f"regexp_replace({squeeze(f'lower({x})')}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    wide = f"' ' || replace({spaced}, ' ', '  ') || ' '"
    return f"coalesce(trim(regexp_replace(regexp_replace({wide}, ' \\p{{Nd}}{{2,}} ', ' ', 'g'), ' +', ' ', 'g')), '')"


def p9(x: str) -> str:
    t = strip(f"lower({x})")
    return (
        f"CASE WHEN {x} IS NULL OR {t} IN ('nan','none','null') THEN ''"
        f" ELSE regexp_replace({t}, '{BLANK}+', ' ', 'g') END"
    )


def p10_type(x: str) -> str:
    return f"coalesce({strip(f'lower({x})')}, '')"


def p10_id(x: str) -> str:
    t = strip(x)
    return (
        f"CASE WHEN {x} IS NULL OR lower({t}) IN ('','nan','none','null') THEN ''"
        f" WHEN TRY_CAST({t} AS DOUBLE) = floor(TRY_CAST({t} AS DOUBLE))"
        f" THEN CAST(CAST(TRY_CAST({t} AS DOUBLE) AS BIGINT) AS VARCHAR)"
        f" WHEN TRY_CAST({t} AS DOUBLE) IS NOT NULL THEN CAST(TRY_CAST({t} AS DOUBLE) AS VARCHAR)"
        f" ELSE {t} END"
    )


def p11(x: str) -> str:
    return f"coalesce({squeeze(f'lower({x})')}, '')"


def p12(x: str) -> str:
    return f"coalesce({strip(f'lower({x})')}, '')"


def alias_case(x: str, table: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {quoted(a)} THEN {quoted(f)}" for a, f in table.items())
    return f"CASE lower({strip(x)}) {whens} ELSE {strip(x)} END"


def family_case(x: str, table: dict[int, str] = lookups.TAXONOMY_V2) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {i} THEN {quoted(f)}" for i, f in table.items()) + " END"


def id_case(x: str, table: dict[int, str] = lookups.TAXONOMY_V2) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {quoted(f)} THEN {i}" for i, f in table.items()) + " END"


def any_contains(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {quoted(w)})" for w in words) + ")"


def any_term(x: str, words) -> str:
    tests = [
        f"contains({x}, {quoted(w)})" if " " in w else f"contains(' ' || {x} || ' ', {quoted(' ' + w + ' ')})"
        for w in words
    ]
    return "(" + " OR ".join(tests) + ")"


def rule_case(x: str) -> str:
    rules = lookups.RULE_KEYWORDS
    count = " + ".join(f"CAST({any_contains(x, w)} AS INT)" for w in rules.values())
    pick = " ".join(f"WHEN {any_contains(x, w)} THEN {quoted(f)}" for f, w in rules.items())
    return f"CASE WHEN ({count}) = 1 THEN CASE {pick} END END"


def proposal_case(desc: str, kind: str) -> str:
    terms = lookups.PROPOSAL_TERMS
    general = {f: w for f, w in terms.items() if f not in ("Transfers", "Income")}
    count = " + ".join(f"CAST({any_term(desc, w)} AS INT)" for w in general.values())
    pick = " ".join(f"WHEN {any_term(desc, w)} THEN {quoted(f)}" for f, w in general.items())
    return (
        f"CASE WHEN {kind} = 'Transfer' AND {any_term(desc, terms['Transfers'])} THEN 'Transfers'"
        f" WHEN {kind} = 'Income' AND {any_term(desc, terms['Income'])} THEN 'Income'"
        f" WHEN ({count}) = 1 THEN CASE {pick} END"
        f" WHEN ({count}) > 1 THEN 'AMBIGUOUS' ELSE 'Unassigned' END"
    )


def values_list(rows) -> str:
    def lit(v):
        return quoted(v) if isinstance(v, str) else str(v)

    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def hash_unit(x: str, seed: int = 42) -> str:
    return (
        f"(CAST(CAST('0x' || substr(md5('{seed}|' || CAST({x} AS VARCHAR)), 1, 8) AS UBIGINT) AS DOUBLE)"
        f" / 4294967296.0)"
    )


def date_of(x: str) -> str:
    return f"CAST(TRY_CAST({x} AS TIMESTAMP) AS DATE)"


def flags(desc: str, date: str, amount: str, kind: str, types: str) -> str:
    return f"""
  {desc} IS NULL OR {strip(desc)} = '' AS missing_description,
  {date} IS NULL AS missing_transaction_date,
  coalesce({amount} < 0, FALSE) AS negative_amount,
  coalesce({amount} = 0, FALSE) AS zero_amount,
  coalesce({kind} NOT IN {types}, TRUE) AS invalid_transaction_type,
  coalesce({date} > DATE '{adapter.AS_OF}', FALSE) AS future_transaction_date"""


PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, needs: list[str], sql: str) -> None:
    PARTS[name] = (needs, sql)


def sql(needs: list[str], body: str) -> str:
    """``WITH`` the named parts, in dependency order, then the body."""
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for dep in PARTS[name][0]:
            visit(dep)
        seen.append(name)

    for name in needs:
        visit(name)
    if not seen:
        return body
    ctes = ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in seen)
    return f"WITH {ctes}\n{body}"


part("raw", [], adapter.RAW_SQL.format(orders="orders", part="part"))
part("msg", [], adapter.MESSAGE_SQL.format(orders="orders"))
part(
    "typed",
    ["raw"],
    f"""
SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(voucher_id AS BIGINT) AS voucher_id,
  TRY_CAST(consumer_id AS BIGINT) AS consumer_id, {strip('vch_type')} AS vch_type,
  TRY_CAST(vch_amount AS DECIMAL(18,2)) AS vch_amount, {date_of('vch_date')} AS vch_date,
  TRY_CAST(vch_year AS INT) AS vch_year, TRY_CAST(vch_month AS INT) AS vch_month,
  TRY_CAST(vch_day AS INT) AS vch_day, TRY_CAST(vch_created_on AS TIMESTAMP) AS vch_created_on,
  {strip('vch_desc')} AS vch_desc, TRY_CAST(fc_amount AS DECIMAL(18,2)) AS fc_amount,
  TRY_CAST(fc_rate AS DECIMAL(18,6)) AS fc_rate, TRY_CAST(account_id AS BIGINT) AS account_id,
  TRY_CAST(record_created_on AS TIMESTAMP) AS record_created_on,
  TRY_CAST(TRY_CAST(category_id AS DOUBLE) AS BIGINT) AS category_id, {strip('use_case_title')} AS use_case_title
FROM raw""",
)
_PROD_COLUMNS = """
  voucher_id, id AS source_id, consumer_id, vch_type AS transaction_type, vch_amount AS amount,
  vch_date AS transaction_date, vch_year AS transaction_year, vch_month AS transaction_month,
  vch_day AS transaction_day, vch_created_on AS created_on, vch_desc AS description,
  fc_amount AS foreign_currency_amount, fc_rate AS foreign_currency_rate, account_id,
  record_created_on, category_id AS original_category_id, use_case_title,"""
part(
    "prod",
    ["typed"],
    f"SELECT {_PROD_COLUMNS} {flags('vch_desc', 'vch_date', 'vch_amount', 'vch_type', in_list(['Expense', 'Income', 'Transfer']))} FROM typed",
)
part(
    "typed_inc",
    ["raw"],
    f"""
SELECT t.* EXCLUDE (vch_type, vch_desc, use_case_title), r.vch_type, r.vch_desc, r.use_case_title
FROM (SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(voucher_id AS BIGINT) AS voucher_id,
  TRY_CAST(consumer_id AS BIGINT) AS consumer_id, NULL AS vch_type, NULL AS vch_desc, NULL AS use_case_title,
  TRY_CAST(vch_amount AS DECIMAL(18,2)) AS vch_amount, {date_of('vch_date')} AS vch_date,
  TRY_CAST(vch_year AS INT) AS vch_year, TRY_CAST(vch_month AS INT) AS vch_month,
  TRY_CAST(vch_day AS INT) AS vch_day, TRY_CAST(vch_created_on AS TIMESTAMP) AS vch_created_on,
  TRY_CAST(fc_amount AS DECIMAL(18,2)) AS fc_amount, TRY_CAST(fc_rate AS DECIMAL(18,6)) AS fc_rate,
  TRY_CAST(account_id AS BIGINT) AS account_id, TRY_CAST(record_created_on AS TIMESTAMP) AS record_created_on,
  TRY_CAST(TRY_CAST(category_id AS DOUBLE) AS BIGINT) AS category_id FROM raw) t
JOIN raw r ON r.id = CAST(t.id AS VARCHAR)""",
)
part(
    "inc",
    ["typed_inc"],
    f"SELECT {_PROD_COLUMNS} {flags('vch_desc', 'vch_date', 'vch_amount', 'vch_type', in_list(['Income', 'Expense']))} FROM typed_inc",
)
part("loaded", ["prod"], f"SELECT * FROM prod WHERE transaction_date < DATE '{adapter.LOADED_BEFORE}'")

part(
    "cleaned",
    ["raw"],
    f"""SELECT *, {p9('vch_desc')} AS description_clean, {p10_type('vch_type')} AS vch_type_clean,
  {p10_id('category_id')} AS category_id_clean FROM raw""",
)
part(
    "approved",
    [],
    f"""SELECT {p9('description')} AS description_clean, {p10_type('vch_type')} AS vch_type_clean,
  min(canonical_id) AS canonical_id, min({alias_case('canonical_family', lookups.CASCADE_ALIASES)}) AS canonical_family
  FROM ({values_list(lookups.APPROVED_MAPPINGS)}) AS t(description, vch_type, canonical_family, canonical_id) GROUP BY 1, 2""",
)
part(
    "first_pass",
    ["cleaned", "approved"],
    f"""SELECT c.*, a.canonical_id AS approved_id, {rule_case('c.description_clean')} AS rule_family
  FROM cleaned c LEFT JOIN approved a USING (description_clean, vch_type_clean)""",
)
part(
    "pass1",
    ["first_pass"],
    f"""SELECT *, CASE WHEN approved_id IS NOT NULL THEN 'APPROVED_MAPPING' WHEN rule_family IS NOT NULL THEN 'RULE'
    ELSE 'UNMAPPED' END AS mapping_method,
  coalesce({family_case('approved_id')}, rule_family, 'UNMAPPED') AS canonical_family FROM first_pass""",
)
part(
    "matrix",
    ["pass1"],
    """SELECT category_id_clean, canonical_family_clean, transaction_count, mapped_total,
    transaction_count / CAST(mapped_total AS DOUBLE) * 100 AS percentage
  FROM (SELECT *, CAST(sum(transaction_count) OVER (PARTITION BY category_id_clean) AS BIGINT) AS mapped_total
    FROM (SELECT coalesce(TRY_CAST(category_id AS DOUBLE), -1.0) AS category_id_clean,
            canonical_family AS canonical_family_clean, count(*) AS transaction_count
          FROM pass1 WHERE mapping_method IN ('APPROVED_MAPPING', 'RULE') GROUP BY 1, 2))""",
)
part(
    "dominant",
    ["matrix"],
    """SELECT category_id_clean, canonical_family_clean AS dominant_canonical_family,
    transaction_count AS dominant_count, mapped_total, percentage AS dominant_percentage
  FROM (SELECT *, row_number() OVER (PARTITION BY category_id_clean
          ORDER BY transaction_count DESC, canonical_family_clean) AS rn FROM matrix) WHERE rn = 1""",
)
part(
    "strong",
    ["dominant"],
    """SELECT CAST(CAST(category_id_clean AS BIGINT) AS VARCHAR) AS category_id_clean,
    dominant_canonical_family AS strong_family
  FROM dominant WHERE dominant_percentage >= 95 AND mapped_total >= 5""",
)
part(
    "cat",
    ["first_pass", "strong"],
    f"""SELECT *, CASE WHEN canonical_family = 'UNMAPPED' THEN 'UNMAPPED' ELSE 'MAPPED' END AS canonical_mapping_status
  FROM (SELECT f.*,
    CASE WHEN approved_id IS NOT NULL THEN 'APPROVED_MAPPING' WHEN rule_family IS NOT NULL THEN 'RULE'
         WHEN strong_family IS NOT NULL THEN 'CATEGORY_ID' ELSE 'UNMAPPED' END AS mapping_method,
    coalesce(approved_id, {id_case('coalesce(rule_family, strong_family)')}) AS canonical_id,
    coalesce({family_case('approved_id')}, rule_family, strong_family, 'UNMAPPED') AS canonical_family
  FROM first_pass f LEFT JOIN strong USING (category_id_clean))""",
)
part(
    "tc",
    ["cat"],
    """SELECT CAST(voucher_id AS BIGINT) AS voucher_id, canonical_id,
    CASE WHEN canonical_id IS NULL THEN 'UNMAPPED' ELSE canonical_family END AS category_name,
    canonical_mapping_status AS mapping_status, mapping_method AS classification_method,
    CAST(NULL AS VARCHAR) AS matched_term, CAST(NULL AS DOUBLE) AS confidence,
    CAST(NULL AS VARCHAR) AS label_source FROM cat""",
)
part(
    "labelled",
    ["raw"],
    f"""SELECT * FROM (SELECT CAST(voucher_id AS BIGINT) AS voucher_id, vch_desc, {strip('vch_type')} AS vch_type, vch_amount,
    CAST(TRY_CAST(category_id AS DOUBLE) AS BIGINT) AS source_category_id, {p8('vch_desc')} AS clean_description
  FROM raw WHERE id IS NOT NULL AND vch_desc IS NOT NULL AND category_id IS NOT NULL AND vch_type IS NOT NULL
    AND TRY_CAST(category_id AS DOUBLE) <= {lookups.MAX_SANE_CATEGORY_ID}) WHERE clean_description <> ''""",
)
part(
    "proposals",
    ["labelled"],
    f"""SELECT p.*, CASE WHEN transaction_support >= 10 AND source_category_purity >= 0.95 THEN 'SAFE_CANDIDATE'
      WHEN transaction_support >= 5 AND source_category_purity >= 0.80 THEN 'REVIEW_CANDIDATE'
      ELSE 'WEAK_CANDIDATE' END AS risk_level
  FROM (SELECT description, vch_type, proposed_family, CAST(sum(n) AS BIGINT) AS transaction_support,
    min(c) FILTER (WHERE rn = 1) AS dominant_source_category_id, count(*) AS distinct_source_category_ids,
    round(max(n) / CAST(sum(n) AS DOUBLE), 4) AS source_category_purity
  FROM (SELECT *, row_number() OVER (PARTITION BY description, vch_type, proposed_family ORDER BY n DESC, c) AS rn
    FROM (SELECT clean_description AS description, vch_type, {proposal_case('clean_description', 'vch_type')} AS proposed_family,
            source_category_id AS c, count(*) AS n FROM labelled GROUP BY 1, 2, 3, 4)
    WHERE proposed_family NOT IN ('Unassigned', 'AMBIGUOUS'))
  GROUP BY 1, 2, 3) p""",
)
part("split", ["labelled"], f"SELECT *, {hash_unit('voucher_id')} < 0.2 AS is_test FROM labelled")
part("train", ["split"], "SELECT * FROM split WHERE NOT is_test")
part("test", ["split"], "SELECT * FROM split WHERE is_test")
part(
    "history",
    ["train"],
    """SELECT clean_description, min(c) FILTER (WHERE rn = 1) AS category,
    max(n) / CAST(sum(n) AS DOUBLE) AS purity, CAST(sum(n) AS BIGINT) AS support
  FROM (SELECT *, row_number() OVER (PARTITION BY clean_description ORDER BY n DESC, c) AS rn
    FROM (SELECT clean_description, source_category_id AS c, count(*) AS n FROM train GROUP BY 1, 2))
  GROUP BY 1""",
)


def gram_part(name: str, source: str, key: str, needs: list[str]) -> None:
    """Char 3-5-gram counts of distinct texts: slide over each padded word."""
    part(
        name,
        needs,
        f"""SELECT {key}, gram, count(*) AS tf FROM (
      SELECT {key}, unnest(list_transform(range(1, length(w) - n + 2), lambda i: substr(w, i, n))) AS gram
      FROM (SELECT {key}, ' ' || unnest(string_split({key}, ' ')) || ' ' AS w FROM {source}),
           (VALUES (3), (4), (5)) AS sizes(n) WHERE length(w) >= n) GROUP BY 1, 2""",
    )


part("refs", ["history"], "SELECT clean_description AS reference, category, purity FROM history")
part("asks", ["test"], "SELECT DISTINCT clean_description AS query FROM test")
gram_part("ref_tf", "refs", "reference", ["refs"])
gram_part("ask_tf", "asks", "query", ["asks"])
part(
    "vocab",
    ["ref_tf", "refs"],
    "SELECT gram, count(*) AS df, ln((1 + (SELECT count(*) FROM refs)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM ref_tf GROUP BY 1",
)
for _n, _k in (("ref", "reference"), ("ask", "query")):
    part(
        f"{_n}_w",
        [f"{_n}_tf", "vocab"],
        f"SELECT {_k}, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {_k})) AS w FROM {_n}_tf JOIN vocab USING (gram)",
    )
part(
    "neigh",
    ["ref_w", "ask_w"],
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, reference) AS rank
    FROM (SELECT query, reference, round(sum(a.w * r.w), 10) AS similarity
          FROM ask_w a JOIN ref_w r USING (gram) GROUP BY 1, 2)) WHERE rank <= 5""",
)
part(
    "sem",
    ["neigh", "refs"],
    """SELECT query, category AS sem_category, top * votes / total AS sem_confidence, top AS sem_top_similarity
  FROM (SELECT *, sum(votes) OVER (PARTITION BY query) AS total,
          row_number() OVER (PARTITION BY query ORDER BY votes DESC, nearest) AS rn
        FROM (SELECT query, category, round(sum(similarity * purity), 10) AS votes, max(similarity) AS top, min(rank) AS nearest
              FROM neigh JOIN refs USING (reference) GROUP BY 1, 2)) WHERE rn = 1 AND total > 0""",
)
