"""The registered queries as DuckDB SQL over the same tables."""

from .plans import extraction

# Fixed values, written out here so that a slip in the plans shows: accepted values of the columns.
CONTRACT_STATUSES = ("ACTIVE", "EXPIRED", "FUTURE")
PAYER_TYPES = ("COMMERCIAL", "GOVERNMENT", "HMO", "PPO", "EPO")
RATE_TYPES = ("PER_DIEM", "PERCENTAGE", "FLAT_FEE", "FEE_SCHEDULE", "CASE_RATE")
AMENDMENT_TYPES = ("MODIFICATION", "RATE_CHANGE", "TERMINATION", "EXTENSION", "ADDENDUM")
AS_OF = "DATE '1999-01-01'"

# Named relations; each may use the ones before it.
RELATIONS = {
    "raw": """
      SELECT o_orderkey AS k,
        CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'CON-' || o_orderkey END AS contract_id,
        ' ' || n_name || CASE WHEN n_nationkey IN (3, 7) AND o_orderkey % 2 = 0 THEN ' LTD' ELSE '' END
          AS payer_name,
        CASE WHEN o_orderkey % 53 = 0 THEN NULL
             ELSE 'p-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || ' ' END AS payer_id,
        CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE lpad(CAST(sk AS VARCHAR), 10, '0') END
          AS provider_npi,
        replace(s_name, '#', chr(9)) AS provider_name,
        CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'null'
             WHEN o_orderkey % 23 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END
          AS effective_date,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL
             WHEN o_orderkey % 31 = 0 THEN strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d')
             ELSE strftime(o_orderdate + INTERVAL 1 DAY * (365 * (1 + o_orderkey % 4)), '%Y-%m-%d')
        END AS termination_date,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS extracted_at,
        CAST((o_orderkey % 101) / 100 AS DECIMAL(5,4)) AS confidence_score,
        'incoming/' || o_orderkey || '.pdf' AS source_file,
        CAST(o_orderdate AS TIMESTAMP) AS loaded_at
      FROM orders
      JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey
      LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey) f
        ON l_orderkey = o_orderkey
      LEFT JOIN supplier ON s_suppkey = sk""",
    "con": """
      SELECT k, contract_id, trim(payer_name) AS payer_name, upper(trim(payer_id)) AS payer_id,
        trim(provider_npi) AS provider_npi,
        trim(replace(provider_name, chr(9), ' ')) AS provider_name,
        CAST(nullif(nullif(effective_date, ''), 'null') AS DATE) AS effective_date,
        CAST(nullif(nullif(termination_date, ''), 'null') AS DATE) AS termination_date,
        extracted_at, confidence_score, source_file, loaded_at
      FROM raw WHERE contract_id IS NOT NULL""",
    "rate_line": """
      SELECT con.contract_id, con.payer_id, con.provider_npi,
        con.effective_date AS c_start, con.termination_date AS c_end,
        lower(p_type) || CASE WHEN p_partkey % 50 = 0 AND l_linenumber % 2 = 0
                              THEN '_ALT ' ELSE ' ' END AS cat,
        'P' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS cpt,
        p_name AS descr,
        CASE l_returnflag WHEN 'A' THEN 'per_diem' WHEN 'N' THEN 'PERCENTAGE'
                          ELSE 'Fee_Schedule' END AS rtype,
        CAST(CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN 0
                  WHEN l_partkey % 37 = 0 THEN -l_extendedprice
                  WHEN l_returnflag = 'N' THEN l_discount * 1000
                  ELSE l_extendedprice END AS DECIMAL(12,2)) AS amt,
        CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN 'null'
             ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day_text,
        CASE WHEN l_linestatus = 'F' THEN 'day' END AS unit,
        CAST(NULL AS VARCHAR) AS modi
      FROM lineitem JOIN part ON p_partkey = l_partkey
      JOIN con ON con.k = l_orderkey
      WHERE l_orderkey % 41 <> 0""",
    "amendment_line": """
      SELECT con.contract_id, con.payer_id, con.provider_npi, con.effective_date AS c_start,
        con.termination_date AS c_end,
        CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'AMD-' || event_id END AS aid,
        CASE WHEN event_id % 11 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day_text,
        ' ' || event_type AS descr, props AS chg
      FROM events JOIN con ON con.k = event_id // 3""",
    "rate": """
      SELECT md5(contract_id || '-' || coalesce(cpt, '') || '-' || coalesce(cat, '') || '-' || n)
          AS rate_schedule_id,
        contract_id, payer_id, provider_npi, n AS rate_line_number,
        upper(trim(cat)) AS service_category, trim(cpt) AS cpt_code, trim(descr) AS description,
        upper(trim(rtype)) AS rate_type, amt AS rate_amount,
        CASE WHEN coalesce(day_text, '') IN ('', 'null') THEN c_start
             ELSE CAST(day_text AS DATE) END AS rate_effective_date,
        upper(trim(coalesce(unit, 'EACH'))) AS rate_unit, trim(modi) AS rate_modifier,
        c_start AS contract_effective_date, c_end AS contract_termination_date
      FROM (SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY
              cat NULLS LAST, cpt NULLS LAST, descr NULLS LAST, rtype NULLS LAST, amt NULLS LAST,
              day_text NULLS LAST, unit NULLS LAST, modi NULLS LAST, payer_id NULLS LAST,
              provider_npi NULLS LAST, c_start NULLS LAST, c_end NULLS LAST) AS n
            FROM rate_line WHERE amt > 0)""",
    "amendment": """
      SELECT md5(contract_id || '-' || coalesce(aid, '') || '-' || n) AS amendment_key,
        contract_id, payer_id, provider_npi,
        coalesce(trim(aid), 'AMD-' || contract_id || '-' || n) AS amendment_id,
        n AS amendment_sequence,
        CAST(nullif(nullif(day_text, ''), 'null') AS DATE) AS amendment_effective_date,
        trim(descr) AS amendment_description, 'MODIFICATION' AS amendment_type,
        trim(chg) AS amendment_changes, c_start AS contract_effective_date
      FROM (SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY
              day_text NULLS LAST, aid NULLS LAST, descr NULLS LAST, chg NULLS LAST,
              payer_id NULLS LAST, provider_npi NULLS LAST, c_start NULLS LAST,
              c_end NULLS LAST) AS n
            FROM amendment_line)""",
    "rstat": """
      SELECT contract_id, count(*) AS rate_schedule_count,
        CAST(sum(rate_amount) AS DECIMAL(22,2)) AS total_rate_value,
        {avg} AS avg_rate_amount,
        min(rate_amount) AS min_rate_amount, max(rate_amount) AS max_rate_amount
      FROM rate GROUP BY contract_id""",
    "astat": """
      SELECT contract_id, count(*) AS amendment_count,
        max(amendment_effective_date) AS last_amendment_date
      FROM amendment GROUP BY contract_id""",
    "enriched": f"""
      SELECT con.contract_id, payer_id, payer_name, provider_npi, provider_name, effective_date,
        termination_date,
        date_diff('day', effective_date, coalesce(termination_date, {AS_OF}))
          AS contract_duration_days,
        CASE WHEN termination_date < {AS_OF} THEN 'EXPIRED'
             WHEN effective_date > {AS_OF} THEN 'FUTURE'
             WHEN effective_date IS NULL THEN 'UNKNOWN' ELSE 'ACTIVE' END AS contract_status,
        coalesce(rate_schedule_count, 0) AS rate_schedule_count,
        total_rate_value, avg_rate_amount, min_rate_amount, max_rate_amount,
        coalesce(amendment_count, 0) AS amendment_count, last_amendment_date,
        confidence_score, source_file, extracted_at, loaded_at
      FROM con LEFT JOIN rstat USING (contract_id) LEFT JOIN astat USING (contract_id)""",
    "ref_cat": """
      SELECT DISTINCT lower(p_type) AS category_code, 'Type ' || lower(p_type) AS category_name,
        'All parts of type ' || p_type AS description
      FROM part WHERE p_type <> 'ECONOMY'""",
    "ref_pay": """
      SELECT 'P-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS payer_id,
        n_name AS payer_name,
        CASE n_regionkey WHEN 0 THEN 'COMMERCIAL' WHEN 1 THEN 'HMO' WHEN 2 THEN 'UNLISTED'
                         ELSE 'PPO' END AS payer_type,
        'R' || n_regionkey AS payer_state, 'https://example.com/' || n_nationkey AS payer_website
      FROM nation WHERE n_nationkey % 2 = 0""",
    "norm": f"""
      SELECT r.rate_schedule_id, r.contract_id, r.payer_id, r.provider_npi, r.rate_line_number,
        r.service_category, {{name}} AS service_category_name, r.cpt_code, r.description,
        r.rate_type, r.rate_amount,
        CAST(CASE WHEN r.rate_type = 'PERCENTAGE' AND r.rate_amount > 1
                  THEN r.rate_amount * CAST(0.01 AS DECIMAL(3,2)) ELSE r.rate_amount END
             AS DECIMAL(16,6)) AS normalized_rate,
        r.rate_effective_date, r.rate_unit, r.rate_modifier, r.contract_effective_date,
        r.contract_termination_date,
        CASE WHEN r.contract_termination_date < {AS_OF} THEN 'EXPIRED'
             WHEN r.rate_effective_date > {AS_OF} THEN 'FUTURE' ELSE 'ACTIVE' END AS rate_status,
        e.contract_status
      FROM rate r LEFT JOIN enriched e ON e.contract_id = r.contract_id""",
    "norm_ref": None,
    "d_contract": """
      SELECT md5(contract_id) AS contract_key, contract_id, payer_id, payer_name, provider_npi,
        provider_name, effective_date, termination_date, contract_duration_days, contract_status,
        rate_schedule_count, amendment_count, last_amendment_date, avg_rate_amount,
        confidence_score, source_file, extracted_at,
        TIMESTAMP '1900-01-01 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
        true AS is_current, CAST(1 AS INTEGER) AS version_number
      FROM enriched""",
    "d_payer": f"""
      SELECT md5(p.payer_id) AS payer_key, p.payer_id, p.payer_name,
        CAST(NULL AS VARCHAR) AS payer_type, CAST(NULL AS VARCHAR) AS payer_state,
        CAST(NULL AS VARCHAR) AS payer_website,
        s.total_contracts, s.contracted_providers, s.first_contract_date, s.latest_contract_end,
        CASE WHEN s.latest_contract_end < {AS_OF} THEN 'INACTIVE' ELSE 'ACTIVE' END AS payer_status
      FROM (SELECT DISTINCT payer_id, payer_name FROM con WHERE payer_id IS NOT NULL) p
      JOIN (SELECT payer_id, count(DISTINCT contract_id) AS total_contracts,
              count(DISTINCT provider_npi) AS contracted_providers,
              min(effective_date) AS first_contract_date,
              max(termination_date) AS latest_contract_end
            FROM con GROUP BY payer_id) s ON s.payer_id = p.payer_id""",
    "d_provider": f"""
      SELECT md5(provider_npi) AS provider_key, provider_npi, min(provider_name) AS provider_name,
        count(DISTINCT contract_id) AS total_contracts,
        count(DISTINCT payer_id) AS unique_payers,
        min(effective_date) AS first_contract_date, max(termination_date) AS latest_contract_end,
        CASE WHEN max(termination_date) >= {AS_OF} THEN 'ACTIVE' ELSE 'INACTIVE' END
          AS provider_status
      FROM con WHERE provider_npi IS NOT NULL GROUP BY provider_npi""",
    "d_service": """
      SELECT md5(c.cpt_code) AS service_key, c.cpt_code, c.service_category AS category_code,
        c.service_category AS category_name, CAST(NULL AS VARCHAR) AS category_description,
        s.contracts_with_service, s.providers_offering, s.min_rate, s.max_rate, s.avg_rate
      FROM (SELECT DISTINCT service_category, cpt_code FROM rate WHERE cpt_code IS NOT NULL) c
      JOIN (SELECT cpt_code, count(DISTINCT contract_id) AS contracts_with_service,
              count(DISTINCT provider_npi) AS providers_offering,
              min(rate_amount) AS min_rate, max(rate_amount) AS max_rate, {avg} AS avg_rate
            FROM rate GROUP BY cpt_code) s ON s.cpt_code = c.cpt_code""",
    "d_date": """
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date
      FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM (
        SELECT effective_date AS d FROM con UNION ALL SELECT termination_date FROM con
        UNION ALL SELECT rate_effective_date FROM rate))""",
    "fact": """
      SELECT md5(r.rate_schedule_id || '-' || c.contract_key) AS rate_key, c.contract_key,
        p.provider_key, y.payer_key, s.service_key,
        e.date_key AS effective_date_key, t.date_key AS termination_date_key,
        r.rate_schedule_id, r.contract_id, r.rate_line_number, r.cpt_code, r.rate_amount,
        r.normalized_rate, r.rate_type, r.rate_unit, r.rate_modifier, r.service_category,
        r.service_category_name, r.rate_status, r.contract_status, r.rate_effective_date,
        r.contract_effective_date, r.contract_termination_date
      FROM norm r
      JOIN d_contract c ON c.contract_id = r.contract_id AND c.is_current
      JOIN d_provider p ON p.provider_npi = r.provider_npi
      JOIN d_payer y ON y.payer_id = r.payer_id
      LEFT JOIN d_service s ON s.cpt_code = r.cpt_code
      LEFT JOIN d_date e ON e.full_date = r.rate_effective_date
      LEFT JOIN d_date t ON t.full_date = r.contract_termination_date""",
}

# Mean with six decimals, half up, in exact arithmetic (amounts are positive).
_AVG = (
    "CAST(CAST((CAST(sum(rate_amount) * 100 AS HUGEINT) * 20000 + count(*)) // (2 * count(*)) "
    "AS DECIMAL(25,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(16,6))"
)
for _name in ("rstat", "d_service"):
    RELATIONS[_name] = RELATIONS[_name].replace("{avg}", _AVG)
RELATIONS["norm_ref"] = RELATIONS["norm"].replace(
    "{name}", "coalesce(f.category_name, r.service_category)"
) + " LEFT JOIN ref_cat f ON upper(f.category_code) = upper(r.service_category)"
RELATIONS["norm"] = RELATIONS["norm"].replace("{name}", "r.service_category")

# The nested records: same relations from here on, other sources.
_RECORD_RATES = """
      SELECT con.contract_id, con.payer_id, con.provider_npi, con.effective_date AS c_start,
        con.termination_date AS c_end,
        CASE (k + i) % 4 WHEN 0 THEN NULL WHEN 1 THEN ' lab' WHEN 2 THEN lower(o_orderstatus)
                         ELSE o_orderpriority END AS cat,
        CASE WHEN (k + i) % 13 = 0 THEN NULL ELSE 'X' || ((k * 7 + i) % 500) || ' ' END AS cpt,
        CASE WHEN k % 2 = 0 THEN o_orderpriority END AS descr,
        CASE i WHEN 1 THEN 'per_diem' WHEN 2 THEN 'Percentage' WHEN 3 THEN 'odd' END AS rtype,
        CAST(CASE WHEN (k + i) % 29 = 0 THEN NULL WHEN (k + i) % 31 = 0 THEN 0
                  WHEN i = 2 THEN k % 100 ELSE o_totalprice END AS DECIMAL(12,2)) AS amt,
        CASE i WHEN 2 THEN 'null' WHEN 3 THEN ''
               ELSE strftime(o_orderdate + INTERVAL 1 DAY * (i * 30), '%Y-%m-%d') END AS day_text,
        CASE WHEN i = 1 THEN ' visit' END AS unit,
        CASE WHEN k % 9 = 0 THEN 'M' || i || ' ' END AS modi
      FROM con JOIN orders ON o_orderkey = k, unnest(range(1, 2 + k % 4)) t(i)
      WHERE k % 41 <> 0 AND k % 43 <> 0"""
_RECORD_AMENDMENTS = """
      SELECT con.contract_id, con.payer_id, con.provider_npi, con.effective_date AS c_start,
        con.termination_date AS c_end,
        CASE WHEN k % 6 = 0 AND i = 1 THEN NULL ELSE 'AMD-' || i || ' ' END AS aid,
        CASE WHEN k % 5 = 0 THEN ''
             ELSE strftime(o_orderdate + INTERVAL 1 DAY * (100 - i), '%Y-%m-%d') END AS day_text,
        ' change ' || i AS descr, o_orderpriority AS chg
      FROM con JOIN orders ON o_orderkey = k, unnest(range(1, 2 + k % 2)) t(i)
      WHERE k % 3 = 0"""
_RECORDS = """
      SELECT o_orderkey AS k, 'CON-' || o_orderkey AS contract_id,
        'Payer ' || o_orderkey % 7 AS payer_name,
        CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'pay' || o_orderkey % 7 END AS payer_id,
        CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN '12345'
             WHEN o_orderkey % 67 = 0 THEN '12345678901' WHEN o_orderkey % 71 = 0 THEN '12345abcde'
             ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS provider_npi,
        'Clinic' || chr(9) || o_custkey AS provider_name,
        CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'null'
             ELSE strftime(o_orderdate, '%Y-%m-01') END AS effective_date,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ''
             ELSE strftime(o_orderdate + INTERVAL 1 DAY * (o_orderkey % 900), '%Y-%m-%d') END
          AS termination_date,
        CASE WHEN o_orderkey % 47 = 0 THEN NULL
             ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS extracted_at,
        CAST(CASE WHEN o_orderkey % 53 = 0 THEN 1.5 ELSE (o_orderkey % 101) / 100 END
             AS DECIMAL(5,4)) AS confidence_score,
        'incoming/' || o_orderkey || '.pdf' AS source_file,
        CAST(o_orderdate AS TIMESTAMP) AS loaded_at
      FROM orders"""


def with_relations(select: str, **replaced: str) -> str:
    relations = {**RELATIONS, **replaced}
    listed = ",\n".join(f"{name} AS ({sql})" for name, sql in relations.items())
    return f"WITH {listed}\n{select}"


def _records(select: str, copies: str = _RECORDS) -> str:
    return with_relations(
        select, raw=copies, rate_line=_RECORD_RATES, amendment_line=_RECORD_AMENDMENTS
    )


def _calendar() -> str:
    return with_relations(
        f"""
      SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
        CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(month(d) AS INTEGER) AS month, rpad(monthname(d), 9, ' ') AS month_name,
        strftime(d, '%b') AS month_abbr, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        CAST(dayofweek(d) AS INTEGER) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
        strftime(d, '%a') AS day_abbr, CAST(day(d) AS INTEGER) AS day_of_month,
        CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(year(d) AS INTEGER) AS fiscal_year,
        CAST(quarter(d) AS INTEGER) AS fiscal_quarter,
        dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday,
        strftime(d, '%Y-%m') AS year_month, year(d) || '-Q' || quarter(d) AS year_quarter,
        d = {AS_OF} AS is_today, d = {AS_OF} - 1 AS is_yesterday,
        date_trunc('month', d) = date_trunc('month', {AS_OF}) AS is_current_month,
        date_trunc('year', d) = date_trunc('year', {AS_OF}) AS is_current_year
      FROM (SELECT CAST(unnest(generate_series(min(effective_date), max(termination_date),
                                               INTERVAL 1 DAY)) AS DATE) AS d FROM con)"""
    )


def _dq_report() -> str:
    """One counting SELECT per declared test."""
    names = {
        "stg_contracts": "con",
        "stg_rate_schedules": "rate",
        "stg_amendments": "amendment",
        "int_contracts_enriched": "enriched",
        "dim_contract": "d_contract",
        "dim_provider": "d_provider",
        "dim_payer": "d_payer",
        "dim_service": "d_service",
        "dim_date": "d_date",
        "fact_contracted_rates": "fact",
        "ref_payers": "ref_pay",
        "ref_service_categories": "ref_cat",
    }
    parts = []

    def line(test: str, table: str, column: str, failures: str) -> None:
        parts.append(
            f"SELECT '{test}' AS test, '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(({failures}) AS BIGINT) AS failures, 'warn' AS severity"
        )

    keys = {
        "stg_contracts": ["contract_id"],
        "stg_rate_schedules": ["rate_schedule_id"],
        "stg_amendments": ["amendment_key"],
        "dim_contract": ["contract_key"],
        "dim_provider": ["provider_key", "provider_npi"],
        "dim_payer": ["payer_key", "payer_id"],
        "dim_service": ["service_key", "cpt_code"],
        "dim_date": ["date_key", "full_date"],
        "fact_contracted_rates": ["rate_key"],
        "ref_payers": ["payer_id"],
        "ref_service_categories": ["category_code"],
    }
    required = {
        "stg_contracts": ["payer_id", "provider_npi", "effective_date", "termination_date"],
        "stg_rate_schedules": ["contract_id", "rate_amount"],
        "stg_amendments": ["contract_id"],
        "dim_contract": ["contract_id", "is_current"],
        "fact_contracted_rates": ["contract_key", "provider_key", "payer_key", "rate_amount"],
        "ref_payers": ["payer_name"],
        "ref_service_categories": ["category_name"],
    }
    for table, columns in keys.items():
        for c in columns:
            line(
                "unique", table, c,
                f"SELECT count(*) FROM (SELECT {c} FROM {names[table]} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1)",
            )
        for c in columns + required.get(table, []):
            line(
                "not_null", table, c,
                f"SELECT count(*) FROM {names[table]} WHERE {c} IS NULL",
            )
    for table, c, values in (
        ("int_contracts_enriched", "contract_status", CONTRACT_STATUSES),
        ("stg_rate_schedules", "rate_type", RATE_TYPES),
        ("stg_amendments", "amendment_type", AMENDMENT_TYPES),
        ("ref_payers", "payer_type", PAYER_TYPES),
    ):
        line(
            "accepted_values", table, c,
            f"SELECT count(*) FROM {names[table]} WHERE {c} NOT IN {tuple(values)}",
        )
    for table in ("stg_rate_schedules", "fact_contracted_rates"):
        line(
            "accepted_range", table, "rate_amount",
            f"SELECT count(*) FROM {names[table]} WHERE NOT rate_amount > 0",
        )
    for table, c, parent in (
        ("stg_rate_schedules", "contract_id", "stg_contracts"),
        ("stg_amendments", "contract_id", "stg_contracts"),
        ("fact_contracted_rates", "contract_key", "dim_contract"),
        ("fact_contracted_rates", "provider_key", "dim_provider"),
        ("fact_contracted_rates", "payer_key", "dim_payer"),
    ):
        line(
            "relationships", table, c,
            f"SELECT count(*) FROM {names[table]} x ANTI JOIN {names[parent]} y ON x.{c} = y.{c} "
            f"WHERE x.{c} IS NOT NULL",
        )
    line(
        "positive_rates", "fact_contracted_rates", "rate_amount",
        "SELECT count(*) FROM fact WHERE rate_amount <= 0",
    )
    line(
        "valid_contract_dates", "dim_contract", "termination_date",
        "SELECT count(*) FROM d_contract WHERE termination_date < effective_date AND is_current",
    )
    materialized = with_relations("\nUNION ALL ".join(parts))
    for name in names.values():
        materialized = materialized.replace(f"\n{name} AS (", f"\n{name} AS MATERIALIZED (")
    return materialized


def _history(repeated: bool = False) -> str:
    columns = (
        "contract_id, payer_id, payer_name, provider_npi, provider_name, effective_date, "
        "termination_date, contract_status, contract_duration_days, extracted_at, "
        "confidence_score, source_file, loaded_at"
    )
    version = (
        "md5(contract_id || '|' || '{at}.000000') AS dbt_scd_id, TIMESTAMP '{at}' AS dbt_updated_at, "
        "TIMESTAMP '{at}' AS dbt_valid_from"
    )
    first, second = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    compared = (
        "payer_id payer_name provider_npi provider_name effective_date termination_date "
        "contract_status"
    ).split()
    changed = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in compared)
    if repeated:
        renamed = "SELECT * REPLACE (payer_name || {} AS payer_name) FROM {} WHERE k % 4 = 0"
        return with_relations(
            f"""
      , base AS (SELECT *, 'ACTIVE' AS contract_status,
          date_diff('day', effective_date, termination_date) AS contract_duration_days FROM con),
      a1 AS (SELECT * FROM base WHERE k % 13 <> 0 OR k % 91 = 0),
      b1 AS (SELECT * REPLACE (
          CASE WHEN k % 10 = 0 THEN payer_name || ' NEW' ELSE payer_name END AS payer_name,
          CASE WHEN k % 15 = 0 THEN 'EXPIRED' ELSE 'ACTIVE' END AS contract_status)
        FROM base WHERE k % 7 <> 0),
      a AS (SELECT {columns} FROM (
        SELECT * FROM a1 UNION ALL {renamed.format("' B'", "a1")})),
      b AS (SELECT {columns} FROM (
        SELECT * FROM b1
        UNION ALL {renamed.format("CASE WHEN k % 8 = 0 THEN ' B' ELSE ' C' END", "b1")}))
      SELECT {columns}, {version.format(at=first)},
        CASE WHEN contract_id IN (SELECT contract_id FROM b) AND NOT EXISTS (
               SELECT 1 FROM b WHERE b.contract_id = a.contract_id AND NOT ({changed}))
             THEN TIMESTAMP '{second}' END AS dbt_valid_to
      FROM a
      UNION ALL
      SELECT {columns}, {version.format(at=second)}, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
      FROM b WHERE NOT EXISTS (
        SELECT 1 FROM a WHERE a.contract_id = b.contract_id AND NOT ({changed}))"""
        ).replace("\n\n      , base", ",\n base")
    return with_relations(
        f"""
      , base AS (SELECT *, 'ACTIVE' AS contract_status,
          date_diff('day', effective_date, termination_date) AS contract_duration_days FROM con),
      a AS (SELECT {columns} FROM base WHERE k % 13 <> 0 OR k % 91 = 0),
      b AS (SELECT {columns} FROM (SELECT * REPLACE (
          CASE WHEN k % 10 = 0 THEN payer_name || ' NEW' ELSE payer_name END AS payer_name,
          CASE WHEN k % 15 = 0 THEN 'EXPIRED' ELSE 'ACTIVE' END AS contract_status)
        FROM base WHERE k % 7 <> 0)),
      fresh AS (SELECT b.*, a.contract_id IS NOT NULL AS known FROM b
        LEFT JOIN a ON a.contract_id = b.contract_id WHERE a.contract_id IS NULL OR {changed})
      SELECT {columns}, {version.format(at=first)},
        CASE WHEN contract_id IN (SELECT contract_id FROM fresh WHERE known)
             THEN TIMESTAMP '{second}' END AS dbt_valid_to
      FROM a
      UNION ALL
      SELECT {columns}, {version.format(at=second)}, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
      FROM fresh"""
    ).replace("\n\n      , base", ",\n base")


# --- extraction ------------------------------------------------------------

_MONEY = "'$' || format('{:,.2f}', o_totalprice)"
_START = """CASE k % 3 WHEN 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                       WHEN 1 THEN strftime(o_orderdate, '%-m-%-d-%y')
                       ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
_END = "strftime(o_orderdate + INTERVAL 730 DAY, '%m/%d/%Y')"
TEXTS = f"""
  SELECT *, 'incoming/' || k || '.pdf' AS source_file, concat_ws(chr(10),
    CASE k % 5 WHEN 0 THEN 'Contract Number: CTR-' || k WHEN 1 THEN 'Agreement No AG-' || k
               WHEN 2 THEN 'CTR: ' || k WHEN 3 THEN 'Contract Notice' ELSE 'No reference' END,
    CASE k % 7 WHEN 0 THEN 'Payer: Aetna' WHEN 1 THEN 'insurance: State Blue Cross'
               WHEN 2 THEN 'covered by Humana only' WHEN 3 THEN 'Plan - Kaiser'
               WHEN 4 THEN 'Payer: ' || lower(c_mktsegment) || ' cigna' ELSE 'self pay' END,
    CASE k % 4 WHEN 0 THEN 'Provider: ' || c_mktsegment || ' Medical Center'
               WHEN 1 THEN 'Facility: ' || upper(left(c_mktsegment, 1))
                           || lower(substr(c_mktsegment, 2)) || ' Clinic'
               WHEN 2 THEN 'Provider: none' ELSE '' END,
    CASE WHEN k % 6 = 5 THEN 'NPI pending'
         ELSE 'NPI: ' || lpad(CAST(k AS VARCHAR), 10, '1') || CASE WHEN k % 9 = 0 THEN '77' ELSE '' END END,
    CASE k % 8 WHEN 7 THEN 'undated'
               WHEN 6 THEN 'Effective ' || strftime(o_orderdate, '%Y/%-m/%-d')
               WHEN 5 THEN 'term begins: ' || {_START}
               WHEN 4 THEN 'Effective Date: 13/45/2001'
               WHEN 3 THEN 'Effective Date: 1/2/' || (60 + k % 20)
               ELSE 'Effective Date: ' || {_START} END,
    CASE k % 5 WHEN 0 THEN 'Termination Date: ' || {_END} WHEN 1 THEN 'expiration date ' || {_END}
               WHEN 2 THEN 'expires ' || {_END} ELSE 'evergreen' END,
    CASE WHEN k % 3 = 0 THEN 'Amendment No. 1: rate change effective: ' || {_START} || '. Terms of '
                             || c_name ELSE 'no change' END,
    CASE WHEN k % 6 = 0 THEN 'AMENDMENT #2 extension for ' || o_orderpriority ELSE '' END) AS text
  FROM (SELECT *, o_orderkey AS k FROM orders JOIN customer ON c_custkey = o_custkey)"""
# Rate lines of the text documents: what each table layout leads to.
TEXT_RATES = f"""
  SELECT source_file, c_mktsegment AS service_category, CAST(o_custkey AS VARCHAR) AS cpt_code,
    'PER_DIEM' AS rate_type, o_totalprice AS rate_amount FROM texts WHERE k % 4 = 0
  UNION ALL
  SELECT source_file, o_orderpriority, 'X2', 'FEE_SCHEDULE', CAST(k AS DOUBLE)
  FROM texts WHERE k % 4 = 0
  UNION ALL
  SELECT source_file, c_mktsegment, NULL, 'FEE_SCHEDULE', 75.5 FROM texts WHERE k % 4 = 1
  UNION ALL
  SELECT source_file, NULL, 'C1', 'FEE_SCHEDULE', o_totalprice FROM texts WHERE k % 4 = 2"""


def _first(text: str, patterns: tuple) -> str:
    found = ", ".join(f"nullif(regexp_extract({text}, '{p}', 1, 'i'), '')" for p, _ in patterns)
    return f"coalesce({found})"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def _iso(text: str) -> str:
    """Trial parses; the widths are checked because strptime is lenient about them."""
    trials = [
        (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%m/%d/%Y"),
        (r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "%m-%d-%Y"),
        (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "%Y/%m/%d"),
        (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "%Y-%m-%d"),
        (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "%m/%d/%y"),
        (r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$", "%m-%d-%y"),
    ]
    cases = " ".join(
        f"WHEN regexp_matches({text}, '{p}') THEN try_strptime({text}, '{f}')" for p, f in trials
    )
    return f"strftime(CASE {cases} END, '%Y-%m-%d')"


_AMENDED = f"""
  SELECT source_file, 'AMD-' || regexp_extract(block, '^\\s*(?:#|No\\.?)?\\s*(\\d+)', 1, 'i')
      AS amendment_id,
    {_strip("left(regexp_extract(block, '^\\s*(?:#|No\\.?)?\\s*\\d+[:\\s]*(.*)$', 1, 'is'), 500)")}
      AS description
  FROM (SELECT source_file, unnest(regexp_split_to_array(text, '(?i)Amendment')[2:]) AS block
        FROM texts)
  WHERE regexp_matches(block, '^\\s*(?:#|No\\.?)?\\s*\\d+', 'i')"""


def _fields(texts: str, rates: str, amended: str, scale: str = "") -> str:
    """Header fields, counts and score; `rates` and `amended` are (source_file) lists."""
    weights = " + ".join(
        f"CASE WHEN {'rate_lines > 0' if c == 'rate_schedules' else c + ' IS NOT NULL'} "
        f"THEN {w} ELSE 0 END"
        for c, w in extraction.WEIGHTS.items()
    )
    return f"""WITH texts AS ({texts}), rates AS ({rates}), amended AS ({amended}),
    found AS (SELECT source_file,
      coalesce({_first("text", extraction.CONTRACT_ID)},
               'CTR-20240115103000-' || left(md5(source_file), 12)) AS contract_id,
      {_strip(_first("text", extraction.PAYER))} AS payer_name,
      {_first("text", extraction.NPI)} AS provider_npi,
      {_strip(_first("text", extraction.PROVIDER))} AS provider_name,
      {_first("text", extraction.EFFECTIVE_DATE)} AS s,
      {_first("text", extraction.TERMINATION_DATE)} AS e
      FROM texts),
    parsed AS (SELECT found.*, {_iso("s")} AS effective_date, {_iso("e")} AS termination_date,
      upper(array_to_string(list_transform(regexp_split_to_array(payer_name, '\\s+')[1:2],
                                           lambda w: left(w, 1)), '')) || '-001' AS payer_id,
      coalesce(r.n, 0) AS rate_lines, coalesce(a.n, 0) AS amendments
      FROM found
      LEFT JOIN (SELECT source_file, count(*) AS n FROM rates GROUP BY 1) r USING (source_file)
      LEFT JOIN (SELECT source_file, count(*) AS n FROM amended GROUP BY 1) a USING (source_file))
    SELECT contract_id, payer_name, payer_id, provider_npi, provider_name, effective_date,
      termination_date, rate_lines, amendments, source_file,
      CAST((CAST({weights} AS DECIMAL(5,4))){scale} AS DECIMAL(5,4)) AS confidence_score
    FROM parsed"""


_NONE = "SELECT source_file FROM texts WHERE false"

# --- messages --------------------------------------------------------------

_ROUTED = """
  SELECT * FROM (
    SELECT page_id, CASE WHEN page_id % 17 = 0 OR page_id % 11 = 0 THEN NULL
             WHEN page_id % 5 = 0 THEN 'other' ELSE 'raw' END AS bucket,
      CASE WHEN page_id % 17 = 0 OR page_id % 11 = 0 OR page_id % 13 = 0 THEN NULL
           ELSE 'incoming/' || url || CASE page_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN ' copy.pdf'
                                                      WHEN 2 THEN '.txt' ELSE '.pdf' END
      END AS object_key,
      CASE WHEN page_id % 17 = 0 THEN 'malformed' WHEN page_id % 11 = 0 THEN 'no_records'
           WHEN page_id % 5 = 0 THEN 'foreign_bucket' WHEN page_id % 13 = 0 THEN 'no_key'
           WHEN page_id % 4 = 2 THEN 'not_pdf' ELSE 'accepted' END AS outcome
    FROM pages)"""


# Documents that messages named: of whole messages, in the right bucket, there and with text.
_NAMED = f"""
  SELECT * REPLACE (replace(text, 'Contract Notice', 'Notice') AS text), k // 3 AS number,
    CASE WHEN k // 3 % 17 = 0 THEN 'malformed' WHEN k % 10 = 7 THEN 'foreign_bucket'
         WHEN k % 11 = 3 THEN 'not_pdf' WHEN k % 13 = 5 THEN 'no_document'
         WHEN k % 31 = 6 THEN 'no_text' END AS problem
  FROM ({TEXTS})"""


def _landed(select: str) -> str:
    """The records of the documents that messages named, with the relations after them."""
    records = _fields(f"SELECT * FROM ({_NAMED}) WHERE problem IS NULL", TEXT_RATES, _AMENDED)
    return with_relations(
        select,
        raw=f"""SELECT CAST(regexp_extract(source_file, '[0-9]+') AS BIGINT) AS k, contract_id,
            payer_name, payer_id, provider_npi, provider_name, effective_date, termination_date,
            '2024-01-15T10:30:00.000000Z' AS extracted_at, confidence_score, source_file,
            CAST(NULL AS TIMESTAMP) AS loaded_at FROM ({records})""",
        rate_line=f"""
      SELECT con.contract_id, con.payer_id, con.provider_npi, con.effective_date AS c_start,
        con.termination_date AS c_end, service_category AS cat, cpt_code AS cpt,
        CAST(NULL AS VARCHAR) AS descr, rate_type AS rtype,
        CAST(rate_amount AS DECIMAL(12,2)) AS amt, CAST(NULL AS VARCHAR) AS day_text,
        CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS VARCHAR) AS modi
      FROM con JOIN (WITH texts AS ({TEXTS}) {TEXT_RATES}) USING (source_file)""",
        amendment_line=RELATIONS["amendment_line"] + " WHERE false",
    )


def _validation() -> str:
    """Problems per record, in field order."""
    return _records(
        """
      , elements AS (
        SELECT k, 1 AS part, i, 1 AS rule,
          CASE WHEN i = 4 THEN 'rate_schedules.' || (i - 1) || '.rate_type: Input should be a valid string' END
            AS problem
        FROM (SELECT k, unnest(range(1, 2 + k % 4)) AS i FROM raw WHERE k % 41 <> 0 AND k % 43 <> 0)
        UNION ALL
        SELECT k, 1, i, 2, 'rate_schedules.' || (i - 1) || '.rate_amount: '
          || CASE WHEN a IS NULL THEN 'Input should be a valid number'
                  WHEN a <= 0 THEN 'Input should be greater than 0' END
        FROM (SELECT k, i, CASE WHEN (k + i) % 29 = 0 THEN NULL WHEN (k + i) % 31 = 0 THEN 0
                                WHEN i = 2 THEN k % 100 ELSE o_totalprice END AS a
              FROM (SELECT k, unnest(range(1, 2 + k % 4)) AS i FROM raw
                    WHERE k % 41 <> 0 AND k % 43 <> 0) JOIN orders ON o_orderkey = k)
        UNION ALL
        SELECT k, 2, 1, 1, 'amendments.0.amendment_id: Input should be a valid string'
        FROM raw WHERE k % 6 = 0
        UNION ALL
        SELECT k, 0, 0, 1, 'provider_npi: ' || CASE WHEN provider_npi IS NULL THEN 'Input should be a valid string'
          WHEN length(provider_npi) < 10 THEN 'String should have at least 10 characters'
          WHEN length(provider_npi) > 10 THEN 'String should have at most 10 characters'
          WHEN NOT regexp_full_match(provider_npi, '[0-9]+')
          THEN 'Value error, NPI must contain only digits' END FROM raw
        UNION ALL
        SELECT k, 0, 0, 2, 'effective_date: ' || CASE WHEN effective_date IS NULL
          THEN 'Input should be a valid string' WHEN effective_date = 'null'
          THEN 'Value error, Date must be in YYYY-MM-DD format' END FROM raw
        UNION ALL
        SELECT k, 0, 0, 3, 'termination_date: Value error, Date must be in YYYY-MM-DD format'
        FROM raw WHERE termination_date = ''
        UNION ALL
        SELECT k, 3, 0, 1, 'extraction_metadata.extracted_at: Input should be a valid string'
        FROM raw WHERE extracted_at IS NULL
        UNION ALL
        SELECT k, 3, 0, 2, 'extraction_metadata.confidence_score: Input should be less than or equal to 1'
        FROM raw WHERE confidence_score > 1),
      problems AS (SELECT k, string_agg(problem, '; ' ORDER BY part, i, rule) AS errors
                   FROM elements WHERE problem IS NOT NULL GROUP BY k),
      types AS (SELECT k, string_agg(CASE i WHEN 1 THEN 'PER_DIEM' WHEN 2 THEN 'PERCENTAGE'
                                            ELSE 'FEE_SCHEDULE' END, ',' ORDER BY i) AS rate_types
                FROM (SELECT k, unnest(range(1, 2 + k % 4)) AS i FROM raw
                      WHERE k % 41 <> 0 AND k % 43 <> 0) GROUP BY k)
      SELECT contract_id, errors IS NULL AS is_valid, coalesce(errors, '') AS errors,
        CASE WHEN k % 41 = 0 THEN NULL ELSE coalesce(rate_types, '') END AS rate_types,
        CASE WHEN k % 3 <> 0 THEN NULL WHEN k % 2 = 0 THEN 'EXTENSION'
             ELSE 'MODIFICATION,MODIFICATION' END AS amendment_types
      FROM raw LEFT JOIN problems USING (k) LEFT JOIN types USING (k)"""
    ).replace("\n\n      , elements", ",\n elements")


ORACLE: dict[str, str] = {
    "raw_contracts": with_relations(
        "SELECT contract_id, payer_name, payer_id, provider_npi, provider_name, effective_date, "
        "termination_date FROM raw"
    ),
    "stg_contracts": with_relations("SELECT * EXCLUDE (k) FROM con"),
    "stg_rate_schedules": with_relations("SELECT * FROM rate"),
    "stg_amendments": with_relations("SELECT * FROM amendment"),
    "rate_stats": with_relations("SELECT * FROM rstat"),
    "amendment_stats": with_relations("SELECT * FROM astat"),
    "int_contracts_enriched": with_relations("SELECT * FROM enriched"),
    "int_rates_normalized": with_relations("SELECT * FROM norm"),
    "int_rates_normalized_ref": with_relations("SELECT * FROM norm_ref"),
    "dim_contract": with_relations("SELECT * FROM d_contract"),
    "dim_payer": with_relations("SELECT * FROM d_payer"),
    "dim_payer_ref": with_relations(
        "SELECT d.* REPLACE (r.payer_type AS payer_type, r.payer_state AS payer_state, "
        "r.payer_website AS payer_website) FROM d_payer d LEFT JOIN ref_pay r "
        "ON r.payer_id = d.payer_id"
    ),
    "dim_payer_deduped": with_relations(
        "SELECT * FROM d_payer QUALIFY row_number() OVER (PARTITION BY payer_id "
        "ORDER BY payer_name NULLS LAST) = 1"
    ),
    "dim_provider": with_relations("SELECT * FROM d_provider"),
    "dim_service": with_relations("SELECT * FROM d_service"),
    "dim_service_ref": with_relations(
        "SELECT d.* REPLACE (r.category_name AS category_name, r.description AS "
        "category_description) FROM d_service d LEFT JOIN ref_cat r "
        "ON upper(r.category_code) = upper(d.category_code)"
    ),
    "dim_service_deduped": with_relations(
        "SELECT * FROM d_service QUALIFY row_number() OVER (PARTITION BY cpt_code "
        "ORDER BY category_code NULLS LAST) = 1"
    ),
    "dim_date": _calendar(),
    "fact_contracted_rates": with_relations("SELECT * FROM fact"),
    "published_fact": with_relations("SELECT * FROM fact"),
    "published_contract_totals": with_relations(
        "SELECT c.contract_id, c.contract_duration_days, count(rate_amount) AS lines, "
        "CAST(sum(rate_amount) AS DECIMAL(22,2)) AS value, max(cpt_code) AS last_code "
        "FROM d_contract c LEFT JOIN fact f ON f.contract_key = c.contract_key "
        "GROUP BY c.contract_key, c.contract_id, c.contract_duration_days"
    ),
    "published_payers": with_relations(
        "SELECT d.* REPLACE (r.payer_type AS payer_type, r.payer_state AS payer_state, "
        "r.payer_website AS payer_website) FROM d_payer d LEFT JOIN ref_pay r "
        "ON r.payer_id = d.payer_id"
    ),
    "fact_of_documents": _records("SELECT * FROM fact"),
    "fact_of_latest_documents": _records("SELECT * FROM fact"),
    "fact_of_reloaded_documents": _records(
        "SELECT * FROM fact", _RECORDS + f" UNION ALL {_RECORDS} WHERE o_orderkey % 10 = 0"
    ),
    "dq_report": _dq_report(),
    "contract_history_two_loads": _history(),
    "contract_history_merged": _history(),
    "contract_history_repeated_ids": _history(repeated=True),
    "rates_of_documents": _records("SELECT * FROM rate"),
    "amendments_of_documents": _records("SELECT * FROM amendment"),
    "json_roundtrip": _records(
        "SELECT contract_id, payer_id, provider_npi, c_start AS contract_effective_date, "
        "c_end AS contract_termination_date, cat AS service_category, cpt AS cpt_code, "
        "descr AS description, rtype AS rate_type, amt AS rate_amount, "
        "day_text AS rate_date_text, unit AS rate_unit, modi AS modifier FROM rate_line"
    ),
    "load_new_contracts": _records(
        "SELECT source_file, CAST(1 AS BIGINT) AS copies, CAST(CASE WHEN k % 41 = 0 THEN NULL "
        "WHEN k % 43 = 0 THEN 0 ELSE 1 + k % 4 END AS BIGINT) AS lines FROM raw"
    ),
    "validate_contracts": _validation(),
    "extract_fields": _fields(TEXTS, TEXT_RATES, _AMENDED),
    "extract_fields_without_tables": _fields(TEXTS, _NONE, _NONE, " * 0.7"),
    "extract_rate_rows": f"WITH texts AS ({TEXTS}) {TEXT_RATES}",
    "extract_amendments": f"""WITH texts AS ({TEXTS}), amended AS ({_AMENDED})
      SELECT source_file, amendment_id,
        {_iso("(" + _first("description", extraction.AMENDMENT_DATE) + ")")} AS amendment_date,
        description, 'MODIFICATION' AS amendment_type FROM amended""",
    "extract_documents": _fields(
        "SELECT 'documents/' || doc_id AS source_file, text FROM documents", _NONE, _AMENDED
    ),
    "route_messages": f"SELECT bucket, object_key, outcome FROM ({_ROUTED})",
    "stream_messages": f"""SELECT CASE WHEN outcome = 'accepted' THEN object_key END AS object_key,
        outcome, count(*) AS messages FROM ({_ROUTED})
      WHERE outcome IN ('accepted', 'no_key', 'malformed') GROUP BY ALL""",
    "stream_documents": _fields(TEXTS, TEXT_RATES, _AMENDED),
    "split_tables": f"WITH texts AS ({TEXTS}) {TEXT_RATES}",
    "contracts_of_payers": _records(
        """SELECT contract_id, coalesce(payer_id, 'unknown') AS payer,
          effective_date AS contract_date
        FROM raw WHERE coalesce(payer_id, 'unknown') IN ('pay3', 'unknown')
          AND effective_date < '1998-01-01'"""
    ),
    "pdf_bytes": """
      SELECT page_id || CASE page_id % 3 WHEN 0 THEN '.PDF' ELSE '.pdf' END AS name,
        CAST(strlen(coalesce(html, '')) AS BIGINT) AS bytes, sha256(coalesce(html, '')) AS sha256,
        CAST(strlen(coalesce(html, '')) AS BIGINT) AS streamed_bytes, true AS listed
      FROM pages WHERE page_id % 3 < 2""",
    "rejected_documents": f"""
      SELECT CASE WHEN k % 29 <> 4 THEN source_file END AS source_file,
        CASE WHEN k % 29 = 4 THEN left('{{"source_file":"' || source_file || '",', 25) END AS line,
        'txt' AS kind
      FROM ({TEXTS}) WHERE k % 29 = 4 OR k % 31 = 6""",
    "documents_to_fact": _landed("SELECT * FROM fact"),
    "landed_objects": _landed(
        """SELECT 'payer=' || coalesce(payer_id, 'unknown') AS payer,
          'contract_date=' || coalesce(effective_date, CAST(current_date AS VARCHAR)) AS day,
          k || '.json' AS name FROM raw"""
    ),
    "rejected_deliveries": f"""
      SELECT CASE k % 13 = 5 WHEN true THEN 'missing/' ELSE 'incoming/' END || k || '.pdf' AS message,
        problem, CAST(3 AS BIGINT) AS attempts
      FROM ({_NAMED}) WHERE problem IN ('no_document', 'no_text')
      UNION ALL
      SELECT DISTINCT 'broken ' || number || ' {{"Records":[{{"s3":{{"', 'malformed', 3
      FROM ({_NAMED}) WHERE problem = 'malformed'""",
}
