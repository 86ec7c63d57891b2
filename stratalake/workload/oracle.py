"""DuckDB SQL for each query of the catalogue, written independently of the Spark code."""

from __future__ import annotations

# 2024-01-01 00:00:00 UTC, the catalogue's fixed clock.
_EPOCH = "1704067200::bigint"

# Chains of common table expressions; each name builds on those before it.
_RAW = """
orders_of as (
  select o_custkey, count(*) as n, sum(cast(o_totalprice as decimal(10,2))) as total
  from orders group by o_custkey),
records as (
  select cast(c_custkey as int) as customerid,
    case when c_custkey%17=0 then null else cast(18+(c_custkey*7)%63 as int) end as age,
    case when c_custkey%23=0 then null when c_custkey%2=0 then ' Male' else 'FEMALE ' end as gender,
    case when c_custkey%29=0 then null when c_custkey%19=0 then 0 else cast(n*3 as int) end as tenure,
    cast(abs(c_acctbal) as decimal(10,2)) as monthlycharges,
    case c_mktsegment when 'BUILDING' then 'Month-to-Month' when 'AUTOMOBILE' then ' One-Year'
      when 'MACHINERY' then 'TWO-YEAR ' when 'HOUSEHOLD' then 'month-to-month' end as contracttype,
    case c_nationkey%4 when 0 then 'DSL' when 1 then 'Fiber Optic' when 3 then 'dsl ' end
      as internetservice,
    case when c_custkey%37=0 then null else cast(total as decimal(10,2)) end as totalcharges,
    case c_nationkey%3 when 0 then 'Yes' when 1 then 'No' end as techsupport,
    case when c_custkey%31=0 then null when c_custkey%5=0 then 'Yes' when c_custkey%5=1 then ' YES '
      else 'No' end as churn
  from customer join orders_of on c_custkey = o_custkey),
delivered as (
  select *, unnest(range(case when customerid%11=0 then 2 else 1 end)) as delivery from records),
subscriber_raw as (select * exclude (delivery) from delivered)"""

_RAW_CORRECTED = _RAW.replace(
    "select * exclude (delivery) from delivered",
    "select * exclude (delivery) replace (cast(age + delivery as int) as age) from delivered",
)

_RAW_MISSING_IDS = _RAW.replace(
    "select * exclude (delivery) from delivered",
    "select * exclude (delivery) replace (case when customerid%10<>0 then customerid end as customerid) from delivered",
)

_DISTINCT = """,
unique_raw as (select distinct * from subscriber_raw)"""

# Medians in whole units (months, years, cents), then half-up.
_BRONZE = _DISTINCT + """,
medians as (
  select floor(median(customerid)+0.5) as id_m, floor(median(age)+0.5) as age_m,
    floor(median(tenure)+0.5) as tenure_m,
    floor(median(cast(monthlycharges*100 as bigint))+0.5) as monthly_m,
    floor(median(cast(totalcharges*100 as bigint))+0.5) as total_m
  from unique_raw),
bronze as (
  select cast(coalesce(customerid, id_m) as int) as customerid,
    cast(coalesce(age, age_m) as int) as age, coalesce(gender, 'Unknown') as gender,
    cast(coalesce(tenure, tenure_m) as int) as tenure,
    coalesce(monthlycharges, cast(monthly_m/100 as decimal(10,2))) as monthlycharges,
    coalesce(contracttype, 'Unknown') as contracttype,
    coalesce(internetservice, 'Unknown') as internetservice,
    coalesce(totalcharges, cast(total_m/100 as decimal(10,2))) as totalcharges,
    coalesce(techsupport, 'Unknown') as techsupport, coalesce(churn, 'Unknown') as churn
  from unique_raw, medians)"""


def _filled(columns: list[str]) -> str:
    return " + ".join(f"case when {c} is null then 0 else 1 end" for c in columns)


_RAW_COLUMNS = [
    "customerid", "age", "gender", "tenure", "monthlycharges", "contracttype",
    "internetservice", "totalcharges", "techsupport", "churn",
]


def _silver(source: str, audit: int) -> str:
    """Silver over `source`; `audit` is the number of never-null audit columns it carries."""
    return f""",
spent as (
  select *, substr(sha256(cast(customerid as varchar)), 1, 16) as pseudonym,
    case when tenure > 0
      then (cast(totalcharges*100 as bigint)*2 + tenure) // (2*tenure) / 100.0 else 0.0 end as spend
  from {source}),
silver as (
  select pseudonym as customer_id_anonymized, age, trim(lower(gender)) as gender, tenure,
    monthlycharges as monthly_charges, trim(lower(contracttype)) as contract_type,
    trim(lower(internetservice)) as internet_service, totalcharges as total_charges,
    trim(lower(techsupport)) as tech_support, trim(lower(churn)) as churn,
    cast(spend as double) as avg_monthly_spend,
    round(({_filled([*_RAW_COLUMNS, "pseudonym", "spend"])} + {audit}) / {12.0 + audit}, 2)
      as data_quality_score
  from spent)"""


_SILVER = _silver("bronze", 3)

_DIMS = """,
dim_customer as (
  select cast(row_number() over (order by customer_id_anonymized nulls first, age nulls first,
      gender nulls first, tenure nulls first) as bigint) as customer_sk,
    customer_id_anonymized, age, gender, tenure as tenure_months,
    case when tenure <= 12 then '0-12 months' when tenure <= 24 then '13-24 months'
      when tenure <= 48 then '25-48 months' else '49+ months' end as tenure_category,
    1704067200::bigint as effective_date, true as is_current
  from (select distinct customer_id_anonymized, age, gender, tenure from silver)),
dim_service as (
  select internet_service, tech_support,
    case when internet_service <> 'unknown' and tech_support = 'yes' then 'Premium'
      when internet_service <> 'unknown' then 'Standard' else 'Basic' end as service_bundle_type,
    cast(row_number() over (order by internet_service nulls first, tech_support nulls first)
      as bigint) as service_sk
  from (select distinct internet_service, tech_support from silver)),
dim_contract as (
  select contract_type,
    cast(case contract_type when 'month-to-month' then 1 when 'one-year' then 12
      when 'two-year' then 24 else 0 end as int) as contract_duration_months,
    cast(row_number() over (order by contract_type nulls first) as bigint) as contract_sk
  from (select distinct contract_type from silver))"""


# Each silver row meets the dimension row with its own attributes.
_OWN = """s.customer_id_anonymized is not distinct from d.customer_id_anonymized
      and s.age is not distinct from d.age and s.gender is not distinct from d.gender
      and s.tenure is not distinct from d.tenure_months"""


def _fact(equals: str = "=", dim: str = "dim_customer", customer: str = "") -> str:
    return f""",
measured as (
  select d.customer_sk, v.service_sk, c.contract_sk,
    cast(s.monthly_charges as double) as monthly_charges,
    cast(s.total_charges as double) as total_charges, s.avg_monthly_spend,
    cast(s.tenure * s.monthly_charges as double) as total_revenue,
    coalesce(s.churn = 'yes', false) as is_churned,
    cast(case when s.churn = 'yes' then 1.0 when s.tenure < 12 then 0.7 else 0.3 end as double)
      as churn_risk_score
  from silver s join {dim} d on {customer or f"s.customer_id_anonymized {equals} d.customer_id_anonymized"}
    join dim_service v on s.internet_service {equals} v.internet_service
      and s.tech_support {equals} v.tech_support
    join dim_contract c on s.contract_type {equals} c.contract_type),
fact as (
  select cast(row_number() over (order by customer_sk, service_sk, contract_sk,
      monthly_charges nulls first, total_charges nulls first, avg_monthly_spend nulls first,
      total_revenue nulls first, is_churned, churn_risk_score) as bigint) as fact_sk, *,
    cast(1 as int) as date_sk, 1704067200::bigint as created_timestamp,
    1704067200::bigint as updated_timestamp
  from measured)"""


_PICKED = """,
picked_customer as (
  select customer_id_anonymized,
    first(customer_sk order by tenure_months desc nulls last, customer_sk desc) as customer_sk
  from dim_customer group by customer_id_anonymized)"""

_GOLD = _RAW + _BRONZE + _SILVER + _DIMS + _fact()

_REPORT = """
select contract_type, internet_service, cast(count(customer_sk) as bigint) as customer_count,
  cast(count(*) filter (where is_churned) as double) / count(*) * 100 as churn_rate_percent
from fact join dim_contract using (contract_sk) join dim_service using (service_sk)
group by contract_type, internet_service"""

_DOUBLE_MONEY = """replace (cast(monthlycharges as double) as monthlycharges,
  cast(totalcharges as double) as totalcharges)"""

_SILVER_SHOWN = f"""select * replace (cast(monthly_charges as double) as monthly_charges,
  cast(total_charges as double) as total_charges),
  {_EPOCH} as transformation_timestamp, 'pyspark_silver' as source_pipeline from silver"""

_CLEAN = """,
clean as (
  select customerid, tenure, monthlycharges as monthly_charges,
    trim(lower(contracttype)) as contract_type, trim(lower(internetservice)) as internet_service,
    trim(lower(techsupport)) as tech_support, trim(lower(churn)) as churn from subscriber_raw)"""


def _with(ctes: str, select: str) -> str:
    return f"with {ctes.strip().lstrip(',')}\n{select}"


def _check(name: str, table: str, violations: str) -> str:
    return (
        f"select '{name}' as \"check\", '{table}' as \"table\", "
        f"cast(({violations}) as bigint) as violations"
    )


def _union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


def _repeated(table: str, keys: str) -> str:
    return f"select count(*) from (select 1 from {table} group by {keys} having count(*) > 1)"


def _unique(table: str, keys: str, source: str | None = None) -> str:
    return _check(f"unique({keys})", table, _repeated(source or table, keys))


def _where(name: str, table: str, condition: str, source: str | None = None) -> str:
    return _check(name, table, f"select count(*) from {source or table} where {condition}")


def _too_long(table: str, column: str, size: int, source: str | None = None) -> str:
    return _where(f"domain({column} text({size}))", table, f"length({column}) > {size}", source)


def _too_wide(table: str, column: str, p: int, s: int, source: str | None = None) -> str:
    return _where(
        f"domain({column} numeric({p},{s}))", table,
        f"{column} is not null and try_cast({column} as decimal({p},{s})) is null", source,
    )


def _orphans(
    table: str, column: str, dim: str, dim_column: str, source: str | None = None
) -> str:
    return _where(
        f"foreign_key({column})", table,
        f"{column} is not null and not exists (select 1 from {dim} x where x.{dim_column} = {column})",
        source,
    )


def _empty(table: str, source: str | None = None) -> str:
    return _check(
        "not_empty", table, f"select case when count(*) = 0 then 1 else 0 end from {source or table}"
    )


_ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _constraints() -> list[str]:
    fact = "fact_customer_churn"
    checks = [
        _too_long("bronze", c, n) for c, n in [
            ("gender", 20), ("contracttype", 50), ("internetservice", 50), ("techsupport", 50),
            ("churn", 10),
        ]
    ]
    checks += [
        _check("domain(source_file text(255))", "bronze", "0"),
        _check("domain(pipeline_run_id text(255))", "bronze", "0"),
        _too_wide("bronze", "monthlycharges", 10, 2), _too_wide("bronze", "totalcharges", 10, 2),
        _unique("silver", "customer_id_anonymized"),
        _where("not_null(customer_id_anonymized)", "silver", "customer_id_anonymized is null"),
        _check("domain(source_pipeline text(255))", "silver", "0"),
    ]
    checks += [
        _too_long("silver", c, n) for c, n in [
            ("customer_id_anonymized", 64), ("gender", 20), ("contract_type", 50),
            ("internet_service", 50), ("tech_support", 50), ("churn", 10),
        ]
    ]
    checks += [
        _too_wide("silver", c, p, s) for c, p, s in [
            ("monthly_charges", 10, 2), ("total_charges", 10, 2), ("avg_monthly_spend", 10, 2),
            ("data_quality_score", 3, 2),
        ]
    ]
    for table, key in [
        ("dim_customer", "customer_sk"), ("dim_service", "service_sk"),
        ("dim_contract", "contract_sk"),
    ]:
        checks += [
            _empty(table), _unique(table, key), _where(f"not_null({key})", table, f"{key} is null"),
        ]
    checks += [
        _empty(fact, "fact"), _unique(fact, "fact_sk", "fact"),
        _where("not_null(fact_sk)", fact, "fact_sk is null", "fact"),
        _where("not_null(customer_id_anonymized)", "dim_customer",
               "customer_id_anonymized is null"),
        _unique("dim_customer", "customer_id_anonymized"),
        _orphans(fact, "customer_sk", "dim_customer", "customer_sk", "fact"),
        _orphans(fact, "service_sk", "dim_service", "service_sk", "fact"),
        _orphans(fact, "contract_sk", "dim_contract", "contract_sk", "fact"),
    ]
    checks += [
        _too_long(table, column, size) for table, column, size in [
            ("dim_customer", "customer_id_anonymized", 64), ("dim_customer", "gender", 20),
            ("dim_customer", "tenure_category", 20), ("dim_service", "internet_service", 50),
            ("dim_service", "tech_support", 50), ("dim_service", "service_bundle_type", 50),
            ("dim_contract", "contract_type", 50),
        ]
    ]
    checks += [
        _too_wide(fact, column, p, s, "fact") for column, p, s in [
            ("monthly_charges", 10, 2), ("total_charges", 10, 2), ("avg_monthly_spend", 10, 2),
            ("total_revenue", 12, 2), ("churn_risk_score", 3, 2),
        ]
    ]
    return checks


def _median(column: str, cents: bool = False, source: str = "unique_raw", name: str = "") -> str:
    value = f"median(cast({column}*100 as bigint))/100.0" if cents else f"median({column})"
    return (
        f"select '{name or column}' as column_name, cast({value} as double) as median from {source}"
    )


def _double_median(table: str, column: str) -> str:
    return f"""
        select '{column}' as column_name,
          (max(v) filter (where i = (n + 1) // 2) + max(v) filter (where i = n // 2 + 1)) / 2
            as median
        from (select {column} as v, row_number() over (order by {column}) as i,
                count(*) over () as n from {table} where {column} is not null)"""


_LINE_ORDER = (
    "l_returnflag, l_linestatus, l_suppkey, l_partkey, l_orderkey, l_linenumber, "
    "l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"
)

_RAW_SHOWN = f"select * {_DOUBLE_MONEY} from subscriber_raw"
_FACT_SHOWN = "select * from fact"


def _unimputed(equals: str) -> str:
    return _RAW + _DISTINCT + _silver("unique_raw", 0) + _DIMS + _fact(equals)


_MISSING_IDS = _RAW_MISSING_IDS + _BRONZE + _SILVER + _DIMS
# The id's gaps are left open, all others are filled.
_MISSING_IDS_KEPT = _RAW_MISSING_IDS + _BRONZE.replace(
    "coalesce(customerid, id_m)", "customerid"
) + _SILVER + _DIMS


def _wide_median(value: str, name: str) -> str:
    """In ten-thousandths, exactly."""
    return f"""
        select '{name}' as column_name, cast((max(v) filter (where i = (n + 1) // 2)
            + max(v) filter (where i = n // 2 + 1)) as double) / 2 / 10000 as median
        from (select v, row_number() over (order by v) as i, count(*) over () as n
              from (select {value} as v from lineitem) where v is not null)"""


_CORRECTED = _RAW_CORRECTED + _BRONZE + _SILVER + _DIMS

_METRICS = """
select 'bronze' as stage, 'subscribers' as table_name, (select count(*) from unique_raw) as row_count,
  (select count(*) from subscriber_raw) - (select count(*) from unique_raw) as duplicates_removed,
  null::bigint as facts_lost, null::bigint as facts_added
union all select 'silver', 'subscribers', (select count(*) from silver), null, null, null
union all select 'gold', 'dim_customer', (select count(*) from dim_customer), null, null, null
union all select 'gold', 'dim_service', (select count(*) from dim_service), null, null, null
union all select 'gold', 'dim_contract', (select count(*) from dim_contract), null, null, null
union all select 'gold', 'fact_customer_churn', (select count(*) from fact), null, 0,
  (select count(*) from fact) - (select count(*) from silver)"""

# --- across loads ------------------------------------------------------------------------------

_ROW_SHOWN = ", ".join(
    f"cast({c} as double) as {c}" if c in ("monthlycharges", "totalcharges") else c for c in _RAW_COLUMNS
)
_KEY_ORDER = ", ".join(f"{c} nulls first" for c in ("customer_id_anonymized", "age", "gender", "tenure"))


def _customer_keys(raw: str) -> str:
    return _with(raw + _BRONZE + _SILVER, "select distinct customer_id_anonymized, age, gender, tenure from silver")


def _snapshot(raw: str, absent: str) -> str:
    """One row per customer: the longest tenure's, then the greatest attributes."""
    some = raw.replace("from records),", f"from records where contracttype is distinct from '{absent}'),")
    assert some != raw
    return _with(some + _BRONZE + _SILVER, """
        select customer_id_anonymized, age, gender, tenure, contract_type from silver
        qualify row_number() over (partition by customer_id_anonymized order by tenure desc nulls last,
          age desc nulls last, gender desc nulls last, contract_type desc nulls last) = 1""")


ORACLE_SQL: dict[str, str] = {
    "subscriber_raw": _with(_RAW, _RAW_SHOWN),
    "csv_na_scan": _with(_RAW, _RAW_SHOWN),
    "csv_inferred_scan": _with(_RAW, _RAW_SHOWN),
    "csv_long_rows": '''
        select c_custkey as id,
          case when c_custkey%10=0 then 'a,"b"' when c_custkey%7=0 then 'short' else 'x,y' end as note,
          case when c_custkey%10=0 then 'c' when c_custkey%7<>0 then c_mktsegment end as segment,
          case when c_custkey%10=0 then c_custkey || ',"a,""b""",c,extra' end as unparsed_row,
          (select count(*) from customer where c_custkey%10=0) as long_rows
        from customer''',
    "csv_inferred_decimals": """
        select cast(c_custkey as int) as id, cast(c_custkey as int) as whole,
          cast(c_custkey + 0.5 as double) as half,
          cast('1.' || lpad(cast(c_custkey as varchar), 12, '0') as double) as fine,
          cast(c_custkey%5 + 1 as int) as zeros
        from customer""",
    "csv_exponent_numbers": """
        select cast(c_custkey as int) as id, cast(c_custkey * 10 + 5 as int) as tens,
          cast(c_custkey as double) / 10 as tenths, cast(c_custkey as int) as ones,
          cast(c_custkey as double) / 1000 as fine
        from customer""",
    "dedupe_exact": _with(_RAW + _DISTINCT, f"select * {_DOUBLE_MONEY} from unique_raw"),
    "dedupe_removed": _with(_RAW + _DISTINCT, """
        select (select count(*) from subscriber_raw) as rows_read,
          (select count(*) from unique_raw) as rows_kept,
          (select count(*) from subscriber_raw) - (select count(*) from unique_raw)
            as duplicates_removed"""),
    "dedupe_lineitem": """
        select l_returnflag, l_linestatus, l_suppkey, cast(count(*) as bigint) as copies
        from lineitem group by all""",
    "column_medians": _with(_RAW + _DISTINCT, _union([
        _median("customerid"), _median("age"), _median("tenure"),
        _median("monthlycharges", cents=True), _median("totalcharges", cents=True),
    ])),
    "lineitem_medians": _union([
        _median("l_orderkey", source="lineitem"), _median("l_partkey", source="lineitem"),
        _median("l_linenumber", source="lineitem"),
        *[
            _median(f"cast({c} as decimal(10,2))", cents=True, source="lineitem", name=c)
            for c in ("l_quantity", "l_extendedprice", "l_discount")
        ],
    ]),
    "double_medians": _union([
        _double_median("lineitem", "l_extendedprice"), _double_median("lineitem", "l_tax"),
        _double_median("events", "value"), _double_median("customer", "c_acctbal"),
    ]),
    "wide_decimal_medians": _union([
        _wide_median("(cast(l_orderkey as hugeint) * 100000000000000 + l_linenumber) * 10000", "high"),
        _wide_median("cast(10000000000000000000000000000 as hugeint) * 10000 "
                     "- cast(cast(l_extendedprice as decimal(10,2)) * 10000 as hugeint)", "low"),
        _wide_median("case when l_linenumber > 1 then cast(-l_orderkey as hugeint) * 1250 end", "negative"),
    ]),
    "impute_median": _with(_RAW + _BRONZE, f"""
        select customerid, age, tenure, cast(monthlycharges as double) as monthlycharges,
          cast(totalcharges as double) as totalcharges from bronze"""),
    "impute_unknown": _with(_RAW + _BRONZE, """
        select customerid, gender, contracttype, internetservice, techsupport, churn from bronze"""),
    "bronze": _with(_RAW + _BRONZE, f"""
        select * {_DOUBLE_MONEY}, {_EPOCH} as ingestion_timestamp,
          'subscribers.csv' as source_file, 'run-1' as pipeline_run_id from bronze"""),
    "rename_variants": _with(_RAW, """
        select customerid, age, gender, tenure, cast(monthlycharges as double) as monthly_charges,
          contracttype as contract_type, internetservice as internet_service,
          cast(totalcharges as double) as total_charges, techsupport as tech_support, churn
        from subscriber_raw"""),
    "rename_collision": _with(_RAW, """
        select customerid, contracttype as contract_type from subscriber_raw"""),
    "age_fallback": _with(_RAW, "select customerid, age from subscriber_raw"),
    "age_absent": _with(_RAW, """
        select count(*) as row_count, cast(0 as bigint) as known_ages from subscriber_raw"""),
    "select_available": _with(_RAW, "select churn, customerid, tenure from subscriber_raw"),
    "pseudonymize": """
        select c_custkey, substr(sha256(cast(c_custkey as varchar)), 1, 16) as pseudonym
        from customer""",
    "pseudonymize_salted": """
        select c_custkey, sha256('pepper' || cast(c_custkey as varchar)) as pseudonym
        from customer""",
    "normalize_text": _with(_RAW, """
        select customerid, trim(lower(gender)) as gender, trim(lower(contracttype)) as contracttype,
          trim(lower(internetservice)) as internetservice, trim(lower(techsupport)) as techsupport,
          trim(lower(churn)) as churn from subscriber_raw"""),
    "normalize_documents": "select doc_id, md5(trim(lower(text), ' ')) as text_md5 from documents",
    "avg_monthly_spend": _with(_RAW, """
        select customerid, cast(totalcharges as double) as totalcharges, tenure,
          cast(case when tenure > 0 then (cast(totalcharges*100 as bigint)*2 + tenure)
            // (2*tenure) / 100.0 else 0.0 end as double) as avg_monthly_spend
        from subscriber_raw"""),
    "data_quality_score": _with(_RAW, f"""
        select customerid, round(({_filled(_RAW_COLUMNS)}) / 10.0, 2)::double as data_quality_score
        from subscriber_raw"""),
    "silver": _with(_RAW + _BRONZE + _SILVER, _SILVER_SHOWN),
    "silver_drifted": _with(_RAW + _silver("subscriber_raw", 0), _SILVER_SHOWN),
    "silver_streamed_drifted": _with(_RAW + _silver("subscriber_raw", 0), _SILVER_SHOWN),
    "silver_streamed": _with(_RAW + _BRONZE + _SILVER, _SILVER_SHOWN),
    "tenure_category": _with(_RAW + _CLEAN, """
        select customerid, tenure,
          case when tenure <= 12 then '0-12 months' when tenure <= 24 then '13-24 months'
            when tenure <= 48 then '25-48 months' else '49+ months' end as tenure_category
        from clean"""),
    "service_bundle": _with(_RAW + _CLEAN, """
        select customerid, internet_service, tech_support,
          case when internet_service <> 'unknown' and tech_support = 'yes' then 'Premium'
            when internet_service <> 'unknown' then 'Standard' else 'Basic' end
            as service_bundle_type
        from clean"""),
    "contract_months": _with(_RAW + _CLEAN, """
        select customerid, contract_type,
          cast(case contract_type when 'month-to-month' then 1 when 'one-year' then 12
            when 'two-year' then 24 else 0 end as int) as contract_duration_months
        from clean"""),
    "total_revenue": _with(_RAW + _CLEAN, """
        select customerid, cast(tenure * monthly_charges as double) as total_revenue from clean"""),
    "is_churned": _with(_RAW + _CLEAN, """
        select customerid, coalesce(churn = 'yes', false) as is_churned from clean"""),
    "churn_risk": _with(_RAW + _CLEAN, """
        select customerid, cast(case when churn = 'yes' then 1.0 when tenure < 12 then 0.7
          else 0.3 end as double) as churn_risk_score from clean"""),
    "dim_customer": _with(_RAW + _BRONZE + _SILVER + _DIMS, "select * from dim_customer"),
    "dim_service": _with(_RAW + _BRONZE + _SILVER + _DIMS, "select * from dim_service"),
    "dim_contract": _with(_RAW + _BRONZE + _SILVER + _DIMS, "select * from dim_contract"),
    "dense_key_distinct": """
        select l_partkey, l_suppkey,
          cast(row_number() over (order by l_partkey, l_suppkey) as bigint) as pair_sk
        from (select distinct l_partkey, l_suppkey from lineitem)""",
    "dense_key_digest": """
        select order_digest, o_orderkey,
          cast(row_number() over (order by order_digest, o_orderkey) as bigint) as order_sk
        from (select substr(sha256(cast(o_orderkey as varchar)), 1, 16) as order_digest, o_orderkey
              from orders)""",
    "dense_key_rows": f"""
        select cast(row_number() over (order by {_LINE_ORDER}) as bigint) as line_sk,
          l_returnflag, l_suppkey, l_orderkey, l_linenumber from lineitem""",
    "fact_churn": _with(_GOLD, _FACT_SHOWN),
    "fact_colocated": _with(_GOLD, _FACT_SHOWN),
    "fact_nullsafe_lookup": _with(_unimputed("is not distinct from"), _FACT_SHOWN),
    "fact_null_keys_dropped": _with(_unimputed("="), _FACT_SHOWN),
    "fact_fanout": _with(_CORRECTED + _fact(), _FACT_SHOWN),
    "fact_conflict_own": _with(_CORRECTED + _fact(customer=_OWN), _FACT_SHOWN),
    "fact_missing_ids": _with(_MISSING_IDS + _fact(customer=_OWN), _FACT_SHOWN),
    "fact_missing_ids_kept": _with(_MISSING_IDS_KEPT + _fact(customer=_OWN), _FACT_SHOWN),
    "fact_missing_ids_fanout": _with(_MISSING_IDS + _fact(), _FACT_SHOWN),
    "fact_conflict_pick": _with(_CORRECTED + _PICKED + _fact(dim="picked_customer"), _FACT_SHOWN),
    "churn_rate_report": _with(_GOLD, _REPORT),
    "churn_rate_report_sql": _with(_GOLD, _REPORT),
    "counts_by_table": _union([
        f"select '{t}' as table_name, cast(count(*) as bigint) as row_count from {t}"
        for t in _ALL_TABLES
    ]),
    "check_not_empty": _union([
        *[_empty(t) for t in _ALL_TABLES],
        _empty("unnamed_region", "(select * from region where r_name is null)"),
    ]),
    "check_unique": _union([
        _unique("lineitem", "l_orderkey,l_linenumber"), _unique("orders", "o_orderkey"),
        _unique("orders", "o_custkey"), _unique("documents", "text"),
    ]),
    "check_fk": _union([
        _orphans("orders", "o_custkey", "customer", "c_custkey"),
        _orphans("lineitem", "l_partkey", "part", "p_partkey"),
        _orphans("documents", "doc_id", "labels", "doc_id", "documents d").replace(
            "x.doc_id = doc_id", "x.doc_id = d.doc_id"),
        _orphans("events", "user_id", "customer", "c_custkey"),
    ]),
    "check_not_null": _with(_RAW, _union([
        _where(f"not_null({c})", "subscriber_raw", f"{c} is null") for c in _RAW_COLUMNS
    ])),
    "check_domain": _union([
        _too_long("customer", "c_mktsegment", 9), _too_wide("customer", "c_acctbal", 5, 2),
        _too_long("orders", "o_orderpriority", 8), _too_wide("orders", "o_totalprice", 7, 2),
        _too_long("documents", "text", 2000), _too_long("documents", "lang", 2),
    ]),
    "layer_constraints": _with(_GOLD, _union(_constraints())),
    "dedupe_two_loads": _with(_RAW, f"""
        select {_ROW_SHOWN}, cast(min(load) as int) as load from (
          select * exclude (delivery), 0 as load from delivered
          union all select * exclude (delivery) replace (cast(age + delivery as int) as age), 1 from delivered)
        group by {", ".join(_RAW_COLUMNS)}"""),
    "dim_customer_stable": f"""
        with first_keys as ({_customer_keys(_RAW)}), second_keys as ({_customer_keys(_RAW_CORRECTED)}),
        known as (select *, row_number() over (order by {_KEY_ORDER}) as customer_sk from first_keys),
        fresh as (select * from second_keys except select * from first_keys)
        select * from known union all
        select *, (select count(*) from known) + row_number() over (order by {_KEY_ORDER}) from fresh""",
    "medians_two_loads": _with(_RAW, " union all ".join(
        f"""select '{c}' as column_name, cast(median({c}) as double) as median from (
          select * from delivered union all
          select * replace (cast(age + delivery as int) as age) from delivered)"""
        for c in ("customerid", "age", "tenure", "monthlycharges", "totalcharges")
    )),
    "lineitem_medians_two_loads": " union all ".join(
        f"select '{c}' as column_name, cast(median({c}) as double) as median from lineitem"
        for c in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    ),
    "customer_history": f"""
        with one as ({_snapshot(_RAW, " One-Year")}), two as ({_snapshot(_RAW_CORRECTED, "TWO-YEAR ")}),
        kept as (select * from one intersect select * from two)
        select *, 1704067200::bigint as effective_date, null::bigint as end_date, true as is_current from kept
        union all select *, 1704067200, 1706745600, false from (select * from one except select * from kept)
        union all select *, 1706745600, null, true from (select * from two except select * from kept)""",
    "layer_roundtrip": _with(_GOLD, _FACT_SHOWN),
    "layer_reset": _with(_RAW + _DISTINCT, """
        select 'written' as step, cast(count(*) as bigint) as row_count from unique_raw
        union all select 'reset', 0::bigint
        union all select 'rewritten', cast(count(*) as bigint) from unique_raw"""),
    "stage_metrics": _with(_GOLD, _METRICS),
    "run_missing_ids": _with(_MISSING_IDS + _fact(), _METRICS),
    "end_to_end_report": _with(_GOLD, _REPORT),
}
ORACLE_SQL["check_fk_colocated"] = ORACLE_SQL["check_fk"]
