"""Star schema: three dimensions with dense keys and the churn fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.context import RunContext
from stratalake.functions import (
    bucketize,
    case_rules,
    flag_equals,
    map_values,
    rounded_product,
)
from stratalake.operators.colocate import CoLocated, co_locate, co_lookup
from stratalake.operators.columns import conform
from stratalake.operators.dimensions import distinct_attributes
from stratalake.operators.joins import all_fit_broadcast, lookup_key
from stratalake.operators.keys import key_by_hex_prefix, key_by_range, key_labels, rows_before
from stratalake.sources.staging import Staging

# Everything but the key in a fact row; the key follows customer_sk, the rest breaks ties.
FACT_ORDER = [
    "customer_sk", "service_sk", "contract_sk", "monthly_charges", "total_charges",
    "avg_monthly_spend", "total_revenue", "is_churned", "churn_risk_score",
]


def tenure_category(tenure: Column) -> Column:
    return bucketize(tenure, S.TENURE_BANDS, S.TENURE_OPEN_BAND)


def service_bundle(internet: Column, support: Column) -> Column:
    served = internet != S.NO_SERVICE
    return case_rules(
        [(served & (support == S.YES), S.BUNDLE_PREMIUM), (served, S.BUNDLE_STANDARD)],
        S.BUNDLE_BASIC,
    )


def contract_months(contract: Column) -> Column:
    return map_values(contract, S.CONTRACT_MONTHS, S.CONTRACT_MONTHS_OTHER)


def is_churned(churn: Column) -> Column:
    return flag_equals(churn, S.YES)


def churn_risk(churned: Column, tenure: Column) -> Column:
    def score(text: str) -> Column:
        return F.lit(text).cast(S.SCORE)

    return case_rules(
        [(churned, score(S.RISK_CHURNED)),
         (tenure < S.RISK_NEW_BELOW_MONTHS, score(S.RISK_NEW))],
        score(S.RISK_OTHER),
    )


# Silver's columns that make up a customer, and the dimension's.
CUSTOMER = ["customer_id_anonymized", "age", "gender", "tenure"]
CUSTOMER_ATTRIBUTES = [*CUSTOMER[:3], "tenure_months"]


def build_dim_customer(silver: DataFrame, ctx: RunContext) -> DataFrame:
    attributes = CUSTOMER_ATTRIBUTES
    rows = distinct_attributes(silver, {
        "customer_id_anonymized": "customer_id_anonymized", "age": "age", "gender": "gender",
        "tenure": "tenure_months",
    })
    keyed = key_by_hex_prefix(rows, attributes, "customer_sk")
    return conform(keyed.withColumns({
        "tenure_category": tenure_category(F.col("tenure_months")),
        "effective_date": ctx.now(),
        "is_current": F.lit(True),
    }), S.DIM_CUSTOMER)


def label_rows(silver: DataFrame) -> DataFrame:
    """The distinct labels from which both label dimensions can be built; stage them once."""
    return silver.select("internet_service", "tech_support", "contract_type").distinct()


def build_dim_service(silver: DataFrame, staging: Staging) -> DataFrame:
    """Service dimension of silver, or of its staged `label_rows`."""
    attributes = ["internet_service", "tech_support"]
    rows = distinct_attributes(silver, {c: c for c in attributes})
    keyed = key_labels(rows, attributes, "service_sk", staging)
    return conform(keyed.withColumns({
        "service_bundle_type": service_bundle(*map(F.col, attributes)),
    }), S.DIM_SERVICE)


def build_dim_contract(silver: DataFrame, staging: Staging) -> DataFrame:
    """Contract dimension of silver, or of its staged `label_rows`."""
    rows = distinct_attributes(silver, {"contract_type": "contract_type"})
    keyed = key_labels(rows, ["contract_type"], "contract_sk", staging)
    return conform(keyed.withColumns({
        "contract_duration_months": contract_months(F.col("contract_type")),
    }), S.DIM_CONTRACT)


def co_locate_silver(
    silver: DataFrame, ctx: RunContext, staging: Staging, buckets: int,
    hot_rows: int = 1_000_000, row_id: str | None = None,
) -> tuple[DataFrame, CoLocated]:
    """Silver written in buckets by customer, and the layout for the customer dimension.

    Silver is shuffled once, when it is written; the dimension's rows (co_distinct) and the facts'
    keys then come from matching buckets. Facts get their own customer (`on_conflict="own"`),
    the only one that the whole key names.
    """
    if ctx.on_conflict != "own":
        raise ValueError("co-located customers are matched on their whole key: on_conflict='own'")
    layout = co_locate(silver, CUSTOMER, staging, buckets, hot_rows)
    return layout.many(silver, [row_id] if row_id else ()), layout.renamed(*CUSTOMER_ATTRIBUTES)


def _with_customer(
    fact: DataFrame, dim: DataFrame, ctx: RunContext, staging: Staging
) -> DataFrame:
    """customer_sk of each fact, and `_first`, which marks one row of each fact that has any."""
    key = ["customer_id_anonymized"]
    if ctx.on_conflict == "own":
        # The dimension is the distinct rows of these attributes of the same silver: every fact
        # has exactly one, also where they are NULL, and a hot id is spread by its attributes.
        attributes = [*key, "age", "gender", "tenure"]
        side = dim.withColumnRenamed("tenure_months", "tenure")
        found = lookup_key(fact, side, attributes, "customer_sk", null_safe=True)
        return found.withColumn("_first", F.lit(True))
    if ctx.on_conflict == "fanout":
        numbered = key_by_range(
            staging.table(fact), key, "_at", staging, spread_by=[F.xxhash64(*fact.columns)]
        )
        found = _fan_out(numbered, dim, "_at", ctx, staging)
        return found.select(*fact.columns, "customer_sk", "_first")
    found = lookup_key(
        fact, dim, key, "customer_sk", null_safe=ctx.null_safe_lookup, on_conflict=ctx.on_conflict,
        # The longest tenure is a customer's most recent record.
        prefer=F.col("tenure_months") if ctx.on_conflict == "pick" else None, staging=staging,
    )
    return found.withColumn("_first", F.lit(True))


# Facts and customers of one id that meet in one group of the join, at most and on average.
_FACT_BLOCK, _PEOPLE_BLOCK = 256, 256
# Rows that a task of the join gives, on average.
_FANNED_ROWS = 1 << 20


def _fan_out(
    fact: DataFrame, dim: DataFrame, at: str, ctx: RunContext, staging: Staging
) -> DataFrame:
    """Each fact once for every customer row of its id: `fact` with customer_sk, `_first`, `_nth`.

    `at` numbers the facts, those of one id in a row, and `_nth` the result in the order of
    customer_sk, then `at`. An id of many facts and many customer rows gives their product, so
    both are cut into blocks, and each pair of blocks meets in a group of its own; no row is
    sorted or moved after that.
    """
    key, null_safe = ["customer_id_anonymized"], ctx.null_safe_lookup
    customers = dim.select(*key, "customer_sk")
    people = customers.groupBy(*key).agg(F.struct(
        F.count(F.lit(1)).alias("people"), F.min("customer_sk").alias("least")
    ).alias("_people"))
    facts = fact.groupBy(*key).agg(F.min(at).alias("_start"), F.count(F.lit(1)).alias("_facts"))
    spread = staging.table(
        lookup_key(facts, people, key, "_people", null_safe).select(*key, F.struct(
            F.col("_start").alias("start"), F.col("_facts").alias("facts"),
            F.expr(f"(_facts - 1) div {_FACT_BLOCK}").alias("last_fact_block"),
            F.expr(f"(_people.people - 1) div {_PEOPLE_BLOCK}").alias("last_people_block"),
            F.col("_people.people").alias("people"), F.col("_people.least").alias("least"),
        ).alias("_spread"))
    )
    total = spread.agg(F.sum(F.col("_spread.facts").cast("double") * F.col("_spread.people"))).first()[0]
    tasks = int(min((total or 0) // _FANNED_ROWS + 1, 100_000))

    met = staging.table(lookup_key(customers, spread, key, "_spread", null_safe).select(
        "customer_sk", "_spread", F.col("_spread.facts").alias("_facts")
    ))
    # The first number of an id's facts stands for the id, NULL or not.
    blocks = ["_start", "_fact_block", "_people_block"]
    block = F.pmod(F.xxhash64("customer_sk"), F.col("_spread.last_people_block") + 1)
    side = rows_before(met, "customer_sk", "_facts", "_before").select(
        F.col("_spread.start").alias("_start"), block.alias("_people_block"),
        F.explode(F.sequence(F.lit(0), F.col("_spread.last_fact_block"))).alias("_fact_block"),
        F.struct(
            "customer_sk", F.col("_before").alias("before"),
            (F.col("customer_sk") == F.col("_spread.least")).alias("first"),
        ).alias("_entry"),
    )
    spread_facts = lookup_key(fact, spread, key, "_spread", null_safe).select(
        *fact.columns, F.col("_spread.start").alias("_start"),
        F.expr(f"({at} - _spread.start) div {_FACT_BLOCK}").alias("_fact_block"),
        F.explode(F.sequence(F.lit(0), F.col("_spread.last_people_block"))).alias("_people_block"),
    )
    found = lookup_key(
        spread_facts.repartition(tasks, *blocks), side.repartition(tasks, *blocks), blocks, "_entry"
    )
    return found.select(
        *fact.columns, F.col("_entry.customer_sk").alias("customer_sk"),
        F.col("_entry.first").alias("_first"),
        (F.col("_entry.before") + F.col(at) - F.col("_start") + 1).alias("_nth"),
    )


def fact_rows(
    silver: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, staging: Staging,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Fact measures with the dimensions' keys, not yet numbered; silver's other columns stay.

    The label dimensions are measured together, broadcast if they are small and shuffled
    otherwise. The customer dimension grows with the data and is always joined by shuffle, where
    adaptive execution splits an id that holds too many rows; with `customers`, the dimension in
    the layout in which co_locate_silver() wrote this silver, bucket by bucket.

    `_first` marks one fact of each silver row that has any, so that facts lost and added can be
    counted.
    """
    fact = silver
    if customers is not None:
        # First, while silver's buckets are still as they were written.
        found = co_lookup(silver, customers, CUSTOMER, "customer_sk", CUSTOMER_ATTRIBUTES)
        fact = found.withColumn("_first", F.lit(True))
    fact = _with_labels(fact, dims, ctx)
    if customers is None:
        fact = _with_customer(fact, dims["dim_customer"], ctx, staging)
    return _measured(fact)


def _with_labels(fact: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    labels = [
        (dims["dim_service"], ["internet_service", "tech_support"], "service_sk"),
        (dims["dim_contract"], ["contract_type"], "contract_sk"),
    ]
    sides = [dim.select(*keys, sk) for dim, keys, sk in labels]
    small = all_fit_broadcast(sides)
    for side, fits, (_, keys, sk) in zip(sides, small, labels):
        fact = lookup_key(fact, side, keys, sk, null_safe=ctx.null_safe_lookup, broadcast=fits)
    return fact


def _measured(fact: DataFrame) -> DataFrame:
    churned = is_churned(F.col("churn"))
    return fact.withColumns({
        "total_revenue": rounded_product(F.col("tenure"), F.col("monthly_charges")),
        "is_churned": churned,
        "churn_risk_score": churn_risk(churned, F.col("tenure")),
    })


def _fanned_out(
    tagged: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, staging: Staging
) -> DataFrame:
    """FACT_ORDER, fact_sk and `_first` when each fact meets all customer rows of its id.

    The facts are ordered before they are fanned out: behind each customer row of an id stand
    the same facts in the same order, so the number of a row follows from the customer's and the
    fact's, and the fanned out rows, by far more, are neither staged nor ordered.
    """
    key, own = "customer_id_anonymized", FACT_ORDER[1:]
    rows = staging.table(_measured(_with_labels(tagged, dims, ctx)).select(key, *own, "_tag"))
    placed = key_by_range(rows, [key, *own], "_at", staging, spread_by=["_tag"], drop=["_tag"])
    found = _fan_out(placed, dims["dim_customer"], "_at", ctx, staging)
    return found.select(*FACT_ORDER, "_first", F.col("_nth").alias("fact_sk"))


def build_fact(
    silver: DataFrame, dims: Mapping[str, DataFrame], ctx: RunContext, staging: Staging,
    row_id: str | None = None, marked: bool = False, customers: DataFrame | None = None,
) -> DataFrame:
    """The numbered churn fact. `dims` should be written tables.

    `row_id` names a column of silver that tells its rows apart (see LayerStore.read); without
    it a hash of the row does, which cannot split rows equal in every column. The joined rows are
    written before they are ordered: range bounds are sampled, and the sample would evaluate the
    joins once more; facts that fan out are ordered before they do. With `marked`, `_first` of
    fact_rows() stays as a column. `customers` is that of fact_rows().
    """
    tag = F.col(row_id) if row_id else F.xxhash64(*silver.columns)
    tagged = silver.withColumn("_tag", tag)
    if ctx.on_conflict == "fanout" and customers is None:
        keyed = _fanned_out(tagged, dims, ctx, staging)
    else:
        joined = fact_rows(tagged, dims, ctx, staging, customers)
        rows = staging.table(joined.select(*FACT_ORDER, "_tag", "_first"))
        keyed = key_by_range(
            rows, FACT_ORDER, "fact_sk", staging, spread_by=["_tag"], drop=["_tag"]
        )
    fact = keyed.withColumns({
        "date_sk": F.lit(S.DATE_SK),
        "created_timestamp": ctx.now(),
        "updated_timestamp": ctx.now(),
    })
    named = conform(fact, S.FACT)
    return fact.select(*named.columns, "_first") if marked else named
