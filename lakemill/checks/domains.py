"""Business domains and schema reconciliation."""

from pyspark.sql import functions as F

from lakemill.checks.registry import job
from lakemill.checks.sqltext import cents, half_up
from lakemill.operators import conform as C
from lakemill.operators import marts, quality
from lakemill.operators.lineage import with_lineage

COLUMNS = {
    "hr": "employee_id, day_worked, department, hours_worked, attendance_status, topic",
    "finance": "finance_id, report_date, money_input, money_output, profit, cost_center, topic",
    "marketing": "campaign_id, lead_id, channel, spend_usd, clicks, conversions, event_time, topic",
}
KEPT = {
    "hr": "employee_id IS NOT NULL AND day_worked IS NOT NULL AND hours_worked >= 0",
    "finance": """finance_id IS NOT NULL AND report_date IS NOT NULL AND profit IS NOT NULL
        AND money_input >= 0 AND money_output >= 0""",
    "marketing": """campaign_id IS NOT NULL AND event_time IS NOT NULL AND spend_usd >= 0 AND clicks >= 0
        AND conversions >= 0""",
}


def silver(d, domain):
    kept = quality.apply_rules(C.conform_domain(d.view(domain), domain), quality.DOMAIN_RULES[domain])
    return with_lineage(kept, domain, domain)


def _register(domain):
    job(f"conform_{domain}", f"SELECT {COLUMNS[domain]} FROM {domain}")(lambda d: C.conform_domain(d.view(domain), domain))
    job(f"quality_{domain}", f"SELECT {COLUMNS[domain]} FROM {domain} WHERE {KEPT[domain]}")(
        lambda d: quality.apply_rules(C.conform_domain(d.view(domain), domain), quality.DOMAIN_RULES[domain])
    )


for _domain in COLUMNS:
    _register(_domain)


@job(
    "agg_hr_summary",
    f"""SELECT 'hr' AS domain, department, attendance_status, count(*) AS record_count,
          {cents("hours_worked")} AS total_hours_worked FROM hr WHERE {KEPT["hr"]} GROUP BY ALL""",
)
def _(d):
    return marts.domain_summary(silver(d, "hr"), "hr")


@job(
    "agg_finance_summary",
    f"""SELECT 'finance' AS domain, cost_center, count(*) AS record_count, {cents("money_input")} AS total_money_input,
          {cents("money_output")} AS total_money_output, {cents("profit")} AS total_profit
        FROM finance WHERE {KEPT["finance"]} GROUP BY ALL""",
)
def _(d):
    return marts.domain_summary(silver(d, "finance"), "finance")


@job(
    "agg_marketing_summary",
    f"""SELECT *, CASE WHEN total_clicks > 0 THEN {half_up("total_conversions / total_clicks", 4)} ELSE 0 END
            AS conversion_rate FROM (
          SELECT 'marketing' AS domain, channel, count(*) AS record_count, {cents("spend_usd")} AS total_spend_usd,
            sum(clicks)::bigint AS total_clicks, sum(conversions)::bigint AS total_conversions
          FROM marketing WHERE {KEPT["marketing"]} GROUP BY ALL) m""",
)
def _(d):
    return marts.domain_summary(silver(d, "marketing"), "marketing")


@job("agg_domain_default", "SELECT domain, count(*) AS record_count FROM files GROUP BY domain")
def _(d):
    return marts.domain_summary(d.view("files"), "documents")


# Four pieces that cover lineitem: quantity as int, as double, as text, and
# one piece without the tax column and with its key spelled differently.
PIECES = (
    "SELECT l_orderkey, cast(l_quantity AS int) AS l_quantity, l_tax + 0e0 AS l_tax FROM lineitem WHERE l_returnflag = 'A'",
    "SELECT l_orderkey, l_quantity, l_tax + 0e0 AS l_tax FROM lineitem WHERE l_returnflag = 'N'",
    "SELECT l_orderkey AS L_ORDERKEY, l_quantity FROM lineitem WHERE l_returnflag = 'R'",
)
TEXT_PIECE = "SELECT l_orderkey, concat('q', cast(cast(l_quantity AS int) AS string)) AS l_quantity, cast(l_linenumber AS string) AS l_tax FROM lineitem"


@job(
    "merge_varying_schemas",
    """SELECT l_orderkey, l_quantity::double AS l_quantity,
         CASE WHEN l_returnflag <> 'R' THEN l_tax + 0e0 END AS l_tax FROM lineitem""",
)
def _(d):
    return C.merge_schemas([d.sql(p) for p in PIECES])


@job(
    "merge_varying_schemas_to_string",
    """SELECT l_orderkey, l_quantity::int::varchar AS l_quantity FROM lineitem WHERE l_returnflag = 'A'
       UNION ALL SELECT l_orderkey, concat('q', l_quantity::int::varchar) FROM lineitem""",
)
def _(d):
    merged = C.merge_schemas([d.sql(PIECES[0]), d.sql(TEXT_PIECE)])
    return merged.select("l_orderkey", "l_quantity")


@job(
    "union_by_name_missing",
    "SELECT l_orderkey, l_quantity, CASE WHEN l_returnflag <> 'R' THEN l_tax + 0e0 END AS l_tax FROM lineitem",
)
def _(d):
    return C.union_all([d.sql(PIECES[1].replace("= 'N'", "<> 'R'")), d.sql(PIECES[2])])


@job("union_by_name_strict", "SELECT c_name AS name, c_custkey AS id FROM customer UNION ALL SELECT s_name, s_suppkey FROM supplier")
def _(d):
    customers = d.sql("SELECT c_name AS name, c_custkey AS id FROM customer")
    return C.union_all([customers, d.sql("SELECT s_suppkey AS id, s_name AS name FROM supplier")], strict=True)


PADDED = """SELECT o_orderkey, o_orderpriority, concat('  ', o_orderstatus, ' ') AS padded,
    CASE o_orderstatus WHEN 'P' THEN '   ' WHEN 'F' THEN '' ELSE o_orderpriority END AS blank FROM orders"""


@job(
    "clean_strings",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus AS padded,
         CASE WHEN o_orderstatus NOT IN ('P', 'F') THEN o_orderpriority END AS blank FROM orders""",
)
def _(d):
    return C.clean_strings(d.sql(PADDED))


@job(
    "numeric_features",
    """SELECT l_orderkey::double AS l_orderkey, l_partkey::double AS l_partkey, l_suppkey::double AS l_suppkey,
         l_linenumber::double AS l_linenumber, l_quantity, l_extendedprice, l_discount + 0e0 AS l_discount, l_tax + 0e0 AS l_tax
       FROM lineitem""",
)
def _(d):
    features = C.numeric_features(d.table("lineitem"))
    return features.withColumns({c: F.col(c) + F.lit(0.0) for c in ("l_discount", "l_tax")})


@job(
    "normalize_to_reference_schema",
    "SELECT c_custkey::varchar AS id, c_acctbal AS balance, NULL::int AS score, c_nationkey::bigint AS nation FROM customer",
)
def _(d):
    from pyspark.sql.types import StructType

    sample = StructType.fromDDL("id string, balance double, score int, nation bigint")
    raw = d.table("customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_nationkey", "c_name")
    return C.normalize_to(raw, sample, {"c_custkey": "id", "c_acctbal": "balance", "c_nationkey": "nation"})
