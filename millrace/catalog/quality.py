"""Queries: rule checks, the report, and expectation suites."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.inputs import (
    DIRTY_ORDERS,
    DIRTY_ORDERS_SQL,
    SOURCE_A,
    SOURCE_A_SQL,
    SOURCE_B_SQL,
    dirty_orders,
    source_a,
    source_b,
)
from millrace.catalog.registry import query, table
from millrace.operators import quality
from millrace.operators.expectations import Expectation, unexpected_samples, validate
from millrace.plans.churn_definitions import RULES_A, SUITE_A, SUITE_B

NAMES = [n for _, n in DIRTY_ORDERS]
TEXTS = ("status", "priority", "price_text", "const")


def _per_column(template: str, columns, source: str = "d") -> str:
    """One row per column: the template with {c} replaced, stacked."""
    return " union all ".join(f"select '{c}' as column_name, " + template.format(c=c) + f" from {source}" for c in columns)


WITH_D = f"with d as ({DIRTY_ORDERS_SQL}) "


@query("dq_table_profile", "with n as (select count(*) as n_rows from orders) select * from (values "
       "(0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'), "
       "(3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string')) "
       "t(position, column_name, data_type), n")
def dq_table_profile(spark, sf_dir):
    return quality.table_profile(table(spark, sf_dir, "orders"))


@query(
    "dq_missing",
    WITH_D
    + _per_column(
        "count(*) filter ({c} is null) as n_missing, count(*) as n_rows, "
        "round(count(*) filter ({c} is null) * 100.0 / count(*), 6) as pct_missing",
        NAMES,
    ),
)
def dq_missing(spark, sf_dir):
    return quality.missing(dirty_orders(spark, sf_dir)).withColumn("pct_missing", F.round("pct_missing", 6))


@query(
    "dq_cardinality",
    WITH_D
    + " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as n_distinct, "
        f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as n_unique, count(*) as n_rows, "
        f"count(distinct {c}) + {f'max(case when {c} is null then 1 else 0 end)' if c in TEXTS else '0'} "
        f">= 0.9 * count(*) as high_cardinality from d"
        for c in NAMES
    ),
)
def dq_cardinality(spark, sf_dir):
    return quality.cardinality(dirty_orders(spark, sf_dir))


@query(
    "dq_unique_values",
    WITH_D
    + " union all ".join(
        f"select '{c}' as column_name, {c} as value, count(*) as n from d group by {c}" for c in ("priority", "status", "const", "price_text")
    ),
)
def dq_unique_values(spark, sf_dir):
    return quality.unique_values(dirty_orders(spark, sf_dir), ["priority", "status", "const", "price_text"])


@query(
    "dq_duplicates",
    WITH_D
    + "select 'dup_key' as checked, count(*) - count(distinct dup_key) as n_duplicates, count(*) as n_rows, "
    "round((count(*) - count(distinct dup_key)) * 100.0 / count(*), 6) as pct_duplicates from d "
    "union all select 'const', count(*) - 2, count(*), round((count(*) - 2) * 100.0 / count(*), 6) from d",
)
def dq_duplicates(spark, sf_dir):
    df = dirty_orders(spark, sf_dir)
    parts = [
        quality.duplicates(df, [c]).select(F.lit(c).alias("checked"), "n_duplicates", "n_rows", F.round("pct_duplicates", 6).alias("pct_duplicates"))
        for c in ("dup_key", "const")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "dq_duplicate_rows",
    WITH_D
    + "select id, dup_key, row_number() over (partition by dup_key order by id) > 1 as is_duplicate, "
    "row_number() over (partition by priority, status order by id) > 1 as repeats_pair from d",
)
def dq_duplicate_rows(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "dup_key", "priority", "status")
    marked = quality.mark_duplicates(df, ["dup_key"], ["id"])
    marked = quality.mark_duplicates(marked, ["priority", "status"], ["id"], "repeats_pair")
    return marked.select("id", "dup_key", "is_duplicate", "repeats_pair")


def _range_sql(c: str, low: float, high: float, source: str) -> str:
    n = f"case when count(distinct {c}) > 2 then count(*) filter ({c} < {low} or {c} > {high}) end"
    return (
        f"select '{c}' as column_name, true as found, count(distinct {c}) <= 2 as is_binary, {n} as n_outside, "
        f"count(*) as n_rows, round({n} * 100.0 / count(*), 6) as pct_outside from {source}"
    )


@query("dq_range", _range_sql("l_quantity", 5, 45, "lineitem") + " union all " + _range_sql("l_discount", 0.02, 0.07, "lineitem"))
def dq_range(spark, sf_dir):
    checked = quality.range_check(table(spark, sf_dir, "lineitem"), {"l_quantity": (5, 45), "l_discount": (0.02, 0.07)})
    return checked.withColumn("pct_outside", F.round("pct_outside", 6))


@query(
    "dq_in_set",
    WITH_D
    + "select 'priority' as column_name, true as found, "
    "count(*) filter (priority is null or priority not in ('1-URGENT', '2-HIGH', '5-LOW')) as n_invalid, count(*) as n_rows, "
    "round(count(*) filter (priority is null or priority not in ('1-URGENT', '2-HIGH', '5-LOW')) * 100.0 / count(*), 6) as pct_invalid from d "
    "union all select 'status', true, count(*) filter (status not in ('O', 'F')), count(*), "
    "round(count(*) filter (status not in ('O', 'F')) * 100.0 / count(*), 6) from d",
)
def dq_in_set(spark, sf_dir):
    sets = {"priority": ["1-URGENT", "2-HIGH", "5-LOW"], "status": ["O", "F"]}
    return quality.set_check(dirty_orders(spark, sf_dir), sets).withColumn("pct_invalid", F.round("pct_invalid", 6))


@query(
    "dq_invalid_values",
    WITH_D
    + "select 'priority' as column_name, priority as value, count(*) as n from d "
    "where priority is null or priority not in ('1-URGENT', '2-HIGH', '5-LOW') group by 2",
)
def dq_invalid_values(spark, sf_dir):
    return quality.invalid_values(dirty_orders(spark, sf_dir), {"priority": ["1-URGENT", "2-HIGH", "5-LOW"]})


@query(
    "dq_missing_column",
    "select 'range' as check_name, 'absent_number' as column_name, false as found, cast(null as bigint) as n, count(*) as n_rows from orders "
    "union all select 'range', 'o_totalprice', true, count(*) filter (o_totalprice < 1000 or o_totalprice > 400000), count(*) from orders "
    "union all select 'set', 'absent_set', false, null, count(*) from orders",
)
def dq_missing_column(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    ranges = quality.range_check(df, {"absent_number": (0, 1), "o_totalprice": (1000, 400000)})
    sets = quality.set_check(df, {"absent_set": ["x"]})
    return ranges.selectExpr("'range' as check_name", "column_name", "found", "n_outside as n", "n_rows").unionByName(
        sets.selectExpr("'set' as check_name", "column_name", "found", "n_invalid as n", "n_rows")
    )


def _iqr_sql(c: str, source: str) -> str:
    return (
        f"select '{c}' as column_name, false as is_binary, round(any_value(q25), 6) as q25, round(any_value(q75), 6) as q75, "
        f"count(*) filter ({c} < q25 - 1.5 * (q75 - q25) or {c} > q75 + 1.5 * (q75 - q25)) as n_outliers, count(*) as n_rows, "
        f"round(count(*) filter ({c} < q25 - 1.5 * (q75 - q25) or {c} > q75 + 1.5 * (q75 - q25)) * 100.0 / count(*), 6) as pct_outliers "
        f"from {source}, (select quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.75) as q75 from {source})"
    )


IQR_INPUTS = [("lineitem", "l_extendedprice"), ("orders", "o_totalprice"), ("customer", "c_acctbal"), ("events", "value")]


@query("dq_iqr_outliers", " union all ".join(_iqr_sql(c, t) for t, c in IQR_INPUTS))
def dq_iqr_outliers(spark, sf_dir):
    out = None
    for t, c in IQR_INPUTS:
        part = quality.iqr_outliers(table(spark, sf_dir, t), [c])
        out = part if out is None else out.unionByName(part)
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "q75", "pct_outliers")})


ORDER_RULES = quality.Rules(
    ranges={"price": (1000, 400000), "zero": (0, 1), "absent": (0, 1), "amount_text": (1000, 400000)},
    sets={"priority": ["1-URGENT", "2-HIGH", "5-LOW"], "status": ["O", "F", "P"], "no_such": ["x"]},
    key="dup_key",
    ignore=("flag",),
)
# The text column price_text once more, but with a range: then it is read as numbers.
REPORT_ORDERS_SQL = f"select *, price_text as amount_text from ({DIRTY_ORDERS_SQL})"


def report_orders(spark, sf_dir):
    return dirty_orders(spark, sf_dir).withColumn("amount_text", F.col("price_text"))


def _text(expression: str, n: str) -> str:
    return f"printf('{expression}', {n}, count(*), {n} * 100.0 / count(*))"


def report_sql(source: str, names, numbers, texts, rules, as_number=()) -> str:
    """The report of ``source`` by ``rules``: names of all, of the numeric and of the text columns; text to read as numbers."""
    rows = "(select count(*) from d)"
    parts = []

    def add(order, section, column, check, message, n, of="d"):
        parts.append(
            f"select {order} as check_order, '{section}' as section, '{column}' as column_name, '{check}' as \"check\", "
            f"{message} as message, cast({n} as bigint) as n, {rows} as n_rows from {of}"
        )

    def number(c):
        return f"try_cast(trim({c}) as double)" if c in as_number else f"cast({c} as double)"

    for c in names:
        n = f"count(*) filter ({c} is null)"
        add(1, "missing_data", c, "missing", f"printf('%d missing (%.2f%%)', {n}, {n} * 100.0 / count(*))", n)
    binary = f"'{quality.BINARY_MESSAGE}'"
    for c, (low, high) in rules.ranges.items():
        if c not in names:
            add(2, "columns", c, "range", f"'{c} column not found.'", "null", "(select 1)")
            continue
        n = f"count(*) filter ({number(c)} < {low} or {number(c)} > {high})"
        two = f"count(distinct {number(c)}) <= 2"
        add(2, "columns", c, "range", f"case when {two} then {binary} else {_text('%d out of %d rows (%.2f%%)', n)} || ' are outside the expected range ({low}, {high}).' end", f"case when {two} then null else {n} end")
    extra_numbers = [c for c in numbers if c not in rules.ranges and c not in rules.ignore]
    for c in extra_numbers:
        parts.append(f"select 3, 'columns', '{c}', 'outliers', '{quality.WIDE_NUMERIC_MESSAGE}', cast(null as bigint), {rows} from (select count(distinct {c}) as u, count(*) as n from d) where u >= 0.9 * n")
    for c in [*(c for c in rules.ranges if c in names), *extra_numbers]:
        n = f"count(*) filter ({number(c)} < q25 - 1.5 * (q75 - q25) or {number(c)} > q75 + 1.5 * (q75 - q25))"
        q = f"d, (select quantile_cont({number(c)}, 0.25) as q25, quantile_cont({number(c)}, 0.75) as q75 from d)"
        two = f"count(distinct {number(c)}) <= 2"
        message = f"case when {two} then {binary} else {_text('%d out of %d rows (%.2f%%)', n)} || ' are outliers.' end"
        narrow = f" having count(distinct {c}) < 0.9 * count(*)" if c in extra_numbers else ""
        if c in extra_numbers:
            add(3, "columns", c, "outliers", message, f"case when {two} then null else {n} end", q + narrow)
        add(7, "outliers", c, "outliers", message, f"case when {two} then null else {n} end", q + narrow)
    for c, allowed in rules.sets.items():
        if c not in names:
            add(4, "columns", c, "set", f"'{c} column not found.'", "null", "(select 1)")
            continue
        values = ", ".join(f"'{v}'" for v in allowed)
        bad = f"({c} is null or {c} not in ({values}))"
        n = f"count(*) filter ({bad})"
        kinds = f"(select count(*) from (select distinct {c} from d where {bad}))"
        add(4, "columns", c, "set", _text("%d invalid values out of %d rows (%.2f%%).", n) + f" || case when {n} = 0 then ' (All values valid)' else printf(' Found: %d different ones, listed as rows.', {kinds}) end", n)
        parts.append(f"select 4, 'columns', '{c}', 'invalid value', coalesce({c}, 'NULL'), count(*), {rows} from d where {bad} group by {c}")
    for c in texts:
        if c in rules.ranges or c in rules.sets or c == rules.key:
            continue
        wide = f"(select count(distinct {c}) + max(case when {c} is null then 1 else 0 end) >= 0.9 * count(*) from d)"
        parts.append(
            f"select 5, 'columns', '{c}', 'values', case when u + least(gaps, 1) >= 0.9 * n then 'High-cardinality column with ' || (u + least(gaps, 1)) || "
            f"' unique values; details omitted.' else printf('Unique values: %d, listed as rows.', u + least(gaps, 1)) end, "
            f"case when u + least(gaps, 1) >= 0.9 * n then null else u + least(gaps, 1) end, {rows} "
            f"from (select count(distinct {c}) as u, count(*) filter ({c} is null) as gaps, count(*) as n from d)"
        )
        parts.append(f"select 5, 'columns', '{c}', 'value', coalesce({c}, 'NULL'), count(*), {rows} from d where not {wide} group by {c}")
    dup = f"(count(*) - (select count(*) from (select distinct {rules.key} from d)))"
    add(6, "duplicates", rules.key, "duplicates", _text("%d duplicate rows found out of %d rows (%.2f%%).", dup), dup)
    return (
        f"with d as ({source}), r as (" + " union all ".join(parts) + ") "
        "select *, check_order = max(check_order) over (partition by section, column_name) as final from r"
    )


def resolution_sql(report: str, key: str) -> str:
    return (
        "select *, case "
        + f"when section = 'missing_data' and n = 0 then '{quality.ADVICE['complete']}' "
        + f"when section = 'missing_data' then '{quality.ADVICE['missing']}' "
        + "when section = 'duplicates' then '" + quality.ADVICE["duplicates"].format(key=key).replace("'", "''") + "' "
        + f"when section = 'outliers' then '{quality.ADVICE['outliers']}' "
        + f"when \"check\" = 'invalid value' then '{quality.ADVICE['invalid values']}' when \"check\" = 'value' then '{quality.ADVICE['other']}' "
        + "".join(f"when contains(message, '{p}') then '{quality.ADVICE[p]}' " for p in ("not found", "invalid values", "out of"))
        + f"else '{quality.ADVICE['other']}' end as resolution from ({report})"
    )


ORDERS_REPORT_SQL = report_sql(
    REPORT_ORDERS_SQL, [*NAMES, "amount_text"], ("id", "custkey", "price", "dup_key", "flag", "zero"), (*TEXTS, "amount_text"), ORDER_RULES, ("amount_text",)
)


@query("dq_report", ORDERS_REPORT_SQL)
def dq_report(spark, sf_dir):
    return quality.quality_report(report_orders(spark, sf_dir), ORDER_RULES)


@query("dq_resolutions", f"select section, column_name, \"check\", message, resolution from ({resolution_sql(ORDERS_REPORT_SQL, 'dup_key')})")
def dq_resolutions(spark, sf_dir):
    report = quality.quality_report(report_orders(spark, sf_dir), ORDER_RULES)
    return quality.resolutions(report, "dup_key").select("section", "column_name", "check", "message", "resolution")


def suite_sql(suite, source_sql: str) -> str:
    parts = []
    for i, rule in enumerate(suite):
        kind, k = rule.kind, rule.kwargs
        if kind.startswith("expect_table"):
            success = f"count(*) between {k['min_value']} and {k['max_value']}"
            missing = bad = judged = "cast(null as bigint)"
            column = "cast(null as varchar)"
        else:
            c = f'"{k["column"]}"'
            column = f"'{k['column']}'"
            missing = f"count(*) filter ({c} is null)"
            judged = f"count({c})"
            if "null" in kind:
                bad, judged = missing, "count(*)"
            elif "between" in kind:
                bad = f"count(*) filter ({c} < {k['min_value']} or {c} > {k['max_value']})"
            else:
                values = ", ".join(f"'{v}'" for v in k["value_set"])
                bad = f"count(*) filter ({c} not in ({values}))"
            success = f"{bad} = 0"
        parts.append(
            f"select {i} as rule_no, '{kind}' as expectation, {column} as column_name, true as found, {success} as success, "
            f"count(*) as element_count, {missing} as missing_count, {bad} as unexpected_count, "
            f"round({bad} * 100.0 / nullif({judged}, 0), 6) as unexpected_percent from s"
        )
    return f"with s as ({source_sql}) " + " union all ".join(parts)


def _validated(df, suite):
    return validate(df, suite).withColumn("unexpected_percent", F.round("unexpected_percent", 6))


BLANK_AMOUNT_SQL = f"select * replace (nullif(trim(\"TotalCharges\"), '') as \"TotalCharges\") from ({SOURCE_A_SQL})"


@query("ge_suite_a", suite_sql(SUITE_A, BLANK_AMOUNT_SQL))
def ge_suite_a(spark, sf_dir):
    df = source_a(spark, sf_dir)
    return _validated(df.withColumn("TotalCharges", F.nullif(F.trim("TotalCharges"), F.lit(""))), SUITE_A)


@query("ge_suite_a_raw", suite_sql(SUITE_A, BLANK_AMOUNT_SQL))
def ge_suite_a_raw(spark, sf_dir):
    """As the stage does it: the raw source, blank cells and all."""
    from millrace.plans.stages import suite_results

    return suite_results(source_a(spark, sf_dir), SUITE_A).withColumn("unexpected_percent", F.round("unexpected_percent", 6))


@query("ge_suite_b", suite_sql(SUITE_B, SOURCE_B_SQL))
def ge_suite_b(spark, sf_dir):
    return _validated(source_b(spark, sf_dir), SUITE_B)


def _rules(*pairs):
    return [Expectation(kind, kwargs) for kind, kwargs in pairs]


ROW_COUNT_SUITE = _rules(
    ("expect_table_row_count_to_be_between", {"min_value": 1, "max_value": 15000}),
    ("expect_table_row_count_to_be_between", {"min_value": 100000000000, "max_value": 900000000000}),
)
BETWEEN_SUITE = _rules(
    ("expect_column_values_to_be_between", {"column": "price", "min_value": 1000, "max_value": 400000}),
    ("expect_column_values_to_be_between", {"column": "flag", "min_value": 0, "max_value": 1}),
)
NOT_NULL_SUITE = _rules(
    ("expect_column_values_to_not_be_null", {"column": "price"}),
    ("expect_column_values_to_not_be_null", {"column": "status"}),
)
IN_SET_SUITE = _rules(
    ("expect_column_values_to_be_in_set", {"column": "priority", "value_set": ["1-URGENT", "2-HIGH", "5-LOW"]}),
    ("expect_column_values_to_be_in_set", {"column": "status", "value_set": ["O", "F", "P"]}),
)

for _name, _suite in (
    ("ge_row_count", ROW_COUNT_SUITE),
    ("ge_between", BETWEEN_SUITE),
    ("ge_not_null", NOT_NULL_SUITE),
    ("ge_in_set", IN_SET_SUITE),
):
    query(_name, suite_sql(_suite, DIRTY_ORDERS_SQL))(
        lambda spark, sf_dir, suite=_suite: _validated(dirty_orders(spark, sf_dir), suite)
    )


@query(
    "ge_unexpected_samples",
    WITH_D
    + "select * from (select *, row_number() over (partition by rule_no order by n desc, value) as place from ("
    "select 0 as rule_no, priority as value, count(*) as n from d where priority not in ('1-URGENT') group by 2 union all "
    "select 1, cast(custkey as varchar), count(*) from d where custkey < 10 or custkey > 900 group by 2)) where place <= 20",
)
def ge_unexpected_samples(spark, sf_dir):
    suite = _rules(
        ("expect_column_values_to_be_in_set", {"column": "priority", "value_set": ["1-URGENT"]}),
        ("expect_column_values_to_be_between", {"column": "custkey", "min_value": 10, "max_value": 900}),
    )
    return unexpected_samples(dirty_orders(spark, sf_dir), suite)


SOURCE_A_NUMBERS = ("SeniorCitizen", "tenure", "MonthlyCharges")


@query(
    "dq_report_source_a",
    resolution_sql(
        report_sql(SOURCE_A_SQL, [n for _, n in SOURCE_A], SOURCE_A_NUMBERS, [n for _, n in SOURCE_A if n not in SOURCE_A_NUMBERS], RULES_A, ("TotalCharges",)),
        RULES_A.key,
    ),
)
def dq_report_source_a(spark, sf_dir):
    return quality.resolutions(quality.quality_report(source_a(spark, sf_dir), RULES_A), RULES_A.key)
