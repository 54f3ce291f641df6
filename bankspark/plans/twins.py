"""Independent SQL for the registered queries, to run on another engine over the same tables.

Each statement is written from the rule it checks.  ``TABLES`` holds the common
table expressions; a query names the ones it reads and gets those it depends on.
"""

from __future__ import annotations

import re

from bankspark.schemas import CATEGORY_RANGES, PRODUCT_ROWS


def _values(rows) -> str:
    def literal(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _total(column: str) -> str:
    return f"cast(cast(sum(cast({column} as decimal(18,4))) as decimal(30,2)) as double)"


def _two(expression: str) -> str:
    return f"cast(round(cast({expression} as decimal(30,6)), 2) as double)"


def _mean(column: str) -> str:
    return _two(f"{_total(column)} / count({column})")


def _zero_if_missing(*columns: str) -> str:
    return ", ".join(f"coalesce({c}, 0) as {c}" for c in columns)


# The product behind each holding flag.
HOLDINGS = {
    "has_home": "P05", "has_vehicle": "P06", "has_personal": "P04",
    "has_term_deposit": "P02", "has_card": "P10", "has_investment": "P11",
}
REGION = """case r_name when 'AFRICA' then 'Central' when 'AMERICA' then 'East Coast'
  when 'ASIA' then 'East Malaysia' when 'EUROPE' then 'Northern' when 'MIDDLE EAST' then 'Southern' end"""


def _pad(number: str, width: int) -> str:
    return f"lpad(cast({number} as varchar), cast(greatest({width}, length(cast({number} as varchar))) as int), '0')"


_TOKENS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
_WORDS = r"list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda w: w <> '')"

TABLES = {
    "branches": f"""
select concat('B', {_pad('n_nationkey + 1', 3)}) as branch_id, concat(n_name, ' Main Branch') as branch_name,
  n_name as state, {REGION} as region
from nation join region on n_regionkey = r_regionkey""",
    "customers": f"""
select concat('C', {_pad('c_custkey', 7)}) as customer_id, c_name as name,
  case when c_custkey % 2 = 1 then 'M' else 'F' end as gender, cast(18 + c_custkey % 61 as int) as age,
  n_name as state, {REGION} as region,
  case c_mktsegment when 'AUTOMOBILE' then 'Mass' when 'BUILDING' then 'Mass Affluent'
    when 'FURNITURE' then 'Affluent' when 'HOUSEHOLD' then 'Youth' when 'MACHINERY' then 'Senior' end as segment,
  case when c_acctbal < 1000 then '<3K' when c_acctbal < 3000 then '3K-5K' when c_acctbal < 5000 then '5K-8K'
    when c_acctbal < 7000 then '8K-12K' when c_acctbal < 8500 then '12K-20K' else '>20K' end as income_band,
  concat('B', {_pad('1 + (c_custkey * 7) % 26', 3)}) as home_branch_id,
  cast(date '1994-01-01' + cast((c_custkey * 37) % 2900 as int) as date) as join_date
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "accounts": f"""
select concat('A', {_pad('o_orderkey', 9)}) as account_id, concat('C', {_pad('owner', 7)}) as customer_id,
  concat('P', {_pad('k + 1', 2)}) as product_id,
  case when k between 3 and 9 then -o_totalprice when k = 11 then 0.0 else o_totalprice end as balance_myr,
  cast(o_orderdate as date) as open_date,
  case o_orderstatus when 'F' then 'Active' when 'O' then 'Dormant' when 'P' then 'Closed' end as status
from (select *, cast(floor(o_orderkey / 5) as bigint) % 12 as k,
        case when o_custkey % 15 = 0 then o_custkey + 1 else o_custkey end as owner from orders)""",
    "transactions": f"""
select concat('T', {_pad('l_orderkey', 9)}, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) as txn_id,
  concat('C', {_pad('(case when o_custkey % 10 = 0 then o_custkey + 1 else o_custkey end)', 7)}) as customer_id,
  cast(l_shipdate as date) as txn_date,
  cast((case when l_returnflag = 'R' then -1 else 1 end)
    * (cast(l_quantity as int) * 2 * (1 + l_partkey % 12) * 100 + l_suppkey % 100) as double) / 100 as amount_myr,
  case l_suppkey % 6 when 0 then 'Mobile App' when 1 then 'Internet Banking' when 2 then 'ATM'
    when 3 then 'Branch' when 4 then 'Debit Card' else 'QR Pay' end as channel,
  case l_partkey % 12 when 0 then 'Groceries' when 1 then 'Dining' when 2 then 'Fuel' when 3 then 'Utilities'
    when 4 then 'Retail Shopping' when 5 then 'Healthcare' when 6 then 'Education' when 7 then 'Travel'
    when 8 then 'Telco' when 9 then 'Entertainment' when 10 then 'Transfer' else 'Cash Withdrawal' end as category,
  concat('Merchant ', l_suppkey) as merchant
from lineitem join orders on l_orderkey = o_orderkey""",
    "products": f"""
select * from (values {_values(PRODUCT_ROWS)})
  as p(product_id, product_name, product_type, profit_rate_pct, min_amount_myr)""",
    "group_members": f"""
select distinct principal, unnest(case when principal % 11 = 0 then ['staff']
    when principal % 13 = 0 then [team, 'team_central'] else [team] end) as group_name
from (select c_custkey as principal, concat('team_', lower(replace({REGION}, ' ', '_'))) as team
      from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""",
    "sheets": r"""
select p_partkey as doc_id, p_type as product, concat(
  'Product Disclosure Sheet', chr(10), 'Key Product Features', chr(10),
  'Profit rate:  ', p_size, '.25% per annum', chr(10),
  'Minimum placement:  RM', cast(floor(p_retailprice) as bigint), chr(10), 'Eligibility', chr(10),
  'Age:  ', 18 + p_size % 10, ' to 60 years old', chr(10), 'Fees and Charges', chr(10),
  'Late payment charge:  1% per annum on overdue instalment') as text
from part""",
    "home": """
select c.customer_id, c.name, c.gender, c.age, c.segment, c.income_band, c.home_branch_id, c.join_date,
  b.branch_name, b.state, b.region
from customers c left join branches b on b.branch_id = c.home_branch_id""",
    "held": f"""
select customer_id, count(account_id) as products_held, {_total('balance_myr')} as total_balance_myr
from accounts group by customer_id""",
    "silver_dim": """
select h.customer_id, name, age, segment, income_band, branch_name, state, region,
  coalesce(products_held, 0) as products_held, total_balance_myr, join_date
from home h left join held using (customer_id)""",
    "silver_txn": """
select txn_id, customer_id, amount_myr, channel, category, merchant, txn_date,
  cast(date_trunc('month', txn_date) as timestamp) as txn_month
from transactions where amount_myr > 0""",
    "spent": f"""
select customer_id, count(txn_id) as txn_count, {_total('amount_myr')} as total_spend_myr,
  {_mean('amount_myr')} as avg_txn_myr, max(txn_date) as last_txn_date
from silver_txn group by customer_id""",
    "gold": """
select d.* exclude (join_date), txn_count, total_spend_myr, avg_txn_myr, last_txn_date
from silver_dim d left join spent using (customer_id)""",
    "per_txn_owner": f"""
select customer_id, count(*) as txn_count_90d, {_mean('amount_myr')} as avg_txn_amount,
  {_total('amount_myr')} as total_spend, count(distinct category) as category_variety,
  count(*) filter (channel in ('Mobile App', 'Internet Banking', 'QR Pay')) as digital_txns
from transactions group by customer_id""",
    "per_holder": f"""
select customer_id, count(*) as num_products_held,
  cast(cast(coalesce(sum(cast(balance_myr as decimal(18,4))) filter (balance_myr > 0), 0) as decimal(30,2)) as double) as total_balance,
  {', '.join(f"cast(bool_or(product_id = '{p}') as int) as {flag}" for flag, p in HOLDINGS.items())}
from accounts group by customer_id""",
    "tenure": """
select customer_id, cast(trunc(gap + case when day(later) = day(join_date) then 0
    when later = last_day(later) and join_date = last_day(join_date) then 0
    else (day(later) - day(join_date)) / 31.0 end) as int) as tenure_months
from (select customer_id, join_date, date '2001-08-31' as later,
        (2001 - year(join_date)) * 12 + 8 - month(join_date) as gap from customers)""",
    "ranked": """
select customer_id, income_band, cast(coalesce(list_position(
  ['<3K', '3K-5K', '5K-8K', '8K-12K', '12K-20K', '>20K'], income_band) - 1, 0) as int) as income_rank
from customers""",
    "scored": f"""
select customer_id, case when txn_count_90d > 0
  then {_two('cast(digital_txns as double) / txn_count_90d')} end as digital_engagement_score
from customers left join per_txn_owner using (customer_id)""",
    "wide": f"""
select c.customer_id, c.age, c.gender, c.state, c.region, c.segment, c.income_band, tenure_months,
  {_zero_if_missing('num_products_held', 'total_balance', *HOLDINGS)},
  {_zero_if_missing('txn_count_90d', 'avg_txn_amount', 'total_spend', 'category_variety')},
  digital_engagement_score, income_rank
from customers c join tenure using (customer_id) join scored using (customer_id)
  join ranked using (customer_id) left join per_holder using (customer_id)
  left join per_txn_owner using (customer_id)""",
    "hits": """
select customer_id, unnest([
  case when has_home = 0 and age >= 30 and age <= 50 and income_rank >= 3 then 1 end,
  case when has_investment = 0 and income_rank >= 4 and total_balance > 50000 then 2 end,
  case when has_term_deposit = 0 and age >= 50 and total_balance > 30000 then 3 end,
  case when has_vehicle = 0 and age >= 25 and age <= 45 and income_rank in (2, 3, 4) then 4 end,
  case when has_personal = 0 and age >= 21 and age <= 40 and income_rank in (0, 1, 2) then 5 end,
  case when has_card = 0 and income_rank >= 2 and digital_engagement_score >= 0.5 then 6 end,
  case when age >= 22 and age <= 35 and category_variety >= 5 then 7 end, 8]) as rule
from wide""",
    "features": """
select w.*, ['Home Financing-i', 'Investment-i Fund', 'Term Deposit-i', 'Vehicle Financing-i',
  'Personal Financing-i', 'Credit Card-i', 'Education Financing-i', 'None'][first_rule] as next_best_offer
from wide w join (select customer_id, min(rule) as first_rule from hits group by customer_id) using (customer_id)""",
    "dash": """
select g.customer_id, segment, state, region, products_held, total_balance_myr, total_spend_myr,
  category, channel, amount_myr, txn_date
from gold g join transactions t on g.customer_id = t.customer_id""",
    "my_groups": "\nselect group_name from group_members where principal = 1",
    "my_branches": """
select * from branches where concat('team_', lower(replace(region, ' ', '_'))) in (from my_groups)""",
    "sheet_lines": """
select doc_id, product, pos, line, instr(line, ':  ') as sep
from (select doc_id, product, unnest(string_split(text, chr(10))) as line,
        generate_subscripts(string_split(text, chr(10)), 1) as pos from sheets)""",
    "facts": """
select doc_id, product, section, case when sep > 0 then substr(line, 1, sep - 1) end as label,
  case when sep > 0 then substr(line, sep + 3) else line end as value
from (select *, last_value(case when heading then rtrim(line, ' ' || chr(9) || chr(13)) end ignore nulls) over (
        partition by doc_id order by pos rows between unbounded preceding and current row) as section
      from (select *, rtrim(line, ' ' || chr(9) || chr(13)) in ('Product Overview', 'Key Product Features', 'Eligibility',
        'Fees and Charges', 'Key Risks', 'Protection', 'Important Notice') as heading from sheet_lines))
where not heading and rtrim(line, ' ' || chr(9) || chr(13)) <> ''""",
    "term_uses": f"""
select doc_id, lang, unnest({_TOKENS}) as term from documents""",
    "postings": """
select doc_id, term, count(*) as tf from term_uses group by doc_id, term""",
    "lengths": """
select doc_id, count(*) as doc_len from term_uses group by doc_id""",
    "doc_freq": """
select term, count(*) as df from postings group by term""",
    "asked": f"""
select distinct item_id as question_id, unnest({_TOKENS}) as term from benchmark""",
    "bm25": """
select question_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (0.25 + 0.75 * doc_len / mean_len))), 4) as score
from asked join postings using (term) join doc_freq using (term) join lengths using (doc_id),
  (select count(*) as n from documents),
  (select sum(doc_len) / (select count(*) from documents) as mean_len from lengths)
group by question_id, doc_id""",
    "topics": """
select label, list(m order by dim) as centre from (
  select label, dim, avg(x) as m from (
    select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as dim from embeddings)
  group by label, dim) group by label""",
    "near": """
select cast(t.label as bigint) as question_id, vec_id as doc_id,
  round(list_cosine_similarity(centre, cast(embedding as double[])), 6) as score
from topics t, embeddings""",
    "described": """
select distinct lang as specialist, term from term_uses""",
    "turn_terms": f"""
select distinct conv_id, turn, unnest({_TOKENS}) as term from conversations where role = 'user'""",
    "overlap": """
select conv_id, turn, specialist, count(*) as score
from turn_terms join described using (term) group by conv_id, turn, specialist""",
}

OFFERS_OF_FINANCING = "(select product_name from products where product_type = 'Financing')"


def _check(check: str, table: str, count: str, source: str) -> str:
    return (
        f"select '{check}' as check_name, '{table}' as table_name, cast(coalesce({count}, 0) as bigint) as violations"
        f" from {source}"
    )


def _rows(check: str, table: str, broken: str, source: str | None = None) -> str:
    return _check(check, table, f"sum(case when {broken} then 1 else 0 end)", source or table)


_IDS = {
    "branches": ("branch_id", "^B[0-9]{3,}$"),
    "customers": ("customer_id", "^C[0-9]{7,}$"),
    "accounts": ("account_id", "^A[0-9]{9,}$"),
    "transactions": ("txn_id", "^T[0-9]{9,}(-[0-9]+){3}$"),
}

CHECKS = {
    "dq_pk_unique": [
        _check("pk_unique", t, "count(*)", f"(select {k} from {t} group by {k} having count(*) > 1)")
        for t, (k, _) in _IDS.items()
    ],
    "dq_id_format": [
        _rows("id_format", t, f"not regexp_matches({k}, '{p}')") for t, (k, p) in _IDS.items()
    ],
    "dq_missing": [
        _rows(f"missing_{column}", t, f"{column} is null")
        for t, columns in [
            ("branches", ["branch_id", "region"]), ("customers", ["customer_id", "segment", "home_branch_id", "join_date"]),
            ("accounts", ["account_id", "customer_id", "product_id", "balance_myr"]),
            ("transactions", ["txn_id", "customer_id", "txn_date", "amount_myr"]), ("products", ["product_id", "product_type"]),
        ]
        for column in columns
    ],
    "dq_fk_orphans": [
        _check(check, t, "count(*)", f"{t} c anti join {parent} p on c.{column} = p.{key} where c.{column} is not null")
        for check, t, column, parent, key in [
            ("fk_home_branch", "customers", "home_branch_id", "branches", "branch_id"),
            ("fk_customer", "accounts", "customer_id", "customers", "customer_id"),
            ("fk_product", "accounts", "product_id", "products", "product_id"),
            ("fk_customer", "transactions", "customer_id", "customers", "customer_id"),
        ]
    ],
    "dq_domain": [
        _rows(f"domain_{column}", t, f"{column} not in ({', '.join(repr(v) for v in values)})")
        for t, column, values in [
            ("branches", "region", ["Central", "Southern", "Northern", "East Coast", "East Malaysia"]),
            ("customers", "segment", ["Mass", "Mass Affluent", "Affluent", "Youth", "Senior"]),
            ("customers", "income_band", ["<3K", "3K-5K", "5K-8K", "8K-12K", "12K-20K", ">20K"]),
            ("customers", "region", ["Central", "Southern", "Northern", "East Coast", "East Malaysia"]),
            ("accounts", "status", ["Active", "Dormant", "Closed"]),
            ("products", "product_type", ["Deposit", "Financing", "Card", "Wealth", "Protection"]),
            ("transactions", "channel",
             ["Mobile App", "Internet Banking", "ATM", "Branch", "Debit Card", "QR Pay"]),
            ("transactions", "category", list(CATEGORY_RANGES)),
        ]
    ],
    "dq_region_of_state": [
        _check("region_of_state", "customers", "count(*)",
               "(select state from customers group by state having count(distinct region) > 1)")
    ],
    "dq_segment_age": [
        _rows("segment_age", "customers",
              "(segment = 'Youth' and not age < 26) or (segment = 'Senior' and not age > 60)")
    ],
    "dq_amount_range": [
        _rows("amount_range", "transactions", "amount_myr < low or amount_myr > high",
              "transactions join (values "
              + _values((c, lo, hi) for c, (lo, hi) in CATEGORY_RANGES.items())
              + ") as r(category, low, high) using (category)")
    ],
    "dq_merchant_category": [
        _check("merchant_category", "transactions", "count(*)",
               "(select merchant from transactions group by merchant having count(distinct category) > 1)")
    ],
    "dq_balance_sign": [
        _rows("balance_sign", "accounts",
              "not (case product_type when 'Financing' then balance_myr < 0 when 'Card' then balance_myr <= 0"
              " when 'Protection' then balance_myr = 0 else balance_myr > 0 end)",
              "accounts join products using (product_id)")
    ],
    "dq_holding_rules": [
        _check(f"holding_{p}", "accounts", f"count(*) filter (product_id = '{p}' and not ({allowed}))",
               "accounts join customers using (customer_id) join ranked using (customer_id)")
        for p, allowed in [
            ("P05", "age >= 30 and age <= 52"), ("P06", "age >= 25 and age <= 55"),
            ("P10", "income_rank >= 2"), ("P11", "income_rank >= 4"),
        ]
    ],
    "dq_dates": [
        _rows("txn_after_as_of", "transactions", "txn_date > date '2001-08-31'"),
        _check("opened_before_joining", "accounts", "count(*) filter (year(open_date) < year(join_date))",
               "accounts join customers using (customer_id)"),
    ],
    "dq_one_row_per_customer": [
        _check("one_row_per_customer", t, "count(*) - count(distinct customer_id)", source)
        for t, source in [
            ("silver_customer_dim", "silver_dim"), ("gold_customer_360", "gold"),
            ("customer_360_features", "features"),
        ]
    ],
}

_SUM_BY = _total("amount_myr")

QUERIES = {
    "src_csv_infer": "select * from accounts",
    "src_customer_upload": "select * from customers order by customer_id limit 5",
    "src_table_scan": "select * from customers",
    "src_sample_rows": "select * from customers order by customer_id limit 5",
    "sink_table_overwrite": "select customer_id, age, segment from customers",
    "sink_ctas_replace": "select * from silver_txn",
    "bronze_ingest_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as \"rows\", 0 as rejected from {t}"
        for t in ("accounts", "transactions", "products", "branches", "customers")
    ),
    "meta_comment": """
select 'transactions' as table_name, 'One row per transaction: amount in MYR, channel, category and merchant.' as comment,
  count(*) as row_count from transactions
union all select 'products', 'One row per product: type, profit rate and least amount.', count(*) from products""",
    "meta_set_tag": "select customer_id, region from customers",
    "join_customer_branch": "select * from home",
    "agg_accounts_per_customer": "select * from held",
    "agg_avg_balance_per_customer":
        f"select customer_id, {_mean('balance_myr')} as avg_balance_myr from accounts group by customer_id",
    "agg_txn_per_customer": "select * from spent",
    "silver_customer_dim": "select * exclude (join_date) from silver_dim",
    "silver_dim_has_balance":
        "select * exclude (join_date), total_balance_myr > 0 as has_balance from silver_dim",
    "silver_dim_join_date": "select * from silver_dim",
    "silver_transactions": "select * from silver_txn",
    "silver_txn_is_large": "select *, amount_myr > 1000 as is_large from silver_txn",
    "silver_txn_dayname": "select *, dayname(txn_date) as txn_weekday from silver_txn",
    "gold_customer_360": "select * from gold",
    "gold_spend_per_product":
        "select *, case when products_held > 0 then total_spend_myr / products_held end as spend_per_product from gold",
    "gold_top_customers": "select * from gold where total_spend_myr > 5000",
    "topk_gold_spend": "select * from gold order by total_spend_myr desc nulls last, customer_id limit 10",
    "sort_branches_by_region": "select * from branches order by region, branch_id",
    "feat_txn": "select * from per_txn_owner",
    "feat_acct": "select * from per_holder",
    "feat_tenure": "select * from tenure",
    "feat_digital_score": "select * from scored",
    "feat_months_since_last_product": """
select customer_id, cast(trunc(gap + case when last_open is null then null when day(last_open) = 31 then 0
    when last_open = last_day(last_open) then 0 else (31 - day(last_open)) / 31.0 end) as int)
  as months_since_last_product
from (select customer_id, last_open, (2001 - year(last_open)) * 12 + 8 - month(last_open) as gap
      from customers left join (select customer_id, max(open_date) as last_open from accounts group by customer_id)
        using (customer_id))""",
    "feat_income_rank": "select * from ranked",
    "features_base_join": """
select c.*, h.* exclude (customer_id), t.* exclude (customer_id)
from customers c left join per_holder h using (customer_id) left join per_txn_owner t using (customer_id)""",
    "customer_360_features": "select * from features",
    "feat_offer_distribution":
        "select next_best_offer, count(*) as customers from features group by next_best_offer",
    "offer_segment_action": f"""
select segment, total_spend, next_best_offer as top_offer, n as offered_to
from (select segment, {_total('total_spend')} as total_spend from features group by segment)
left join (
  select segment, next_best_offer, count(*) as n, row_number() over (
    partition by segment order by count(*) desc, next_best_offer desc) as place
  from features where next_best_offer in {OFFERS_OF_FINANCING} group by segment, next_best_offer
  qualify place = 1) using (segment)""",
    "agg_segment_profile": """
select segment, count(*) as customers,
  cast(round(cast(cast(sum(age) as double) / count(age) as decimal(30,6)), 1) as double) as avg_age
from customers group by segment""",
    "agg_spend_by_category":
        f"select category, {_SUM_BY} as total_amount, count(*) as txns from transactions group by category",
    "join_spend_by_segment": f"""
select segment, {_SUM_BY} as total_spend from customers join transactions using (customer_id) group by segment""",
    "agg_segment_spend": f"""
select segment, {_SUM_BY} as total_spend, count(distinct customer_id) as customers,
  {_two(_SUM_BY + ' / count(distinct customer_id)')} as spend_per_customer
from customers join transactions using (customer_id) group by segment""",
    "agg_channel_stats":
        f"select channel, {_mean('amount_myr')} as avg_txn, count(*) as txns from transactions group by channel",
    "eda_age_filter_by_segment": "select segment, count(*) as cust from customers where age > 30 group by segment",
    "dash_dataset": "select * from dash",
    "dash_filter": """
select * from dash where segment in ('Affluent', 'Senior') and region in ('Central', 'East Coast', 'Northern')""",
    "dash_spend_by_category": f"select category, {_SUM_BY} as total_amount from dash group by category",
    "dash_customers_by_state": f"""
select state, count(distinct customer_id) as customers, {_SUM_BY} as total_amount from dash group by state""",
    "dash_spend_by_month": f"""
select cast(date_trunc('month', txn_date) as timestamp) as txn_month, {_SUM_BY} as total_amount
from dash group by 1""",
    "dash_avg_txn_by_channel": f"select channel, {_mean('amount_myr')} as avg_amount from dash group by channel",
    "dash_rollup": f"""
select region, cast(date_trunc('month', txn_date) as timestamp) as txn_month, count(distinct customer_id) as customers,
  count(amount_myr) as txns, {_SUM_BY} as total_amount from dash
where segment in ('Affluent', 'Senior') and region in ('Central', 'East Coast', 'Northern') group by 1, 2""",
    "dash_kpis": f"""
select count(*) as customers, {_total('total_spend_myr')} as total_spend,
  {_mean('total_balance_myr')} as avg_balance, cast(sum(products_held) as bigint) as products_held from gold""",
    "qa_customers_in_state": "select count(*) as customers from gold where state = 'NATION_3'",
    "qa_customers_by_state": "select state, count(*) as customers from gold group by state",
    "qa_certified_values": """
select segment, income_band, count(*) as customers from gold
where segment in ('Mass', 'Mass Affluent', 'Affluent', 'Youth', 'Senior')
  and income_band in ('<3K', '3K-5K', '5K-8K', '8K-12K', '12K-20K', '>20K') group by all""",
    "qa_top_segment_avg_spend": f"""
select segment, {_mean('total_spend_myr')} as avg_total_spend from gold
group by segment order by 2 desc, 1 limit 1""",
    "qa_top_segment_total_spend": f"""
select segment, {_total('total_spend_myr')} as total_spend from gold group by segment order by 2 desc, 1 limit 1""",
    "qa_compare_segments": f"""
select segment, {_total('total_spend_myr')} as total_spend from gold
where segment = 'Youth' or segment = 'Senior' group by segment""",
    "qa_avg_balance_by_segment":
        f"select segment, {_mean('total_balance_myr')} as avg_balance from gold group by segment",
    "qa_avg_balance_by_product_type": f"""
select product_type, {_mean('balance_myr')} as avg_balance
from accounts join products using (product_id) group by product_type""",
    "qa_spend_segment_category":
        f"select segment, {_SUM_BY} as total_amount from dash where category = 'Dining' group by segment",
    "qa_digital_customers": """
select count(*) as digital_customers from (
  select customer_id from transactions group by customer_id
  having avg(case when channel in ('Mobile App', 'Internet Banking') then 1.0 else 0.0 end) > 0.5)""",
    "qa_segment_fewest_financing": """
select segment, count(product_type) as financing_accounts
from customers left join (
  select customer_id, product_type from accounts join products using (product_id)
  where product_type = 'Financing') using (customer_id)
group by segment order by 2, 1 limit 1""",
    "gov_mask_fn": "select customer_id, '***REDACTED***' as name from customers",
    "gov_mask_by_tag": "select * replace ('***REDACTED***' as region) from customers",
    "gov_mask_second_tag": "select * replace ('***REDACTED***' as region, '***REDACTED***' as name) from customers",
    "gov_region_group":
        "select customer_id, concat('team_', lower(replace(region, ' ', '_'))) as group_name from customers",
    "gov_protected_view": """
select customer_id, '***REDACTED***' as name, region from customers
where concat('team_', lower(replace(region, ' ', '_'))) in (select group_name from group_members where principal = 1)""",
    "gov_row_filter": "select * from my_branches",
    "gov_group_coverage": """
select c_custkey as principal, count(group_name) as region_groups
from customer left join (select * from group_members where starts_with(group_name, 'team_'))
  on principal = c_custkey
group by c_custkey having count(group_name) <> 1""",
    "gov_enforced_silver": """
select c.customer_id, '***REDACTED***' as name, age, segment, income_band, b.branch_name, b.state, b.region,
  coalesce(products_held, 0) as products_held, total_balance_myr
from customers c left join my_branches b on home_branch_id = branch_id left join held h on h.customer_id = c.customer_id""",
    "gov_branch_visibility": """
select concat('team_', lower(replace(region, ' ', '_'))) as group_name, count(*) as branches
from branches group by 1""",
    "dq_row_counts": """
select table_name, row_count, expected_rows, abs(row_count - expected_rows) <= 0.1 * expected_rows as within_tolerance
from (select 'customers' as table_name, (select count(*) from customers) as row_count,
        (select count(*) from customer) as expected_rows
  union all select 'accounts', (select count(*) from accounts), (select count(*) from orders)
  union all select 'transactions', (select count(*) from transactions), (select count(*) from lineitem)
  union all select 'branches', (select count(*) from branches), (select count(*) from nation)
  union all select 'products', (select count(*) from products), 12
  union all select 'silver_customer_dim', (select count(*) from silver_dim), (select count(*) from customer)
  union all select 'silver_transactions', (select count(*) from silver_txn), (select count(*) from lineitem))""",
    "docs_chunk_words": f"""
select doc_id, cast(c as bigint) as chunk_no, array_to_string(list_slice(w, c * 200 + 1, c * 200 + 200), ' ') as text
from (select doc_id, w, unnest(range(cast(ceil(len(w) / 200.0) as int))) as c
      from (select doc_id, {_WORDS} as w from documents))""",
    "docs_chunk_wrap": f"""
select doc_id, cast(pos - 1 as bigint) as line_no, line
from (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from (
  select doc_id, case when len(w) = 0 then [''] else list_reduce(list_transform(w, lambda x: [x]), lambda done, x:
    case when length(done[-1]) + 1 + length(x[1]) <= 92
      then list_concat(done[1:len(done) - 1], [done[-1] || ' ' || x[1]]) else list_concat(done, x) end) end as ls
  from (select doc_id, {_WORDS} as w from documents)))""",
    "docs_facts": "select * from facts",
    "docs_headings": r"""
select heading, count(*) filter (leads) as sheets from (
  select distinct doc_id, heading, coalesce(contains(following, ':  '), false) as leads from (
    select doc_id, heading, lead(heading) over (partition by doc_id order by pos) as following from (
      select doc_id, pos, rtrim(line, ' ' || chr(9) || chr(13)) as heading from sheet_lines) where heading <> ''))
where not contains(heading, ':  ') group by heading
having count(*) filter (leads) >= greatest(2, 0.05 * (select count(*) from sheets)) and 2 * count(*) filter (leads) > count(*)""",
    "docs_facts_found": "select * from facts",
    "docs_rate_parse": r"""
select *, try_cast(nullif(regexp_extract(value, '([0-9]+(\.[0-9]+)?)\s*% per annum', 1), '') as double) as rate_pct
from facts""",
    "docs_amount_parse": r"""
select *, try_cast(nullif(replace(regexp_extract(value, 'RM([0-9][0-9,]*(\.[0-9]+)?)', 1), ',', ''), '') as double)
  as amount_myr from facts""",
    "docs_label_lookup": "select * from facts where section = 'Eligibility'",
    "docs_compare_products": """
select label, case product when 'ECONOMY' then 'a' else 'b' end as side, value, doc_id,
  count(distinct product) over (partition by label) = 2 as both_sides
from facts where product in ('ECONOMY', 'PROMO') and label is not null""",
    "docs_catalog_reconcile": """
select coalesce(c.doc_id, s.doc_id) as doc_id, profit_rate_pct, sheet_rate_pct,
  case when s.doc_id is null then 'missing sheet' when c.doc_id is null then 'missing product'
    when sheet_rate_pct is null then 'no rate in sheet'
    when abs(sheet_rate_pct - profit_rate_pct) > 0.001 then 'rate differs' else 'match' end as status
from (select case when p_partkey % 7 = 0 then -1 - p_partkey else p_partkey end as doc_id,
        p_size + case when p_partkey % 11 = 0 then 0.75::double else 0.25::double end as profit_rate_pct from part) c
full join (select p_partkey as doc_id, p_size + 0.25::double as sheet_rate_pct from part) s on c.doc_id = s.doc_id""",
    "docs_term_stats": """
select doc_id, term, tf, doc_len from postings join lengths using (doc_id)""",
    "docs_document_frequency": "select * from doc_freq",
    "docs_bm25_topk": """
select question_id, rank, doc_id, score from (
  select *, row_number() over (partition by question_id order by score desc, doc_id) as rank from bm25)
where rank <= 5""",
    "docs_cosine_topk": """
select question_id, rank, doc_id, score from (
  select *, row_number() over (partition by question_id order by score desc, doc_id) as rank from near)
where rank <= 5""",
    "docs_cited_chunks": f"""
select * from (with pieces as (
  select doc_id, cast(c as bigint) as chunk_no, doc_id || '#' || c as key,
    array_to_string(list_slice(w, c * 200 + 1, c * 200 + 200), ' ') as text
  from (select doc_id, w, unnest(range(cast(ceil(len(w) / 200.0) as int))) as c
        from (select doc_id, {_WORDS} as w from documents))),
said as (select key, unnest({_TOKENS}) as term from pieces),
counts as (select key, term, count(*) as tf from said group by all),
sizes as (select p.key, count(term) as size from pieces p left join said using (key) group by all),
dfs as (select term, count(*) as df from counts group by all),
scored as (
  select question_id, key, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
      / (tf + 1.2 * (0.25 + 0.75 * size / mean_size))), 4) as score
  from asked join counts using (term) join dfs using (term) join sizes using (key),
    (select count(*) as n, sum(size) / count(*) as mean_size from sizes) group by question_id, key),
classes as (
  select id, cast(dim as int) as dim, count(*)::double as n from (
    select id, (ascii(term) * 31 + ascii(right(term, 1)) * 7 + length(term)) % 64 as dim from (
      select 'c' || key as id, term from said
      union all select 'q' || item_id, unnest({_TOKENS}) from benchmark)) group by all),
vectors as (
  select id, list_transform(range(64), lambda d: coalesce(map_extract(m, cast(d as int))[1], 0.0)) as v
  from (select id, map_from_entries(list((dim, n))) as m from classes group by id)),
close as (
  select cast(substr(q.id, 2) as bigint) as question_id, substr(c.id, 2) as key, round(list_cosine_similarity(q.v, c.v), 6) as score
  from vectors q, vectors c where q.id like 'q%' and c.id like 'c%'),
both_ranks as (
  select question_id, key, row_number() over (partition by question_id order by score desc, key) as place from scored where score > 0
  union all select question_id, key, row_number() over (partition by question_id order by score desc, key) from close),
fused as (
  select question_id, key, round(sum(1 / (60 + place)), 8) as score from both_ranks where place <= 20 group by all),
cited as (
  select question_id, doc_id, chunk_no, score from fused join pieces using (key)
  qualify row_number() over (partition by question_id, doc_id, chunk_no // 3 order by score desc, doc_id, chunk_no) = 1)
select * from (
  select question_id, row_number() over (partition by question_id order by score desc, doc_id, chunk_no) as rank, doc_id, chunk_no, score
  from cited) where rank <= 5)""",
    "route_questions": """
select conv_id, turn, coalesce(specialist, 'none') as specialist, coalesce(score, 0) as score
from (select conv_id, turn from conversations where role = 'user') left join (
  select *, row_number() over (partition by conv_id, turn order by score desc, specialist) as place from overlap)
  using (conv_id, turn) where coalesce(place, 1) = 1""",
    "route_multi": """
select conv_id, turn, coalesce(string_agg(specialist, ',' order by specialist) filter (score >= 2),
    arg_min(specialist, (-score, specialist)), 'none') as specialists,
  case when max(score) >= 2 then count(*) filter (score >= 2) when max(score) is null then 0 else 1 end as n_specialists
from (select conv_id, turn from conversations where role = 'user') left join overlap using (conv_id, turn)
group by conv_id, turn""",
    "ml_split": """
select *, case when cast('0x' || substr(md5(customer_id), 1, 8) as bigint) % 10 < 8 then 'train' else 'test' end as split
from features""",
}

_SPLIT = "case when cast('0x' || substr(md5(customer_id), 1, 8) as bigint) % 10 < 8 then 'train' else 'test' end as split"
# What the offer models look at.
MODEL_INPUTS = [
    "age", "income_rank", "tenure_months", "num_products_held", "total_balance", *HOLDINGS,
    "txn_count_90d", "avg_txn_amount", "total_spend", "category_variety", "digital_engagement_score",
]
_LIKELIHOOD = " + ".join(
    f"(-0.5 * ln(v_{c} + 0.001 * w_{c} + 1e-9) - (x_{c} - m_{c}) * (x_{c} - m_{c}) / (2 * (v_{c} + 0.001 * w_{c} + 1e-9)))"
    for c in MODEL_INPUTS
)
QUERIES["ml_folds"] = f"""
select customer_id, next_best_offer, place, cast(place % 3 as int) as fold from (
  select customer_id, next_best_offer,
    row_number() over (partition by next_best_offer order by md5(concat('7:', customer_id)), customer_id) - 1 as place
  from (select *, {_SPLIT} from features) where split = 'train')"""
TABLES["model_rows"] = f"""
select customer_id, next_best_offer, {_SPLIT}, {', '.join(f'cast(coalesce({c}, 0) as double) as x_{c}' for c in MODEL_INPUTS)}
from features"""
TABLES["label_moments"] = f"""
select next_best_offer as label, count(*) as n, {', '.join(f'avg(x_{c}) as m_{c}, var_pop(x_{c}) as v_{c}' for c in MODEL_INPUTS)}
from model_rows where split = 'train' and next_best_offer is not null group by 1"""
TABLES["whole_moments"] = f"""
select count(*) as total, {', '.join(f'var_pop(x_{c}) as w_{c}' for c in MODEL_INPUTS)}
from model_rows where split = 'train' and next_best_offer is not null"""
QUERIES["ml_naive_bayes"] = f"""
select customer_id, split, next_best_offer, label as bayes_offer from (
  select *, row_number() over (partition by customer_id order by ln(n / total) + {_LIKELIHOOD} desc, label desc) as place
  from model_rows cross join label_moments cross join whole_moments) where place = 1"""

QUERIES |= {name: " union all ".join(parts) for name, parts in CHECKS.items()}
QUERIES["dq_states_report"] = "select check_name, table_name, violations from (" + " union all ".join(
    part for name, parts in CHECKS.items() for part in parts
    if name in ("dq_pk_unique", "dq_id_format", "dq_missing", "dq_domain", "dq_segment_age", "dq_amount_range", "dq_dates")
) + ") where table_name in ('customers', 'transactions') and check_name <> 'opened_before_joining'"
QUERIES["dq_report"] = " union all ".join([
    *(part for parts in CHECKS.values() for part in parts),
    "select 'row_count', table_name, cast(case when within_tolerance then 0 else 1 end as bigint) from ("
    + QUERIES["dq_row_counts"] + ") where table_name <> 'silver_transactions'",
])

_NAMES = re.compile(r"\b(" + "|".join(sorted(TABLES, key=len, reverse=True)) + r")\b")


def _needed(sql: str) -> list[str]:
    """The tables a statement reads, each after the ones it is built from."""
    ordered: list[str] = []
    for name in dict.fromkeys(_NAMES.findall(re.sub(r"'[^']*'", "", sql))):
        for table in [*_needed(TABLES[name]), name]:
            if table not in ordered:
                ordered.append(table)
    return ordered


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, sql in QUERIES.items():
        tables = _needed(sql)
        head = "with " + ",\n".join(f"{t} as ({TABLES[t].strip()})" for t in tables) + "\n" if tables else ""
        statements[name] = head + sql.strip()
    return statements
