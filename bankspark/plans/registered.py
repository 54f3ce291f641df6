"""Every registered query: (spark, sf_dir) -> DataFrame over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankspark import schemas as S
from bankspark.operators import bayes as B
from bankspark.operators import check_states as K
from bankspark.operators import documents as D
from bankspark.operators import features as E
from bankspark.operators import fusion as N
from bankspark.operators import governance as G
from bankspark.operators import halving as H
from bankspark.operators import medallion as M
from bankspark.operators import metrics as Q
from bankspark.operators import offers as O
from bankspark.operators import policies as V
from bankspark.operators import quality as C
from bankspark.operators import retrieval as R
from bankspark.operators import rollup as L
from bankspark.operators import routing as W
from bankspark.operators.combine import union_all
from bankspark.sources import files, tables
from bankspark.sources.mapping import AS_OF, GivenTables, customers_view_sql
from bankspark.sources.scratch import exists, shared_folder, store, table_prefix
from bankspark.sources.tags import columns_with_tag, scan_tagged, set_tag, tag_table

COMMENTS = {
    "transactions": "One row per transaction: amount in MYR, channel, category and merchant.",
    "products": "One row per product: type, profit rate and least amount.",
}
PRODUCTS = 12  # fixed value: the size of the catalog
PRINCIPAL = 1
HOME_STATE = "NATION_3"
FORMATS = {
    "branches": "^B[0-9]{3,}$",
    "customers": "^C[0-9]{7,}$",
    "accounts": "^A[0-9]{9,}$",
    "transactions": "^T[0-9]{9,}(-[0-9]+){3}$",
}
DASHBOARD_CHOICE = {
    "segment": ["Affluent", "Senior"],
    "region": ["Central", "East Coast", "Northern"],
    "state": [],
}
POLICIES = [G.MaskPolicy("mask_pii"), G.RowFilterPolicy("branches_by_region")]

Query = Callable[[SparkSession, str], DataFrame]


class Bank(GivenTables):
    """The given tables plus the tables the jobs build from them."""

    @property
    def silver_dim(self) -> DataFrame:
        return M.silver_customer_dim(self.customers, self.branches, self.accounts)

    @property
    def silver_txn(self) -> DataFrame:
        return M.silver_transactions(self.transactions)

    @property
    def gold(self) -> DataFrame:
        return M.gold_customer_360(self.silver_dim, self.silver_txn)

    @property
    def profile(self) -> DataFrame:
        """The gold columns that come from the customer and its branch alone."""
        return M.join_customer_branch(self.customers, self.branches)

    @property
    def gold_spend(self) -> DataFrame:
        """The gold columns of the profile and the spend summary."""
        return M.gold_customer_360(self.profile, self.silver_txn)

    @property
    def features(self) -> DataFrame:
        return E.customer_360_features(self.customers, self.accounts, self.transactions, AS_OF)

    @property
    def facts(self) -> DataFrame:
        return D.docs_facts(self.sheets)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "branches": self.branches,
            "customers": self.customers,
            "accounts": self.accounts,
            "transactions": self.transactions,
            "products": self.products,
        }

    @property
    def tagged_customers(self) -> DataFrame:
        return set_tag(self.customers, "region", "pii", "true")

    @property
    def tagged_branches(self) -> DataFrame:
        return set_tag(self.branches, "region", "region_filter", "true")

    @property
    def questions(self) -> DataFrame:
        return self.raw("benchmark").select(F.col("item_id").alias("question_id"), "text")

    @property
    def user_turns(self) -> DataFrame:
        return self.raw("conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")

    @property
    def specialists(self) -> DataFrame:
        return W.vocabularies(self.documents, "lang")

    @property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")

    # Sources and sinks.  Each run writes to a folder of its own, under names of its own.

    def as_csv(self, *names: str) -> dict[str, str]:
        root = shared_folder(self.spark)
        paths = {name: f"{root}/{name}.csv" for name in names}
        for name, path in paths.items():
            self.tables[name].write.option("header", True).csv(path)
        return paths

    def csv_inferred(self) -> DataFrame:
        return files.read_csv(self.spark, self.as_csv("accounts")["accounts"])

    def customer_upload(self) -> DataFrame:
        """The customers of a CSV file; a line with a bad cell is kept in a table of rejects."""
        uploaded = files.read_csv_with_rejects(self.spark, self.as_csv("customers")["customers"], S.CUSTOMERS)
        stored = table_prefix() + "customers"
        tables.write_counted(uploaded, stored, f"{shared_folder(self.spark)}/{stored}", f"{stored}_rejected")
        return files.preview(tables.scan(self.spark, stored), 5, "customer_id")

    def table_overwrite(self) -> DataFrame:
        name = table_prefix() + "customers"
        path = f"{shared_folder(self.spark)}/{name}"
        tables.write_table(self.customers.select("customer_id", "name"), name, path)
        tables.write_table(self.customers.select("customer_id", "age", "segment"), name, path)
        return tables.scan(self.spark, name)

    def ingest_counts(self) -> DataFrame:
        return tables.ingest(
            self.spark, self.as_csv("accounts", "transactions", "products", "branches", "customers"),
            S.TABLES, shared_folder(self.spark), table_prefix(),
        )

    def table_scan(self) -> DataFrame:
        return tables.scan(self.spark, f"spark_catalog.default.{self.store('customers', self.customers)}")

    def ctas(self) -> DataFrame:
        name = table_prefix() + "silver_transactions"
        return tables.create_or_replace(self.spark, name, self.silver_txn, f"{shared_folder(self.spark)}/{name}")

    def store(self, name: str, df: DataFrame) -> str:
        stored = table_prefix() + name
        tables.write_table(df, stored, f"{shared_folder(self.spark)}/{stored}")
        return stored

    def comment(self) -> DataFrame:
        """Two described tables: their comments as the catalog returns them, and their rows.

        The table of transactions stands over the files as they are (a line item is a transaction).
        """
        described = []
        for table, text in COMMENTS.items():
            if table == "transactions":
                name = table_prefix() + table
                tables.attach(self.spark, name, f"{self.sf_dir}/lineitem.parquet")
            else:
                name = self.store(table, self.tables[table])
            tables.comment_on(self.spark, name, text)
            described.append(tables.scan(self.spark, name).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(table).alias("table_name"), F.lit(tables.comment_of(self.spark, name)).alias("comment"), "row_count",
            ))
        return union_all(described)

    def tagged_columns(self) -> DataFrame:
        """The key and the columns that a stored table has tagged as personal."""
        name = self.customers_view()
        tag_table(self.spark, name, "region", "pii", "true")
        stored = scan_tagged(self.spark, name)
        return stored.select("customer_id", *columns_with_tag(stored, "pii", "true"))

    def customers_view(self) -> str:
        """A view of the customers over the given files, by name; nothing is copied."""
        prefix = table_prefix()
        for given in ("customer", "nation", "region"):
            tables.attach(self.spark, prefix + given, f"{self.sf_dir}/{given}.parquet")
        self.spark.sql(customers_view_sql(prefix))
        return f"{prefix}customers"

    def protected_customers(self) -> DataFrame:
        """Customers as the session's user, who has the groups of one principal, sees them by the table's name."""
        base, prefix = self.customers_view(), table_prefix()
        tag_table(self.spark, base, "name", "pii", "true")
        tag_table(self.spark, base, "region", "region_filter", "true")
        own = G.groups_of(self.group_members, PRINCIPAL).select(F.current_user().alias("principal"), F.col("_group").alias("group_name"))
        tables.write_table(own, prefix + "members", f"{shared_folder(self.spark)}/members")
        tables.write_table(V.policy_rows(self.spark, POLICIES), prefix + "policies", f"{shared_folder(self.spark)}/policies")
        V.protect(self.spark, base, prefix + "visible", prefix + "policies", prefix + "members")
        return self.spark.sql(f"SELECT customer_id, name, region FROM {prefix}visible")

    # Governance

    def masked_twice_tagged(self) -> DataFrame:
        return G.mask_by_tag(set_tag(self.tagged_customers, "name", "pii", "true"), POLICIES)

    def visible_branches(self) -> DataFrame:
        return G.enforce(self.tagged_branches, POLICIES, self.group_members, PRINCIPAL)

    def enforced_silver(self) -> DataFrame:
        """The silver dimension built by one principal: masked names, other regions' branches NULL."""
        customers = set_tag(self.customers, "name", "pii", "true")
        return M.silver_customer_dim(
            G.enforce(customers, POLICIES, self.group_members, PRINCIPAL),
            self.visible_branches(), self.accounts,
        )

    # Quality

    def expected_rows(self) -> DataFrame:
        sources = {
            "customers": "customer", "accounts": "orders", "transactions": "lineitem",
            "branches": "nation", "silver_customer_dim": "customer", "silver_transactions": "lineitem",
        }
        products = self.spark.range(1).select(F.lit(PRODUCTS).cast("bigint").alias("expected_rows"), F.lit("products").alias("table_name"))
        return union_all([
            *(
                self.raw(source).agg(F.count(F.lit(1)).alias("expected_rows")).withColumn("table_name", F.lit(table))
                for table, source in sources.items()
            ),
            products,
        ])

    def row_counts(self) -> DataFrame:
        built = dict(self.tables)
        built |= {"silver_customer_dim": self.silver_dim, "silver_transactions": self.silver_txn}
        return C.dq_row_counts(built, self.expected_rows(), tolerance=0.1)

    def report(self) -> DataFrame:
        """All checks, those of customer grain included.

        Transactions are joined from two tables and read by many checks, so they are stored once; else each check
        would shuffle the columns it needs again.
        """
        self.transactions = store(self.transactions, compression="zstd")
        return C.dq_report(self.tables, AS_OF, FORMATS, self.customer_grain, self.expected_rows())

    def states_report(self) -> DataFrame:
        """Rules and keys of the customers and transactions, from the stored states of parts by ranges of their ids."""
        rules = C.merge_rules(C.missing_rules(), C.id_format_rules(FORMATS), C.domain_rules(), C.segment_age_rules(),
                              C.amount_range_rules(), C.txn_date_rules(AS_OF))
        part = {"customers": F.substring("customer_id", 1, 5), "transactions": F.substring("txn_id", 1, 6)}
        keys = {t: C.PRIMARY_KEYS[t] for t in part}
        states = store(union_all([
            K.part_states(self.tables[t], t, part[t], rules[t], keys[t]) for t in part
        ]))
        return K.report(states, keys, lambda t, names: self.tables[t].filter(part[t].isin(list(names))).select(keys[t]))

    @property
    def customer_grain(self) -> dict[str, DataFrame]:
        return {
            "silver_customer_dim": self.silver_dim,
            "gold_customer_360": self.gold,
            "customer_360_features": self.features,
        }


_saved: dict[tuple[str, str], str] = {}


def offer_model(bank: Bank) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """The stored feature table, the leaderboard and the best model, trained once per session and content of the table, then loaded."""
    features = store(bank.features)
    key = (bank.spark.sparkContext.applicationId, O.fingerprint(features))
    if key not in _saved or not exists(bank.spark, _saved[key]):
        _saved[key] = shared_folder(bank.spark)
        O.save(bank.spark, O.train(features), _saved[key])
    return features, *O.load(bank.spark, _saved[key])


def offers_of_all(bank: Bank) -> DataFrame:
    features, _, model = offer_model(bank)
    return O.score(features, model)


def _over_bank(job: Callable[[Bank], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(Bank(spark, sf_dir))


JOBS: dict[str, Callable[[Bank], DataFrame]] = {
    # Sources and sinks
    "src_csv_infer": lambda b: b.csv_inferred(),
    "src_customer_upload": lambda b: b.customer_upload(),
    "src_table_scan": lambda b: b.table_scan(),
    "src_sample_rows": lambda b: files.preview(b.customers, 5, "customer_id"),
    "sink_table_overwrite": lambda b: b.table_overwrite(),
    "sink_ctas_replace": lambda b: b.ctas(),
    "bronze_ingest_counts": lambda b: b.ingest_counts(),
    "meta_comment": lambda b: b.comment(),
    "meta_set_tag": lambda b: b.tagged_columns(),
    # Silver and gold
    "join_customer_branch": lambda b: b.profile,
    "agg_accounts_per_customer": lambda b: M.agg_accounts_per_customer(b.accounts),
    "agg_avg_balance_per_customer": lambda b: M.agg_avg_balance_per_customer(b.accounts),
    "agg_txn_per_customer": lambda b: M.agg_txn_per_customer(b.silver_txn),
    "silver_customer_dim": lambda b: b.silver_dim,
    "silver_dim_has_balance": lambda b: M.silver_customer_dim(
        b.customers, b.branches, b.accounts, with_has_balance=True),
    "silver_dim_join_date": lambda b: M.silver_customer_dim(
        b.customers, b.branches, b.accounts, with_join_date=True),
    "silver_transactions": lambda b: b.silver_txn,
    "silver_txn_is_large": lambda b: M.silver_transactions(b.transactions, with_is_large=True),
    "silver_txn_dayname": lambda b: M.silver_transactions(b.transactions, with_dayname=True),
    "gold_customer_360": lambda b: b.gold,
    "gold_spend_per_product": lambda b: M.gold_customer_360(b.silver_dim, b.silver_txn, with_spend_per_product=True),
    "gold_top_customers": lambda b: M.gold_top_customers(b.gold),
    "topk_gold_spend": lambda b: M.topk_gold_spend(b.gold),
    "sort_branches_by_region": lambda b: b.branches.orderBy("region", "branch_id"),
    # Features and offers
    "feat_txn": lambda b: E.feat_txn(b.transactions),
    "feat_acct": lambda b: E.feat_acct(b.accounts),
    "feat_tenure": lambda b: E.feat_tenure(b.customers, AS_OF),
    "feat_digital_score": lambda b: E.feat_digital_score(b.customers, b.transactions),
    "feat_months_since_last_product": lambda b: E.feat_months_since_last_product(b.customers, b.accounts, AS_OF),
    "feat_income_rank": lambda b: E.feat_income_rank(b.customers),
    "features_base_join": lambda b: E.features_base_join(b.customers, b.accounts, b.transactions),
    "customer_360_features": lambda b: b.features,
    "feat_offer_distribution": lambda b: E.feat_offer_distribution(b.features),
    "offer_segment_action": lambda b: Q.offer_segment_action(b.features, b.products),
    # Exploration
    "agg_segment_profile": lambda b: Q.agg_segment_profile(b.customers),
    "agg_spend_by_category": lambda b: Q.agg_spend_by_category(b.transactions),
    "join_spend_by_segment": lambda b: Q.join_spend_by_segment(b.customers, b.transactions),
    "agg_segment_spend": lambda b: Q.agg_segment_spend(b.customers, b.transactions),
    "agg_channel_stats": lambda b: Q.agg_channel_stats(b.transactions),
    "eda_age_filter_by_segment": lambda b: Q.eda_age_filter_by_segment(b.customers),
    # Dashboard
    "dash_dataset": lambda b: Q.dash_dataset(b.gold, b.transactions),
    "dash_filter": lambda b: Q.apply_filters(Q.dash_dataset(b.gold, b.transactions), DASHBOARD_CHOICE),
    "dash_spend_by_category": lambda b: Q.dash_spend_by_category(b.profile, b.transactions),
    "dash_customers_by_state": lambda b: Q.dash_customers_by_state(b.profile, b.transactions),
    "dash_spend_by_month": lambda b: Q.dash_spend_by_month(b.profile, b.transactions),
    "dash_avg_txn_by_channel": lambda b: Q.dash_avg_txn_by_channel(b.profile, b.transactions),
    "dash_rollup": lambda b: L.spend_by(
        store(L.spend_cells(b.profile, b.transactions)), ["region", "txn_month"], DASHBOARD_CHOICE),
    "dash_kpis": lambda b: Q.dash_kpis(b.gold),
    # Analyst questions
    "qa_customers_in_state": lambda b: Q.qa_customers_in_state(b.profile, HOME_STATE),
    "qa_customers_by_state": lambda b: Q.qa_customers_by_state(b.profile),
    "qa_certified_values": lambda b: Q.qa_certified_values(b.profile),
    "qa_top_segment_avg_spend": lambda b: Q.qa_top_segment_avg_spend(b.gold_spend),
    "qa_top_segment_total_spend": lambda b: Q.qa_top_segment_total_spend(b.gold_spend),
    "qa_compare_segments": lambda b: Q.qa_compare_segments(b.gold_spend, "Youth", "Senior"),
    "qa_avg_balance_by_segment": lambda b: Q.qa_avg_balance_by_segment(b.silver_dim),
    "qa_avg_balance_by_product_type": lambda b: Q.qa_avg_balance_by_product_type(b.accounts, b.products),
    "qa_spend_segment_category": lambda b: Q.qa_spend_segment_category(b.profile, b.transactions, "Dining"),
    "qa_digital_customers": lambda b: Q.qa_digital_customers(b.transactions),
    "qa_segment_fewest_financing": lambda b: Q.qa_segment_fewest_financing(b.customers, b.accounts, b.products),
    # Governance
    "gov_mask_fn": lambda b: b.customers.select("customer_id", G.mask_value().alias("name")),
    "gov_mask_by_tag": lambda b: G.mask_by_tag(b.tagged_customers, POLICIES),
    "gov_mask_second_tag": lambda b: b.masked_twice_tagged(),
    "gov_region_group": lambda b: b.customers.select("customer_id", G.region_group("region").alias("group_name")),
    "gov_row_filter": lambda b: b.visible_branches(),
    "gov_group_coverage": lambda b: G.group_coverage(
        b.raw("customer").select(F.col("c_custkey").alias("principal")), b.group_members),
    "gov_protected_view": lambda b: b.protected_customers(),
    "gov_enforced_silver": lambda b: b.enforced_silver(),
    "gov_branch_visibility": lambda b: G.branch_visibility(b.branches),
    # Quality
    "dq_pk_unique": lambda b: C.dq_pk_unique(b.tables),
    "dq_id_format": lambda b: C.dq_id_format(b.tables, FORMATS),
    "dq_fk_orphans": lambda b: C.dq_fk_orphans(b.tables),
    "dq_domain": lambda b: C.dq_domain(b.tables),
    "dq_region_of_state": lambda b: C.dq_region_of_state(b.customers),
    "dq_segment_age": lambda b: C.dq_segment_age(b.customers),
    "dq_amount_range": lambda b: C.dq_amount_range(b.transactions),
    "dq_merchant_category": lambda b: C.dq_merchant_category(b.transactions),
    "dq_balance_sign": lambda b: C.dq_balance_sign(b.accounts, b.products),
    "dq_holding_rules": lambda b: C.dq_holding_rules(b.customers, b.accounts),
    "dq_dates": lambda b: C.dq_dates(b.customers, b.accounts, b.transactions, AS_OF),
    "dq_row_counts": lambda b: b.row_counts(),
    "dq_one_row_per_customer": lambda b: C.dq_one_row_per_customer(b.customer_grain),
    "dq_states_report": lambda b: b.states_report(),
    "dq_missing": lambda b: C.dq_missing(b.tables),
    "dq_report": lambda b: b.report(),
    # Documents
    "docs_chunk_words": lambda b: D.docs_chunk_words(b.documents),
    "docs_chunk_wrap": lambda b: D.docs_chunk_wrap(b.documents),
    "docs_facts": lambda b: b.facts,
    "docs_headings": lambda b: D.docs_headings(b.sheets),
    "docs_facts_found": lambda b: D.docs_facts_found(b.sheets),
    "docs_rate_parse": lambda b: D.docs_rate_parse(b.facts),
    "docs_amount_parse": lambda b: D.docs_amount_parse(b.facts),
    "docs_label_lookup": lambda b: D.docs_label_lookup(b.facts, section="Eligibility"),
    "docs_compare_products": lambda b: D.docs_compare_products(b.facts, "ECONOMY", "PROMO"),
    "docs_catalog_reconcile": lambda b: D.docs_catalog_reconcile(
        b.catalog, D.sheet_rates(b.facts, "doc_id"), "doc_id"),
    "docs_term_stats": lambda b: D.docs_term_stats(b.documents),
    "docs_document_frequency": lambda b: D.docs_document_frequency(b.documents),
    "docs_bm25_topk": lambda b: R.docs_bm25_topk(b.documents, b.questions),
    "docs_cosine_topk": lambda b: R.docs_cosine_topk(b.vectors, R.topic_vectors(b.vectors)),
    "docs_cited_chunks": lambda b: N.docs_cited_chunks(b.documents, b.questions),
    "route_questions": lambda b: W.route_questions(b.user_turns, b.specialists),
    "route_multi": lambda b: W.route_multi(b.user_turns, b.specialists),
    # Offer model
    "ml_split": lambda b: O.ml_split(b.features),
    "ml_leaderboard": lambda b: offer_model(b)[1],
    "ml_folds": lambda b: H.ml_folds(b.features),
    "ml_search": lambda b: H.ml_search(b.features),
    "ml_naive_bayes": lambda b: B.ml_naive_bayes(b.features),
    "ml_batch_score": offers_of_all,
    "ml_offer_actions": lambda b: O.actions(offers_of_all(b)),
}


def queries() -> dict[str, Query]:
    return {name: _over_bank(job) for name, job in JOBS.items()}
