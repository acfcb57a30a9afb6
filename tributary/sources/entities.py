"""The bank's source tables as views over the given tables.

Each view is a column mapping over one whole table (two for the loan children). Child rows
without a parent exist because one segment's applications go under keys of their own. The
kinds of a table that holds several (events, lines) are told apart by its kind column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import skew_safe_join

MONEY = "decimal(18,2)"
CHILDLESS_SEGMENT = "MACHINERY"
SECOND_ACCOUNT_SEGMENT = "HOUSEHOLD"


class Entities:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- card system (raw, with the unmasked originator) --
    def card_bronze(self) -> DataFrame:
        return self.table("events").selectExpr(
            "cast(event_id as string) as txn_id",
            "ts as txn_ts",
            "event_type as type",
            f"cast(value as {MONEY}) as amount",
            "'MYR' as currency",
            "concat('C', lpad(cast(user_id as string), 8, '0')) as nameOrig",
            "case when event_id % 4 = 0 then concat('M', lpad(cast(event_id % 50 as string), 8, '0'))"
            " else concat('C', lpad(cast(user_id * 7 + event_id % 5 as string), 8, '0')) end as nameDest",
            "case when event_type = 'error' then 1L else 0L end as isFraud",
            "case when event_type = 'error' and value > 30 then 1L else 0L end as isFlaggedFraud",
            f"cast(event_id % 1000 as {MONEY}) as oldbalance",
            f"cast(cast(event_id % 1000 as {MONEY}) + case event_type when 'purchase' then -cast(value as {MONEY})"
            f" when 'click' then 0 else cast(value as {MONEY}) end as {MONEY}) as newbalance",
            "ts as created_at",
            "ts as updated_at",
        )

    # -- core banking system --
    def client(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as client_id",
            "case when c_custkey % 97 = 0 then '7003' when c_custkey % 89 = 0 then '70031X' else concat("
            "lpad(cast(c_custkey % 100 as string), 2, '0'),"
            "lpad(cast(c_custkey % 13 + 1 + case when c_custkey % 2 = 0 then 50 else 0 end as string), 2, '0'),"
            "lpad(cast(c_custkey % 31 + 1 as string), 2, '0')) end as birth_number",
            "cast(c_nationkey as string) as district_id",
        )

    def district(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr("cast(n_nationkey as string) as district_id", "n_name as name", "r_name as region")
        )

    def disp(self) -> DataFrame:
        """Client to account links: two clients share an account, some clients hold a second one."""
        links = (
            "array(struct(cast(c_custkey div 2 as string) as account_id,"
            " if(c_custkey % 2 = 0, 'OWNER', 'DISPONENT') as type)"
            ", struct(if(c_mktsegment = '{s}', concat('S', cast(c_custkey as string)), null) as account_id, 'OWNER' as type))"
        ).format(s=SECOND_ACCOUNT_SEGMENT)
        return (
            self.table("customer")
            .selectExpr("cast(c_custkey as string) as client_id", f"explode({links}) as link")
            .selectExpr("concat(client_id, '-', link.account_id) as disp_id", "client_id", "link.account_id as account_id", "link.type as type")
            .where("account_id is not null")
        )

    def trans_bronze(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as trans_id",
            "cast(o_custkey div 2 as string) as account_id",
            "o_orderdate as trans_date",
            "case o_orderstatus when 'P' then 'PRIJEM' when 'O' then 'VYDAJ' else 'VYBER' end as trans_type",
            f"cast(o_totalprice as {MONEY}) as amount",
            f"cast(o_totalprice as {MONEY}) as balance",
            "cast(o_orderkey as string) as partner_account",
        )

    def crm_case_surrogate(self) -> DataFrame:
        """Cases as the CRM stores them: the client only as a record id."""
        return self.table("events").where("event_type in ('signup', 'view')").selectExpr(
            "cast(event_id as string) as case_id",
            "concat('CT', cast(user_id as string)) as contact_ref",
            "ts as opened_at",
            "if(event_type = 'signup', 'Fraud Follow-up', 'General Inquiry') as case_type",
        )

    def contact(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "concat('CT', cast(c_custkey as string)) as record_id", "cast(c_custkey as string) as client_id"
        )

    def crm_case(self) -> DataFrame:
        return self.table("events").where("event_type in ('signup', 'view')").selectExpr(
            "cast(event_id as string) as case_id",
            "cast(user_id as string) as client_id",
            "ts as opened_at",
            "if(event_type = 'signup', 'Fraud Follow-up', 'General Inquiry') as case_type",
        )

    # -- loan system --
    def application(self) -> DataFrame:
        """One application per customer; those of one segment are under a key that no child row knows."""
        return self.table("customer").selectExpr(
            f"concat(cast(c_custkey as string), if(c_mktsegment = '{CHILDLESS_SEGMENT}', '-N', '')) as sk_id_curr",
            "if(c_custkey % 12 = 1, 1, 0) as target",
            f"cast(c_acctbal as {MONEY}) as amt_income_total",
            "c_mktsegment as name_income_type",
            "cast(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 180 as int)) as timestamp_ntz) as created_at",
            "cast(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 180 as int)) as timestamp_ntz) as updated_at",
            "c_custkey % 50 = 0 as is_deleted",
            "'unitless' as currency",
        )

    def previous_application(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as sk_id_prev",
            "cast(o_custkey as string) as sk_id_curr",
            "case o_orderstatus when 'F' then 'Approved' when 'O' then 'Refused' else 'Canceled' end as name_contract_status",
            "cast(datediff(o_orderdate, date'2002-01-01') as bigint) as days_decision",
        )

    def loans(self) -> DataFrame:
        """What all lines of a loan share: ``(loan, sk_id_curr, o_orderdate)``."""
        return self.table("orders").selectExpr("cast(o_orderkey as string) as loan", "cast(o_custkey as string) as sk_id_curr", "o_orderdate")

    def _lines(self, columns: list[str], loans: DataFrame | None, flag: str | None = None) -> DataFrame:
        """Lines with their loan, met on the text key, so that versions of a line need not move again to be compared.

        What ``loans`` has beyond its own three columns comes along.
        """
        lines = self.table("lineitem") if flag is None else self.table("lineitem").where(F.col("l_returnflag") == flag)
        known = self.loans()
        extra = [] if loans is None else [c for c in loans.columns if c not in known.columns]
        keyed = lines.withColumn("sk_id_prev", F.col("l_orderkey").cast("string"))
        loans = known if loans is None else loans
        met = skew_safe_join(keyed, loans, "sk_id_prev", "loan", "inner", weights=(lines, "l_orderkey"), count_first=True)
        return met.selectExpr("sk_id_prev", *columns, *extra)

    def installments_bronze(self, loans: DataFrame | None = None) -> DataFrame:
        """Instalments with redelivered versions of one key; ``updated_at`` orders them."""
        unpaid = "l_returnflag = 'N' and l_linestatus = 'O' and l_quantity < 10"
        price = f"cast(l_extendedprice as {MONEY})"
        return self._lines([
            "1 as num_instalment_version",
            "l_linenumber as num_instalment_number",
            "sk_id_curr",
            "datediff(o_orderdate, date'2002-01-01') + 60 as days_instalment",
            f"if({unpaid}, null, datediff(l_shipdate, date'2002-01-01')) as days_entry_payment",
            f"{price} as amt_instalment",
            f"if({unpaid}, null, cast({price} * if(l_discount > 0.05, 0.9BD, 1.0BD) as {MONEY})) as amt_payment",
            "l_shipdate as updated_at",
            "l_partkey as line_part",
            "l_suppkey as line_supp",
        ], loans)

    def _balances(self, flag: str, extra: list[str], grace: int, loans: DataFrame | None) -> DataFrame:
        return self._lines([
            "-l_linenumber as months_balance",
            "sk_id_curr",
            f"greatest(0, datediff(l_shipdate, o_orderdate) - {grace}) as sk_dpd",
            *extra,
            "l_shipdate as updated_at",
            "l_partkey as line_part",
            "l_suppkey as line_supp",
        ], loans, flag)

    def card_balance_bronze(self, loans: DataFrame | None = None) -> DataFrame:
        return self._balances("R", [
            f"cast(cast(l_extendedprice as {MONEY}) * (cast(l_discount as decimal(4,2)) - 0.02BD) as {MONEY}) as amt_balance",
            f"cast(if(l_quantity < 5, 0, l_quantity * 1000) as {MONEY}) as amt_credit_limit_actual",
        ], 60, loans)

    def pos_balance_bronze(self, loans: DataFrame | None = None) -> DataFrame:
        return self._balances("A", [], 90, loans)

    # -- campaign system: no customer key of its own --
    def campaign_keyless(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as campaign_row",
            "c_mktsegment as job",
            "case c_custkey % 3 when 0 then 'single' when 1 then 'married' else 'divorced' end as marital",
            "case c_custkey % 4 when 0 then 'primary' when 1 then 'secondary' when 2 then 'tertiary' else 'unknown' end as education",
            "if(c_custkey % 10 = 1, 'yes', 'no') as default",
            f"cast(c_acctbal as {MONEY}) as balance",
            "case c_custkey % 4 when 0 then 'success' when 1 then 'failure' else 'unknown' end as poutcome",
            "if(c_custkey % 9 = 2, 'yes', 'no') as y",
            "'EUR' as currency",
            "cast(timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 730 as int)) as timestamp_ntz) as created_at",
        )

    # -- change log --
    def change_log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id as seq",
            "case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op",
            "cast(user_id as string) as pk_value",
            "ts as changed_at",
            "event_type as label",
            "value as amount",
        )

    def change_baseline(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as customer_key", "c_mktsegment as label", "c_acctbal as amount"
        )

    def landed_changes(self) -> DataFrame:
        """The change log cut into daily drops."""
        return self.change_log().select(
            "seq", "op", "pk_value", F.col("changed_at").cast("string").alias("changed_at"), "label", "amount",
            F.to_date("changed_at").cast("string").alias("dt"),
        )
