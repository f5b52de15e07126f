"""The star schema as a set of lazy DataFrames.

Every analytical job takes a ``Star``. Two come with the package: one over the
published warehouse tables (``warehouse_star``) and one that derives the same
shapes from order and event tables (``lendscope.sources.bridge``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions.credit import NPL_MIN_DPD, is_npl
from lendscope.functions.dates import date_lit, key_to_date


CUSTOMER_COLUMNS = ("customer_id", "risk_tier", "credit_score")


Part = DataFrame | Callable[[], DataFrame]

# The month folder that holds a fact's day.
MONTHS = {"issue_date": "issue_month", "txn_date": "txn_month"}


def month_key(day: Column) -> Column:
    """``yyyymm`` as INT."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def dated(frame: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows of the days ``[start, end]``; an unset bound is open. Where the
    fact lies in month folders, the bounds also bound the folders read."""
    month = MONTHS[column] if MONTHS[column] in frame.columns else None
    if start is not None:
        low = date_lit(start)
        frame = frame.filter(F.col(column) >= low)
        frame = frame.filter(F.col(month) >= month_key(low)) if month else frame
    if end is not None:
        high = date_lit(end)
        frame = frame.filter(F.col(column) <= high)
        frame = frame.filter(F.col(month) <= month_key(high)) if month else frame
    return frame


class Star:
    """``loan`` and ``txn`` are the facts with ``issue_date`` and ``txn_date``;
    ``with_customer`` adds the customer's columns where a query needs them.

    A part is a DataFrame or a function that makes it on first use, so a query
    opens the tables it reads and no others. ``txn_between(start, end)`` gives
    the scored transactions of these days, cut at the scan.
    """

    def __init__(
        self,
        region: Part,
        customer: Part,
        product: Part,
        loan: Part,
        txn: Part,
        txn_unscored: Part,
        txn_between: Callable[[object, object], DataFrame],
    ):
        self._parts: dict[str, Part] = {
            "region": region,
            "customer": customer,
            "product": product,
            "loan": loan,
            "txn": txn,
            "txn_unscored": txn_unscored,
        }
        self.txn_between = txn_between

    def __getattr__(self, name: str) -> DataFrame:
        parts = self.__dict__.get("_parts", {})
        if name not in parts:
            raise AttributeError(name)
        if not isinstance(parts[name], DataFrame):
            parts[name] = parts[name]()
        return parts[name]

    def loan_between(self, start=None, end=None) -> DataFrame:
        """The loans issued in these days, cut at the month folders."""
        return dated(self.loan, "issue_date", start, end)

    def with_customer(self, facts: DataFrame) -> DataFrame:
        """Fact rows with customer id, tier and score. Both sides come from
        scans, so a sort-merge join splits a hot customer at run time."""
        if set(CUSTOMER_COLUMNS) <= set(facts.columns):
            return facts
        return facts.join(self.customer.select("customer_key", *CUSTOMER_COLUMNS), "customer_key")

    def replaced(self, **parts) -> Star:
        """The same star with other parts."""
        return Star(**{**self._parts, "txn_between": self.txn_between, **parts})

    def with_npl_from(self, npl_min_dpd: int) -> Star:
        """The same star with another first non-performing day."""
        if npl_min_dpd == NPL_MIN_DPD:
            return self
        return self.replaced(
            loan=lambda: self.loan.withColumn("is_npl", is_npl(F.col("days_past_due"), npl_min_dpd))
        )

    def sliced(
        self,
        start=None,
        end=None,
        risk_tier: str | None = None,
        category: str | None = None,
        state: str | None = None,
        loan_status: str | None = None,
    ) -> Star:
        """The star behind the report slicers; unset slicers keep all rows."""

        def placed(frame: DataFrame) -> DataFrame:
            if risk_tier is not None:
                frame = self.with_customer(frame).filter(F.col("risk_tier") == risk_tier)
            if state is not None:
                keys = self.region.filter(F.col("state") == state).select("region_key")
                frame = frame.join(keys, "region_key", "left_semi")
            return frame

        def loans() -> DataFrame:
            loan = placed(dated(self.loan, "issue_date", start, end))
            if category is not None:
                keys = self.product.filter(F.col("category") == category).select("product_key")
                loan = loan.join(keys, "product_key", "left_semi")
            return loan if loan_status is None else loan.filter(F.col("loan_status") == loan_status)

        return self.replaced(
            loan=loans,
            txn=lambda: placed(dated(self.txn, "txn_date", start, end)),
            txn_unscored=lambda: placed(dated(self.txn_unscored, "txn_date", start, end)),
            txn_between=lambda a, b: placed(dated(self.txn_between(a, b), "txn_date", start, end)),
        )


def fact_star(
    region: Part, customer: Part, product: Part, loan: Callable[[], DataFrame], txn: Callable[[], DataFrame]
) -> Star:
    """A star whose facts lie in month folders, with stored days and scores."""
    return Star(
        region=region,
        customer=customer,
        product=product,
        loan=loan,
        txn=txn,
        txn_unscored=txn,
        txn_between=lambda start, end: dated(txn(), "txn_date", start, end),
    )


def warehouse_star(read: Callable[[str], DataFrame], versions: bool = False) -> Star:
    """Star over published tables; ``read`` maps a table name to a DataFrame.
    With ``versions`` a fact keeps the customer version that it was loaded with.

    Date bounds also bound the month folders, so other months are not listed.
    """

    def fact(table: str, day: str, key: str) -> Callable[[], DataFrame]:
        @cache
        def rows() -> DataFrame:
            frame = read(table)
            return frame if day in frame.columns else frame.withColumn(day, key_to_date(F.col(key)))

        return rows

    return fact_star(
        region=lambda: read("dim_region"),
        customer=lambda: read("dim_customer") if versions else read("dim_customer").filter("is_current"),
        product=lambda: read("dim_loan_product"),
        loan=fact("fact_loan", "issue_date", "issue_date_key"),
        txn=fact("fact_transaction", "txn_date", "txn_date_key"),
    )
