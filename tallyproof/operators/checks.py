"""What is checked: the declarative list behind the data-quality result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.functions import any_null, is_blank


@dataclass(frozen=True)
class Check:
    """One check of a suite.

    ``reads`` names the input it is counted on: ``fact``, ``view``, ``status`` or ``none``.
    ``rule`` is ``blank``, ``duplicate``, ``hierarchy``, ``rate``, ``completeness`` or ``constant``.
    ``result`` is the column of the wide result that shows its colour (None: count only).
    """

    label: str
    result: str | None
    reads: str
    rule: str
    columns: tuple[str, ...] = ()
    guard: str | None = None
    excluded: tuple[str, ...] = ()
    blank_too: bool = False

    @property
    def counter(self) -> str:
        return "n_" + self.label.lower()

    def predicate(self, df: DataFrame) -> Column:
        """Rows of ``df`` that break this check."""
        if self.rule == "blank":
            return is_blank(df, self.columns[0])
        if self.rule == "rate":
            # A NULL guard makes the comparison NULL, and such a row is not counted.
            listed = F.upper(F.trim(F.col(self.guard))).isin(*self.excluded)
            return is_blank(df, self.columns[0]) & ~listed
        if self.rule == "hierarchy":
            if self.blank_too:
                gap = reduce(or_, [is_blank(df, name) for name in self.columns])
            else:
                gap = any_null(self.columns)
            return F.col(self.guard).isNotNull() & gap
        raise ValueError(f"{self.label}: a {self.rule} check has no row predicate")


GRAIN = ("dwh_business_date", "instance", "row_type", "cluster_type")
DUPLICATE_KEYS = ("item_id", "instance", "dwh_business_date", "row_type")

# Currency codes that may lack an exchange rate.
RATE_EXEMPT_CURRENCIES = ("ACU", "GOZ", "PLL", "NUL", "XAA", "FOZ")

HIERARCHY_COLUMNS = tuple(f"l{level}_{part}" for level in range(1, 9) for part in ("group", "owner"))

# Check labels in reporting order with their result columns.
BREAK_CHECKS = (
    Check("Completeness", None, "status", "completeness"),
    Check("Duplicate", "duplicate_check", "fact", "duplicate"),
    Check("LVID", "lvid_null_check", "fact", "blank", ("lvid",)),
    Check("LVID_Region", "lvid_region_null_check", "view", "blank", ("lvid_region",)),
    Check("LVID_Description", "lvid_description_null_check", "view", "blank", ("lvid_description",)),
    Check("LVID_Country", "lvid_country_null_check", "view", "blank", ("lvid_country",)),
    Check("Rec_Type", "rec_type_null_check", "view", "blank", ("rec_type",)),
    Check("Rec_Type_2", "rec_type_2_null_check", "view", "blank", ("rec_type_2",)),
    Check("SOE_ID", "soe_id_null_check", "none", "constant"),
    Check("User_Hierarchy", "user_hierarchy_null_check", "none", "constant"),
    Check("Ownership_ID", "ownership_id_null_check", "fact", "blank", ("ownership_id",)),
    Check("Ownership_Hierarchy", "ownership_hierarchy_null_check", "view", "hierarchy",
          HIERARCHY_COLUMNS, guard="ownership_id"),
    Check("Currency", "currency_null_check", "fact", "blank", ("local_currency",)),
    Check("FX_Rate", "fx_rate_null_check", "view", "rate", ("fx_rate",),
          guard="currency", excluded=RATE_EXEMPT_CURRENCIES),
    Check("Statement_Date", "statement_date_null_check", "fact", "blank", ("statement_date",)),
    Check("Action_Date", "action_date_null_check", "none", "constant"),
    Check("Value_Date", "value_date_null_check", "view", "blank", ("item_value_date",)),
    Check("Instance", "instance_null_check", "fact", "blank", ("instance",)),
    Check("Set_ID", "set_id_null_check", "fact", "blank", ("set_id",)),
    Check("Corr_Acc_No", "corr_acc_no_null_check", "fact", "blank", ("corr_acc_no",)),
    Check("Bran_Code", "bran_code_null_check", "fact", "blank", ("bran_code",)),
    Check("Agent_Code", "agent_code_null_check", "fact", "blank", ("agent_code",)),
)


def reading(checks: Sequence[Check], source: str) -> list[Check]:
    """The checks counted on one input."""
    return [c for c in checks if c.reads == source]


def strict_hierarchy(code_column: str, checks: Sequence[Check] = BREAK_CHECKS) -> tuple[Check, ...]:
    """The suite with the stricter hierarchy rule: an owner code as well, and blanks count as gaps."""
    def tighten(c: Check) -> Check:
        if c.rule != "hierarchy":
            return c
        return Check(c.label, c.result, c.reads, c.rule, (code_column, *c.columns),
                     guard=c.guard, blank_too=True)
    return tuple(tighten(c) for c in checks)
