"""Employee, office and product dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from tallylake.functions.kpis import with_product_kpis
from tallylake.operators.cleanse import munge
from tallylake.operators.dimensions import scd1_merge, scd2_append_versions
from tallylake.sources.tables import incremental_extract


def employee_dimension(
    employees: DataFrame,
    history: DataFrame | None,
    as_of: date | str,
    days: int = 1,
    tie_break: list[str] | None = None,
    only_changed: bool = False,
) -> DataFrame:
    """Versions to append for the employees changed on the load date."""
    return employee_versions(incremental_extract(employees, "upddt", as_of, days), history, tie_break, only_changed)


def employee_versions(
    changed: DataFrame, history: DataFrame | None, tie_break: list[str] | None = None, only_changed: bool = False
) -> DataFrame:
    """Versions to append for a batch of changes, or only for those that change a column."""
    cleaned = munge(changed, dedup=True, drop_all_null=True)
    order = ["upddt", *(tie_break or [])]
    return scd2_append_versions(history, cleaned, ["employeenumber"], order, only_changed=only_changed)


def office_dimension(offices: DataFrame) -> DataFrame:
    """All offices, cleansed; the table is replaced as a whole."""
    return munge(offices, dedup=True, drop_all_null=True)


def product_dimension(
    products: DataFrame, existing: DataFrame | None, as_of: date | str, days: int = 1, latest_by: list[str] | None = None
) -> DataFrame:
    """The whole product dimension after merging the products changed since the day before.

    Several changes of a product in one batch need ``latest_by`` (for example
    ``["-upddt"]``); without it they fail the job.
    """
    changed = incremental_extract(products, "upddt", as_of, days, inclusive=True)
    return scd1_merge(existing, with_product_kpis(changed), ["productcode"], latest_by)
